"""A bounded cache from byte slices to token ids, looked up for all slices of some texts at once.

Slices are keyed by a 64-bit hash in an open-addressing table; the bytes of every known slice are kept too and compared with
the texts, so two slices of one hash can't be taken for each other. Frequent slices stay when the cache is full.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from terravane.llm import textarrays as ta

#: Longer slices are encoded each time and not kept.
LONGEST = 96


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... for counts[i] places, one i after the other."""
    total = int(counts.sum())
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(total)


class SliceCache:
    """encode: ids of slices, each as bytes of dtype. Entry 0 is the empty slice."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]], dtype, entries: int = 1 << 20):
        self.encode, self.dtype, self.entries = encode, np.dtype(dtype), entries
        self.mask = (1 << (2 * entries - 1).bit_length()) - 1
        self._clear()

    def _clear(self) -> None:
        self.table = np.zeros(self.mask + 1, np.uint32)
        self.n = 1
        self.keys, self.hits = np.zeros(1024, np.uint64), np.zeros(1024, np.uint32)
        self.id_at, self.byte_at = np.zeros(1025, np.int64), np.zeros(1025, np.int64)
        self.ids, self.bytes = np.zeros(4096, self.dtype), np.zeros(8192, np.uint8)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        out = np.zeros(max(size, len(array) * 3 // 2), array.dtype)
        out[: len(array)] = array
        return out

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, 0 if it has none."""
        slot = (keys & np.uint64(self.mask)).astype(np.int64)
        out = self.table[slot].astype(np.int64)
        todo = np.flatnonzero((self.keys[out] != keys) & (out > 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.mask
            out[todo] = now = self.table[slot[todo]].astype(np.int64)
            todo = todo[(self.keys[now] != keys[todo]) & (now > 0)]
        return out

    def _place(self, keys: np.ndarray, entries: np.ndarray) -> None:
        slot = (keys & np.uint64(self.mask)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.table[slot[todo]] == 0]
            self.table[slot[free]] = entries[free]  # of keys on one slot the last stays
            todo = todo[self.table[slot[todo]] != entries[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask

    def _add(self, keys: np.ndarray, slices: list[bytes], ids: list[bytes]) -> None:
        """Distinct new keys with their slices and ids."""
        a, b, width = self.n, self.n + len(keys), self.dtype.itemsize
        self.keys, self.hits = self._room(self.keys, b), self._room(self.hits, b)
        self.id_at, self.byte_at = self._room(self.id_at, b + 1), self._room(self.byte_at, b + 1)
        self.keys[a:b], self.hits[a:b] = keys, 0
        for at, parts, pool, unit in ((self.id_at, ids, "ids", width), (self.byte_at, slices, "bytes", 1)):
            at[a : b + 1] = at[a] + np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) // unit)])
            values = np.frombuffer(b"".join(parts), self.dtype if pool == "ids" else np.uint8)
            setattr(self, pool, self._room(getattr(self, pool), int(at[b])))
            getattr(self, pool)[at[a] : at[b]] = values
        self._place(keys, np.arange(a, b, dtype=np.uint32))
        self.n = b

    def _make_room(self, new: int) -> None:
        """Where `new` more don't fit, start again from the most frequent entries, half of the cache at most."""
        if self.n + new <= self.entries:
            return
        keep = 1 + np.flatnonzero(self.hits[1 : self.n] > 1)
        keep = keep[np.argsort(self.hits[keep])[::-1][: max(0, min(self.entries // 2, self.entries - new))]]
        keys, n = self.keys[keep], [np.diff(at[: self.n + 1])[keep] for at in (self.id_at, self.byte_at)]
        pools = [pool[spread(at[keep], k)] for pool, at, k in zip((self.ids, self.bytes), (self.id_at, self.byte_at), n)]
        self._clear()
        ends = [np.cumsum(k).tolist() for k in n]
        ids, data = pools[0].tobytes(), pools[1].tobytes()
        w = self.dtype.itemsize
        self._add(keys, [data[a:b] for a, b in zip([0, *ends[1]], ends[1])], [ids[a * w : b * w] for a, b in zip([0, *ends[0]], ends[0])])

    def look_up(self, data: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of the slices of data that begin at `starts`; its last place is the end of data.

        ids: those of all slices in order; counts: how many each has. starts[0] is 0, or data is empty.
        """
        raw = np.frombuffer(data, np.uint8)
        sizes = np.diff(starts)
        keys = ta.span_hashes(raw, starts[:-1], starts[1:])
        keys[keys == 0] = 1
        long = sizes > LONGEST
        found = self._find(keys)
        missing = np.flatnonzero((found == 0) & ~long & (sizes > 0))
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            at = missing[first]
            slices = [data[a:b] for a, b in zip(starts[at].tolist(), starts[at + 1].tolist())]
            n = self.n
            self._make_room(len(new))
            fits = new[: max(0, self.entries - self.n)]
            self._add(fits, slices[: len(fits)], self.encode(slices[: len(fits)]))
            if self.n == n + len(new):
                found[missing] = self._find(keys[missing])
            else:  # entries have moved
                found = self._find(keys)
        found[long] = 0
        known = np.diff(self.byte_at[: self.n + 1])[found]
        # what the entries' bytes don't repeat is encoded by itself: long slices, slices of one hash, an overfull batch
        same = known == sizes
        whole = same.copy()
        if same.any():
            at = spread(starts[:-1][same], sizes[same])
            wrong = np.flatnonzero(self.bytes[spread(self.byte_at[found[same]], sizes[same])] != raw[at])
            if len(wrong):
                whole[np.searchsorted(starts, at[wrong], side="right") - 1] = False
        found[~whole] = 0
        self.hits[: self.n] += np.bincount(found, minlength=self.n).astype(np.uint32)
        counts = np.diff(self.id_at[: self.n + 1])[found]
        if whole.all():
            return self.ids[spread(self.id_at[found], counts)], counts
        odd = np.flatnonzero(~whole)
        own = self.encode([data[a:b] for a, b in zip(starts[odd].tolist(), starts[odd + 1].tolist())])
        counts[odd] = np.fromiter(map(len, own), np.int64, len(own)) // self.dtype.itemsize
        out = np.empty(int(counts.sum()), self.dtype)
        rest = np.repeat(whole, counts)
        out[rest] = self.ids[spread(self.id_at[found[whole]], counts[whole])]
        out[~rest] = np.frombuffer(b"".join(own), self.dtype)
        return out, counts
