"""Numpy views over Arrow string columns: sub-batches of bounded bytes, word boundaries and word hashes.

Everything here works on UTF-8 bytes. Word classes that hold all bytes from 0x80 up give the same words on bytes as on
code points, so no text is decoded. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multiplier of the polynomial hash, its inverse modulo 2**64, and the multipliers of the 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U64(30))) * MIX_A
    x = (x ^ (x >> U64(27))) * MIX_B
    return x ^ (x >> U64(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit values that follow from seed."""
    with np.errstate(over="ignore"):
        start = mix(np.array([(seed * BASE) % (1 << 64)], U64))[0]
        return mix(start + np.arange(1, n + 1, dtype=U64) * U64(BASE))


BYTE_VALUES = seeds(256, 7)
_powers = (np.ones(1, U64), np.ones(1, U64))


#: Powers beyond these many are made anew for each longer text, not kept.
POWERS_KEPT = 1 << 21


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i below n; up to POWERS_KEPT of them are kept."""
    global _powers
    found = _powers
    if len(found[0]) < n:
        m = max(n, 1 << 16)
        up, down = np.full(m, BASE, U64), np.full(m, BASE_INV, U64)
        up[0] = down[0] = 1
        found = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if m <= POWERS_KEPT:
            _powers = found
    return found[0][:n], found[1][:n]


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of weighted bytes, from which hashes of spans follow."""
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data))[0], dtype=U64, out=out[1:])
    return out


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes have equal hashes wherever they stand. sums: byte_sums(data), if at hand."""
    if not len(starts):
        return np.zeros(0, U64)
    sums = byte_sums(data) if sums is None else sums
    return mix((sums[ends] - sums[starts]) * powers(len(data) + 1)[1][starts] + (ends - starts).astype(U64))


def as_strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """One string array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    return column.fill_null("") if column.null_count else column


def buffers(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """Bytes and the len + 1 offsets into them of a string array."""
    column = as_strings(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b""), offsets


def pieces(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each row."""
    data, offsets = buffers(column)
    ends = offsets.tolist()
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 19, max_rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each part holds at most max_bytes of the column (one longer text stands alone) and max_rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        offsets = buffers(batch.column(at))[1]
        a = 0
        while a < batch.num_rows:
            b = int(np.searchsorted(offsets, offsets[a] + max_bytes, side="right")) - 1
            b = min(max(b, a + 1), a + max_rows, batch.num_rows)
            yield batch.slice(a, b - a)
            a = b


#: Bytes of words [0-9a-z] and everything from 0x80 up, once A-Z are lower-cased.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
IS_WORD = np.zeros(256, bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
#: Bytes of words [^\x20\x09-\x0D].
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[0x20] = NOT_SPACE[0x09:0x0E] = False


class Words:
    """Words of the texts in `parts`.

    starts, ends: byte bounds in `data` (the texts, one zero byte after each); hashes: 64 bits for each word; bounds:
    the words of text i are bounds[i]:bounds[i + 1]; text_at: where text i starts in data.
    """

    def __init__(self, parts: list[bytes], lower: bool = True, is_word: np.ndarray = IS_WORD, hashed: bool = True):
        self.data = np.frombuffer(b"\x00".join([b"", *parts, b""]), np.uint8)
        if lower:
            self.data = LOWER[self.data]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        self.text_at = np.concatenate([[1], 1 + np.cumsum(sizes + 1)])
        inside = is_word[self.data]
        inside[0] = False
        inside[self.text_at[1:] - 1] = False
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        self.bounds = np.searchsorted(self.starts, self.text_at)
        self.hashes = self.hash_spans(self.starts, self.ends) if hashed else None

    def hash_spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not hasattr(self, "_sums"):
            self._sums = byte_sums(self.data)
        return span_hashes(self.data, starts, ends, self._sums)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


SHINGLE_VALUES = seeds(64, 11) | U64(1)


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the bounds for each text; a text of fewer words, but not none, has one."""
    counts = words.counts()
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros(int(bounds[-1]), U64)
    full = counts >= size
    total = len(words.hashes)
    if full.any():
        rolled = np.zeros(total - size + 1, U64)
        for i in range(size):
            rolled += words.hashes[i : total - size + 1 + i] * SHINGLE_VALUES[i]
        keep = np.ones(total - size + 1, bool)
        ends = words.bounds[1:]
        for i in range(1, size):
            late = ends - i
            late = late[(late >= 0) & (late < len(keep))]
            keep[late] = False
        short = np.flatnonzero(~full & (counts > 0))
        for t in short.tolist():
            keep[words.bounds[t] : min(words.bounds[t + 1], len(keep))] = False
        out[np.repeat(full, n)] = mix(rolled[keep])
    for t in np.flatnonzero(~full & (counts > 0)).tolist():
        own = words.hashes[words.bounds[t] : words.bounds[t + 1]]
        out[bounds[t]] = mix((own * SHINGLE_VALUES[size : size + len(own)]).sum(keepdims=True, dtype=U64))[0]
    return out, bounds
