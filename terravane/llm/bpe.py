"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Code points become classes by one table look-up; what the split pattern looks ahead for (the end of a white-space run, the
letters after an apostrophe) is part of the class. Each class is a function on the eight states of an automaton that walks the
split pattern, and these functions form a small monoid, so the states before all characters come from an associative scan over
monoid elements: in blocks, all blocks at once, then over the block totals. Where the automaton starts a new match is a
boundary. No regular expression takes part. The slices between boundaries are looked up in a bounded cache, all at once; the
slices that it lacks are merged pair by pair, all slices of a length class at once. Decoding puts the tokens' bytes side by side.

Edge cases: a null text is an empty one and has no tokens. Texts of any length are encoded whole. Equal texts have equal ids.
"""

from __future__ import annotations

import base64
import functools
import heapq
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import textarrays as ta
from terravane.llm.jobs import read_table
from terravane.llm.slicecache import SliceCache, spread

#: Slices that a process keeps with their ids.
SLICES = 1 << 20
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

# Character classes. The pattern splits a run of white space before its last character if text follows; that character then
# starts the next match if it is a space, or is one of its own.
LETTER, NUMBER, OTHER, SPACE_MORE, SPACE_LAST, BREAK_LAST, QUOTE_1, QUOTE_2 = range(8)
CLASSES = 8
# States: before any match or after a whole one, in letters, numbers, others, white space, after the space that leads a match, and
# with two or one letters of a contraction to come.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, LED, TWO_TO_COME, ONE_TO_COME = range(8)
STATES = 8


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a match starts at this character."""
    if state == TWO_TO_COME:
        return ONE_TO_COME, False
    if state == ONE_TO_COME:
        return START, False
    if kind in (LETTER, NUMBER):
        inside = IN_LETTERS if kind == LETTER else IN_NUMBERS
        return inside, state not in (inside, LED)
    if kind == SPACE_MORE:
        return IN_SPACE, state != IN_SPACE
    if kind == SPACE_LAST:
        return LED, True
    if kind == BREAK_LAST:
        return START, True
    if state in (IN_OTHERS, LED):
        return IN_OTHERS, False
    return {OTHER: IN_OTHERS, QUOTE_1: ONE_TO_COME, QUOTE_2: TWO_TO_COME}[kind], True


class Automaton:
    """Elements: all compositions of the class functions. Generator c is class c; CLASSES + c is class c at a text's start."""

    def __init__(self):
        plain = [tuple(_step(s, c)[0] for s in range(STATES)) for c in range(CLASSES)]
        first = [(f[START],) * STATES for f in plain]
        known: dict[tuple[int, ...], int] = {}
        for f in [*plain, *first, tuple(range(STATES))]:
            known.setdefault(f, len(known))
        queue = list(known)
        for f in queue:
            for g in [*plain, *first]:
                h = tuple(g[s] for s in f)
                if h not in known:
                    known[h] = len(known)
                    queue.append(h)
        elements = list(known)
        self.size = len(elements)
        self.generator = np.array([known[f] for f in [*plain, *first]], np.int32)
        self.identity = known[tuple(range(STATES))]
        self.apply = np.array(elements, np.uint8)
        self.times = np.array([[known[tuple(g[s] for s in f)] for g in elements] for f in elements], np.int32)
        self.starts = np.array([[_step(s, c)[1] for c in range(CLASSES)] for s in range(STATES)])

    def scan(self, items: np.ndarray, width: int = 256) -> np.ndarray:
        """Inclusive products of a sequence of elements."""
        n = len(items)
        if n <= width:
            out = np.empty(n, np.int32)
            now = self.identity
            for i, x in enumerate(items.tolist()):
                now = out[i] = self.times[now, x]
            return out
        blocks = -(-n // width)
        padded = np.full(blocks * width, self.identity, np.int32)
        padded[:n] = items
        columns = np.ascontiguousarray(padded.reshape(blocks, width).T)
        flat = self.times.reshape(-1)
        for i in range(1, width):
            columns[i] = flat[columns[i - 1] * self.size + columns[i]]
        totals = self.scan(columns[-1].copy(), width)
        carry = np.concatenate([[self.identity], totals[:-1]]).astype(np.int32)
        return flat[carry[None, :] * self.size + columns].T.reshape(-1)[:n]


#: Code points of white space in the split pattern, as fixed by the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@functools.cache
def _tables() -> tuple[Automaton, np.ndarray]:
    kinds = np.full(0x110000, OTHER, np.uint8)
    category = unicodedata.category
    for c in range(0x110000):
        first = category(chr(c))[0]
        if first == "L":
            kinds[c] = LETTER
        elif first == "N":
            kinds[c] = NUMBER
    kinds[WHITE_SPACE] = SPACE_MORE
    return Automaton(), kinds


class Slices:
    """Pre-tokens of texts: starts, the byte offset in data of each (and of the end), and bounds, those of each text."""

    def __init__(self, parts: list[bytes]):
        automaton, kinds = _tables()
        self.data = b"".join(parts)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        text_at = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer(self.data.decode().encode("utf-32-le"), np.uint32)
        raw = np.frombuffer(self.data, np.uint8)
        byte_at = np.flatnonzero((raw & 0xC0) != 0x80)
        ends = np.searchsorted(byte_at, text_at)
        n = len(points)
        kind = kinds[points]
        last = np.zeros(n + 1, bool)
        last[ends[1:] - 1] = True  # of its text; an empty first text marks the spare place
        if n:
            space = np.flatnonzero(kind == SPACE_MORE)
            follows = space[~last[space]]
            follows = follows[kind[follows + 1] != SPACE_MORE]
            # classes of following characters are read before any is changed
            quotes = np.flatnonzero(points == 0x27)
            quotes = quotes[~last[quotes]]
            one = points[quotes + 1]
            self._mark(kind, quotes, one, points, last)
            kind[follows] = np.where(points[follows] == 0x20, SPACE_LAST, BREAK_LAST)
        first = ends[:-1][sizes > 0]
        items = automaton.generator[kind]
        items[first] = automaton.generator[kind[first] + CLASSES]
        after = automaton.apply[automaton.scan(items), START]
        before = np.empty(n, np.uint8)
        before[1:] = after[:-1]
        before[first] = START
        begins = automaton.starts[before, kind]
        begins[first] = True
        at = np.flatnonzero(begins)
        self.starts = np.concatenate([byte_at[at], [len(self.data)]])
        self.bounds = np.searchsorted(self.starts[:-1], text_at)

    @staticmethod
    def _mark(kind: np.ndarray, quotes: np.ndarray, one: np.ndarray, points: np.ndarray, last: np.ndarray) -> None:
        short = np.isin(one, [ord(c) for c in "stmd"])
        kind[quotes[short]] = QUOTE_1
        long = quotes[~short & ~last[quotes + 1]]
        pair = points[long + 1].astype(np.int64) * 128 + points[long + 2]
        kind[long[np.isin(pair, [ord(a) * 128 + ord(b) for a, b in ("re", "ve", "ll")]) & (points[long + 2] < 128)]] = QUOTE_2


#: Bytes of a long text whose arrays stand in memory at once.
WINDOW = 1 << 20


def windows(text: bytes, size: int) -> Iterator[bytes]:
    """A text in parts of about `size` bytes, cut between a visible ASCII character and a space or line feed: no pre-token spans such a place, and
    those on either side don't depend on the other. Without one a part is longer."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text):
            data = np.frombuffer(text[end - size : end + 1], np.uint8)
            cuts = np.flatnonzero(((data[1:] == 0x20) | (data[1:] == 0x0A)) & (data[:-1] > 0x20) & (data[:-1] < 0x7F))
            cuts = cuts[cuts + 1 + end - size > at]
            if len(cuts):
                end += int(cuts[-1]) + 1 - size
                break
            end += size
        yield text[at : min(end, len(text))]
        at = end


NONE = np.int32(0x7FFFFFFF)


class Merger:
    """Ranks of a vocabulary and merges of slices by them, lowest rank first, the leftmost of equals first."""

    #: Longest slices, in bytes, of each class that is merged at once; longer ones are merged one by one.
    WIDTHS = (4, 6, 8, 10, 12, 16, 24, 40)

    def __init__(self, path: str = RANKS, cached: int = SLICES):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.cache = SliceCache(self._ids, "<u4", cached)
        sizes = np.zeros(max(self.tokens) + 2, np.int64)
        for rank, token in self.tokens.items():
            sizes[rank + 1] = len(token)
        self.token_at = np.cumsum(sizes)
        self.token_bytes = np.frombuffer(b"".join(self.tokens[rank] for rank in sorted(self.tokens)), np.uint8)
        self.byte_rank = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        ranks = self.ranks
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    values.append(rank)
        keys, values = np.array(keys, np.uint64), np.array(values, np.int32)
        self.bits = 20
        slot = self._slot(keys)
        order = np.argsort(slot, kind="stable")
        self.keys, self.values = np.append(keys[order], np.uint64(2**64 - 1)), np.append(values[order], NONE)
        self.slots = np.searchsorted(slot[order], np.arange((1 << self.bits) + 1))
        self.probes = int(np.diff(self.slots).max())

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * np.uint64(ta.BASE)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NONE where they don't merge or one is -1."""
        shape = a.shape
        keys = (a.astype(np.int64).astype(np.uint64) << np.uint64(32) | (b.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF))).reshape(-1)
        at = self.slots[self._slot(keys)]
        out = np.full(len(keys), NONE, np.int32)
        for i in range(self.probes):
            j = np.minimum(at + i, len(self.keys) - 1)
            hit = self.keys[j] == keys
            out[hit] = self.values[j[hit]]
        return out.reshape(shape)

    def merge_many(self, slices: list[bytes]) -> list[bytes]:
        """Ids, as little-endian unsigned 32-bit integers, of each slice."""
        out: list[bytes] = [b""] * len(slices)
        sizes = np.fromiter(map(len, slices), np.int64, len(slices))
        low = 0
        for width in self.WIDTHS:
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            low = width
            for a in range(0, len(rows), 8192):
                self._merge_block([slices[i] for i in rows[a : a + 8192]], rows[a : a + 8192], width, out)
        for i in np.flatnonzero(sizes > low).tolist():
            out[i] = self.merge_long(slices[i])
        return out

    def _merge_block(self, slices: list[bytes], rows: np.ndarray, width: int, out: list[bytes]) -> None:
        sizes = np.fromiter(map(len, slices), np.int64, len(slices))
        ids = self.byte_rank[np.frombuffer(b"".join(s.ljust(width, b"\0") for s in slices), np.uint8)].reshape(len(slices), width)
        ids[np.arange(width)[None, :] >= sizes[:, None]] = -1
        pairs = self.rank(ids[:, :-1], ids[:, 1:])
        pairs[ids[:, 1:] < 0] = NONE
        columns = np.arange(width)
        while len(rows):
            at = pairs.argmin(axis=1)
            each = np.arange(len(rows))
            best = pairs[each, at]
            over = best == NONE
            if over.any():
                flat, n = ids[over].astype("<u4"), (ids[over] >= 0).sum(axis=1)
                for row, x, m in zip(rows[over].tolist(), flat, n.tolist()):
                    out[row] = x[:m].tobytes()
                live = ~over
                rows, ids, pairs, at, best = rows[live], ids[live], pairs[live], at[live], best[live]
                each = np.arange(len(rows))
                if not len(rows):
                    break
            ids[each, at] = best
            source = columns[None, :] + (columns[None, :] > at[:, None])
            padded = np.concatenate([ids, np.full((len(rows), 1), -1, ids.dtype)], axis=1)
            ids = np.take_along_axis(padded, source, axis=1)
            padded = np.concatenate([pairs, np.full((len(rows), 1), NONE, pairs.dtype)], axis=1)
            pairs = np.take_along_axis(padded, source[:, :-1], axis=1)
            # the merged id has new neighbours on both sides
            right = np.where(at + 1 < width, ids[each, np.minimum(at + 1, width - 1)], -1)
            some = at < width - 1
            pairs[each[some], at[some]] = np.where(right[some] >= 0, self.rank(best[some], right[some]), NONE)
            some = at > 0
            pairs[each[some], at[some] - 1] = self.rank(ids[each[some], at[some] - 1], best[some])

    def merge_long(self, piece: bytes) -> bytes:
        """The same for one slice of any length, with a heap of pairs over a linked list."""
        ids = self.byte_rank[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tokens = self.tokens
        heap = []

        def offer(i):
            j = after[i]
            if j < n:
                rank = self.ranks.get(tokens[ids[i]] + tokens[ids[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def _ids(self, slices: list[bytes]) -> list[bytes]:
        """Ids of slices: a token's own rank, or what merging gives."""
        out = [rank.to_bytes(4, "little") if (rank := self.ranks.get(s)) is not None else b"" for s in slices]
        rest = [i for i, ids in enumerate(out) if not ids]
        for i, ids in zip(rest, self.merge_many([slices[i] for i in rest])):
            out[i] = ids
        return out

    def encode_all(self, parts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the bounds of each text's. A text alone is encoded window by window."""
        if len(parts) == 1 and len(parts[0]) > window:
            whole = np.concatenate([self.encode_all([part], len(part))[0] for part in windows(parts[0], window)])
            return whole, np.array([0, len(whole)])
        cut = Slices(parts)
        ids, counts = self.cache.look_up(cut.data, cut.starts)
        return ids, np.concatenate([[0], np.cumsum(counts)])[cut.bounds]

    def encode(self, parts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        ids, bounds = self.encode_all(parts)
        data, at = ids.tobytes(), (4 * bounds).tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each token."""
        return self.token_at[ids.astype(np.int64) + 1] - self.token_at[ids]

    def decode_all(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[spread(self.token_at[ids], self.sizes(ids))].tobytes()

    def decode(self, ids: bytes) -> bytes:
        return self.decode_all(np.frombuffer(ids, "<u4"))

    def offsets(self, ids: bytes) -> np.ndarray:
        """Byte offsets in the text at which the tokens start, and the end."""
        return np.concatenate([[0], np.cumsum(self.sizes(np.frombuffer(ids, "<u4")))])


@functools.cache
def merger(path: str = RANKS) -> Merger:
    return Merger(path)


def encode_documents(docs: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    """(doc_id, ids array<int>, offsets array<int>): the tokens of whole texts and the byte offsets at which they start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in ta.slices(batches):
            ids = m.encode(ta.pieces(batch.column(1)))
            values = [np.frombuffer(x, "<u4").astype(np.int32) for x in ids]
            starts = [m.offsets(x)[:-1].astype(np.int32) for x in ids]
            yield pa.record_batch([batch.column(0), pa.array(values, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int32()))], names=["doc_id", "ids", "offsets"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, ids array<int>, offsets array<int>")


def decode_documents(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, text) of encode_documents' rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in batches:
            texts = [m.decode_all(np.array(ids, np.int64)).decode(errors="replace") for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each whole text encoded, and its ids decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in ta.slices(batches):
            ids, bounds = m.encode_all(ta.pieces(batch.column(1)))
            ends = np.concatenate([[0], np.cumsum(m.sizes(ids))])[bounds]
            digests = [[sha256(data[a:b]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist())] for data, at in ((memoryview(ids.tobytes()), 4 * bounds), (memoryview(m.decode_all(ids)), ends))]
            yield pa.record_batch([batch.column(0), pa.array(np.diff(bounds)), *map(pa.array, digests)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts, id digests and decoded digests of all documents."""
    return round_trip(read_table(spark, sf_dir, "documents"))
