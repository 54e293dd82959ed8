"""Benchmark decontamination over a distributed positional inverted index.

The index is kept in segments. A segment holds about a megabyte of whole documents: its terms (64-bit word hashes, sorted), and for
each term the ascending positions of all its words. Segments are rows of a table in the shared folder, so building and
searching need no shuffle, a lost executor costs one task, and one index serves any number of benchmarks. A query window starts from
its rarest term in the segment: that term's positions, less its offset in the window, are intersected with the offset-adjusted lists of
the other terms, rarest first. Proximity matches start from the rarest term too: some SPAN consecutive words of the text hold all
words of the window, in any order.

Windows are 10 consecutive words of a benchmark item; an item of fewer words, but not none, is one window. Words are runs of
digits, letters and everything beyond ASCII in the text with A-Z lower-cased. Benchmark texts come to the driver and to the tasks in
blocks of at most BLOCK_BYTES (or one item), one at a time; the hits of each block are stored, and all count.

Edge cases: null and wordless texts have no words and are never hit; such items have no windows. Repeated documents are rows
of their own; repeated item ids count once. A null item id reads "null". An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import textarrays as ta
from terravane.llm.jobs import dropped, read_table, stored, with_columns_of, with_row_key
from terravane.llm.slicecache import spread

WINDOW = 10
#: Consecutive words that hold all words of a window in a proximity match.
SPAN = 20
BLOCK_BYTES = 8 << 20


@dataclass
class Queries:
    """Windows of a block of items: for each length the distinct windows' term hashes, and the items of each window."""

    windows: list[np.ndarray]
    items: list[list[tuple[int, ...]]]
    names: list[str]

    @property
    def vocabulary(self) -> np.ndarray:
        return np.sort(np.concatenate([w.reshape(-1) for w in self.windows])) if self.windows else np.zeros(0, np.uint64)


def queries_of(item_ids: list, parts: list[bytes], size: int = WINDOW) -> Queries:
    names = sorted({"null" if i is None else str(i) for i in item_ids})
    number = {n: k for k, n in enumerate(names)}
    words = ta.Words(parts)
    found: dict[int, dict[bytes, set[int]]] = {}
    for item, a, b in zip(item_ids, words.bounds, words.bounds[1:]):
        own, n = words.hashes[a:b], min(size, int(b - a))
        for i in range(len(own) - n + 1 if n else 0):
            found.setdefault(n, {}).setdefault(own[i : i + n].tobytes(), set()).add(number["null" if item is None else str(item)])
    windows = [np.frombuffer(b"".join(w), np.uint64).reshape(len(w), n) for n, w in sorted(found.items())]
    return Queries(windows, [[tuple(sorted(s)) for s in w.values()] for _, w in sorted(found.items())], names)


def query_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, size: int = WINDOW) -> Iterator[Queries]:
    """The items in blocks of about block_bytes, each collected when it is asked for."""
    items = benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for block in range(n):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).toArrow()
        yield queries_of(own.column("item_id").to_pylist(), ta.pieces(own.column("text")), size)


@dataclass
class Segment:
    """Positional postings: positions of terms[i] are positions[offsets[i]:offsets[i + 1]]; bounds: words of each text."""

    terms: np.ndarray
    offsets: np.ndarray
    positions: np.ndarray
    bounds: np.ndarray

    @classmethod
    def build(cls, parts: list[bytes]) -> Segment:
        words = ta.Words(parts)
        order = np.argsort(words.hashes, kind="stable")
        hashes = words.hashes[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        return cls(hashes[first], np.concatenate([first, [len(hashes)]]), order, words.bounds)

    def packed(self) -> tuple[bytes, bytes, bytes]:
        gaps = np.diff(self.positions, prepend=0)  # wraps where a list begins; the running sum undoes it
        return self.terms.tobytes(), np.diff(self.offsets).astype("<i4").tobytes(), gaps.astype("<i4").tobytes()

    @classmethod
    def unpacked(cls, terms: bytes, sizes: bytes, gaps: bytes, n_words: np.ndarray) -> Segment:
        ends = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (np.frombuffer(sizes, "<i4"), n_words)]
        return cls(np.frombuffer(terms, np.uint64), ends[0], np.cumsum(np.frombuffer(gaps, "<i4"), dtype=np.int64), ends[1])

    def of_terms(self, vocabulary: np.ndarray) -> Segment:
        """The postings of the terms in a sorted vocabulary alone."""
        if not len(vocabulary):
            return Segment(self.terms[:0], self.offsets[:1], self.positions[:0], self.bounds)
        known = np.flatnonzero(vocabulary[np.minimum(np.searchsorted(vocabulary, self.terms), len(vocabulary) - 1)] == self.terms)
        sizes = np.diff(self.offsets)[known]
        return Segment(self.terms[known], np.concatenate([[0], np.cumsum(sizes)]), self.positions[spread(self.offsets[known], sizes)], self.bounds)

    def _present(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of windows that have all their terms here, and the terms' places, rarest first, as (place, offset) pairs."""
        if not len(self.terms):
            return np.zeros(0, np.int64), np.zeros((0, windows.shape[1], 2), np.int64)
        place = np.minimum(np.searchsorted(self.terms, windows), len(self.terms) - 1)
        whole = np.flatnonzero((self.terms[place] == windows).all(axis=1))
        place = place[whole]
        rare = np.argsort(np.diff(self.offsets)[place], axis=1, kind="stable")
        return whole, np.stack([np.take_along_axis(place, rare, axis=1), rare], axis=2)

    def _lists(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The postings of the given terms, one after the other, and for each posting its index in place."""
        n = np.diff(self.offsets)[place]
        return self.positions[spread(self.offsets[place], n)], np.repeat(np.arange(len(place)), n)

    def _keyed(self, span: int) -> np.ndarray:
        """All postings as term * span + position, ascending."""
        return np.repeat(np.arange(len(self.terms)), np.diff(self.offsets)) * span + self.positions

    def phrases(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact matches: (window, first word) pairs."""
        size = windows.shape[1]
        whole, terms = self._present(windows)
        starts, of = self._lists(terms[:, 0, 0]) if len(whole) else (np.zeros(0, np.int64),) * 2
        starts = starts - terms[of, 0, 1]
        text = np.searchsorted(self.bounds, starts, side="right") - 1
        fits = (starts >= 0) & (text >= 0) & (starts + size <= self.bounds[np.clip(text + 1, 0, len(self.bounds) - 1)])
        starts, of = starts[fits], of[fits]
        span = int(self.bounds[-1]) + size + 1
        lists = self._keyed(span)
        for i in range(1, size):
            if not len(starts):
                break
            want = terms[of, i, 0] * span + starts + terms[of, i, 1]
            hit = lists[np.minimum(np.searchsorted(lists, want), len(lists) - 1)] == want
            starts, of = starts[hit], of[hit]
        return whole[of], starts

    def near(self, windows: np.ndarray, reach: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
        """Proximity matches: (window, word) pairs where some `reach` consecutive words of the word's text, this word of the window's
        rarest term among them, hold all terms of the window."""
        whole, terms = self._present(windows)
        centre, of = self._lists(terms[:, 0, 0]) if len(whole) else (np.zeros(0, np.int64),) * 2
        span = int(self.bounds[-1]) + 2 * reach + 2
        lists = self._keyed(span)

        def holds(low: np.ndarray, high: np.ndarray, of: np.ndarray, i: int) -> np.ndarray:
            at = np.searchsorted(lists, terms[of, i, 0] * span + low)
            return (at < len(lists)) & (lists[np.minimum(at, len(lists) - 1)] <= terms[of, i, 0] * span + high)

        text = np.searchsorted(self.bounds, centre, side="right") - 1
        first, last = self.bounds[text], self.bounds[np.minimum(text + 1, len(self.bounds) - 1)] - 1
        for i in range(1, windows.shape[1]):  # every term within reach at all
            if not len(centre):
                break
            hit = holds(np.maximum(centre - reach + 1, first), np.minimum(centre + reach - 1, last), of, i)
            centre, of, first, last = centre[hit], of[hit], first[hit], last[hit]
        found = np.zeros(len(centre), bool)
        for back in range(reach):
            some = np.flatnonzero(~found & (centre - back >= first))
            for i in range(1, windows.shape[1]):
                low = centre[some] - back
                some = some[holds(low, np.minimum(low + reach - 1, last[some]), of[some], i)]
            found[some] = True
        return whole[of[found]], centre[found]


INDEX = "row_file array<long>, row_at array<long>, doc_id array<long>, n_words array<long>, terms binary, sizes binary, gaps binary"


def build_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """Segments of docs, with all their postings, as a table in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in ta.slices(batches, max_bytes=1 << 20):
            segment = Segment.build(ta.pieces(batch.column(3)))
            keys = [pa.array([c.to_pylist()], pa.list_(pa.int64())) for c in (*batch.columns[:3], pa.array(np.diff(segment.bounds)))]
            yield pa.record_batch([*keys, *[pa.array([f], pa.binary()) for f in segment.packed()]], names=["row_file", "row_at", "doc_id", "n_words", "terms", "sizes", "gaps"])

    keyed, names = with_row_key(docs)
    rows = keyed.select(*[F.col(n).alias(a) for n, a in zip(names, ("row_file", "row_at"))], F.col("doc_id").cast("long"), F.col(f"`{text}`").alias("text"))
    return stored(rows.mapInArrow(run, INDEX).withColumn("segment", F.monotonically_increasing_id()), "postings")


@dataclass
class Hits:
    """Of the texts of a segment: disjoint spans of hit words, and the items hit, each with the text's index."""

    spans: list[np.ndarray]
    items: list[np.ndarray]
    near: list[np.ndarray]


def matches(segment: Segment, queries: Queries) -> Hits:
    """spans: (text, start, end) relative to the text; items and near: distinct (text, item) of exact and of proximity matches."""
    n, texts = int(segment.bounds[-1]), len(segment.bounds) - 1
    edges, pairs = np.zeros(n + 1, np.int64), ([], [])
    segment = segment.of_terms(queries.vocabulary)
    for windows, items in zip(queries.windows, queries.items):
        sizes = np.fromiter(map(len, items), np.int64, len(items))
        flat = np.fromiter((i for own in items for i in own), np.int64, int(sizes.sum()))
        begins = np.cumsum(sizes) - sizes
        exact = segment.phrases(windows)
        edges += np.bincount(exact[1], minlength=n + 1) - np.bincount(exact[1] + windows.shape[1], minlength=n + 1)
        for out, (which, at) in zip(pairs, (exact, segment.near(windows))):
            text = np.searchsorted(segment.bounds, at, side="right") - 1
            both = np.repeat(text, sizes[which]) * len(queries.names) + flat[spread(begins[which], sizes[which])]
            out.append(np.unique(both))
    hit = np.cumsum(edges[:-1]) > 0
    change = np.zeros(n + 1, bool)
    change[1:-1] = hit[1:] != hit[:-1]
    change[segment.bounds] = True  # spans end with their text
    cuts = np.flatnonzero(change)
    full = np.flatnonzero(hit[cuts[:-1]]) if n else np.zeros(0, np.int64)
    text = np.searchsorted(segment.bounds, cuts[:-1][full], side="right") - 1
    low = segment.bounds[text] if n else text
    spans = [text, cuts[:-1][full] - low, cuts[1:][full] - low] if n else [text] * 3
    named = [np.unique(np.concatenate(p)) if p else np.zeros(0, np.int64) for p in pairs]
    width = max(1, len(queries.names))
    return Hits(spans, *([x // width, x % width] for x in named)) if texts else Hits([text] * 3, [text] * 2, [text] * 2)


HITS = "segment long, slot int, starts array<long>, ends array<long>, items array<string>, near array<string>"


def search(index: DataFrame, queries: Queries) -> DataFrame:
    """HITS: a row for each text that a window matches, exactly or by proximity; slot is its place in the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                segment, n_words, *fields = (batch.column(c)[k].as_py() for c in range(5))
                found = matches(Segment.unpacked(*fields, np.array(n_words, np.int64)), queries)
                slots = np.unique(np.concatenate([found.spans[0], found.items[0], found.near[0]]))
                names = np.array(queries.names, object)
                columns = [pa.array(np.full(len(slots), segment)), pa.array(slots.astype(np.int32))]
                for of, values, kind in ((found.spans[0], found.spans[1], pa.int64()), (found.spans[0], found.spans[2], pa.int64()), (found.items[0], names[found.items[1]], pa.string()), (found.near[0], names[found.near[1]], pa.string())):
                    ends = np.concatenate([[0], np.searchsorted(of, slots, side="right")]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind)))
                yield pa.record_batch(columns, names=["segment", "slot", "starts", "ends", "items", "near"])

    return index.select("segment", "n_words", "terms", "sizes", "gaps").mapInArrow(run, HITS)


def search_all(index: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """HITS over the whole benchmark, block by block; a text has a row for each block that hits it."""
    parts = None
    for queries in query_blocks(benchmark, block_bytes):
        found = stored(search(index, queries), "hits")
        parts = found if parts is None else parts.union(found)
    return parts


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items) for each document.

    n_near_items: items of which a window has a proximity match, exact matches among them.
    """
    index = build_index(docs)
    merged = search_all(index, benchmark, block_bytes).groupBy("segment", "slot").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items", "near")])
    # spans of one block are disjoint; of several they are put together
    spans = F.array_sort(F.arrays_zip("starts", "ends"))
    total = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("done")), _cover, lambda s: s["n"])
    names = F.array_sort(F.array_distinct("items"))
    hits = merged.select("segment", "slot", total.alias("n_hit"), F.size(names).cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), F.size(F.array_distinct("near")).cast("long").alias("n_near_items"))
    texts = index.select("segment", F.posexplode(F.arrays_zip("doc_id", "n_words")).alias("slot", "d")).select("segment", "slot", "d.doc_id", "d.n_words")
    zero = F.lit(0).cast("long")
    found = texts.join(hits, ["segment", "slot"], "left").withColumns({"n_hit": F.coalesce("n_hit", zero), "n_items": F.coalesce("n_items", zero), "n_near_items": F.coalesce("n_near_items", zero)})
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "n_near_items")


def _cover(state, span):
    """Words in the union of spans so far, and its end; spans come by start."""
    low = F.greatest(state["done"], span["starts"])
    return F.struct((state["n"] + F.greatest(span["ends"] - low, F.lit(0))).alias("n"), F.greatest(state["done"], span["ends"]).alias("done"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of docs, all columns as they are, in which no window of the benchmark occurs, by a search of their stored index."""
    keyed, names = with_row_key(docs)
    index = build_index(keyed)
    hit = search_all(index, benchmark, block_bytes).where("size(starts) > 0").select("segment", "slot").distinct()
    rows = index.select("segment", F.posexplode(F.arrays_zip("row_file", "row_at")).alias("slot", "d")).join(hit, ["segment", "slot"])
    dirty = stored(rows.select("d.row_file", "d.row_at").toDF(*names), "dirty")
    dropped(index)
    return with_columns_of(keyed.join(dirty, names, "left_anti"), docs)


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of all documents by the whole benchmark."""
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the benchmark beside them doesn't contaminate."""
    return keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS gw, array_to_string(list_slice(w, i, i + 9), ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), words AS (
  SELECT rid, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS p FROM d
), dw AS (
  SELECT rid, p AS i, n, array_to_string(v[1:n], ' ') AS g
  FROM (SELECT rid, p, list(term) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS v FROM words), (SELECT DISTINCT n FROM win) WHERE len(v) >= n
), hits AS (
  SELECT DISTINCT dw.rid, win.item_id, dw.i, dw.n FROM dw JOIN win ON dw.g = win.g AND dw.n = win.n
), rare AS (  -- each window's term of the fewest documents, and the places of that term
  SELECT g, gw, term FROM (
    SELECT g, gw, term, row_number() OVER (PARTITION BY g ORDER BY df, term) AS k
    FROM (SELECT DISTINCT g, gw, unnest(gw) AS term FROM win) JOIN (SELECT term, count(*) AS df FROM (SELECT DISTINCT rid, term FROM words) GROUP BY term) USING (term)
  ) WHERE k = 1
), places AS (
  SELECT DISTINCT rid, gw, g, p FROM rare JOIN words USING (term)
), around AS (
  SELECT rid, g, gw, list_slice(w, greatest(p - 19, 1), p + 19) AS a, p - greatest(p - 19, 1) + 1 AS c FROM places JOIN d USING (rid)
), near AS (
  SELECT DISTINCT rid, g FROM (SELECT rid, g, gw, a, unnest(range(1, c + 1)) AS s FROM around WHERE list_has_all(a, gw)) WHERE list_has_all(list_slice(a, s, s + 19), gw)
), near_items AS (
  SELECT rid, count(DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null')) AS n_near_items FROM near JOIN win USING (g) GROUP BY rid
), hit_words AS (
  SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rid
), hit_items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, coalesce(CAST(item_id AS VARCHAR), 'null') AS item FROM hits) GROUP BY rid
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(n_near_items, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid) LEFT JOIN near_items USING (rid)
"""
