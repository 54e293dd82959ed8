"""Near-duplicate documents: DartMinHash signatures, banded candidates, exact verification, connected components.

A text is the weighted set of its five-word shingles (words as in textarrays.Words, lower-cased): the weight of a shingle is how often
it occurs. Similarity is the weighted Jaccard similarity, the sum of the lesser weights over that of the greater ones; 0.8 and more is a
link, and a class is a connected component of links.

1. Every text gets a 128-bit fingerprint of its words and a DartMinHash signature of the weighted set. Texts of equal fingerprint are one
   node, so copies, however many, cost one row from here on.
2. Nodes that agree on all rows of a band share a bucket. Each bucket links its members to one leader, drawn by a hash, so a
   bucket of n members gives n - 1 candidates. Candidates whose signatures agree on too few coordinates to be a link go; the
   rest are verified on whole shingle sets.
3. A bucket whose members lie in one component is done. In the others the members outside the largest component meet all
   members, in tiles of bounded size; a tile passes on only pairs that join two components, so its output is linear.
4. What those tiles hold possible is verified the same way on shingle sets, again tile by tile.

With 24 bands of 4 rows a pair at similarity 0.8 shares no bucket with a chance of 3e-6, and fails the agreement test with
one of 1e-6 at exactly 0.8 and much less above it.

Edge cases: null, empty and wordless texts have no shingles and are never linked, not even to each other: each is its own
class. A text of one to four words is one shingle. Repeated rows are copies; rows of one doc_id but different texts are told apart by
their text. Rows are found again by their place in the input's files, so a hot or null doc_id is no join key.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import textarrays as ta
from terravane.llm.components import components
from terravane.llm.dartminhash import signatures
from terravane.llm.jobs import dropped, read_table, runs, stored, with_columns_of, with_row_key
from terravane.llm.slicecache import spread

BANDS, BAND_ROWS = 24, 4
K = BANDS * BAND_ROWS
THRESHOLD = 0.8
#: Least share of agreeing coordinates for a pair to be verified: more than five standard deviations below 0.8.
POSSIBLE = 0.58
#: Most members, and most minority members, in a tile.
TILE = 256


def shingle_sets(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, ta.Words]:
    """Shingles of the texts, distinct and sorted for each, the bounds of each text's, how often each occurs, and the words."""
    words = ta.Words(parts)
    hashes, bounds = ta.shingles(words, 5)
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        hashes[a:b].sort()
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[bounds[:-1][np.diff(bounds) > 0]] = True
    at = np.flatnonzero(fresh)
    return hashes[at], np.searchsorted(at, bounds), np.diff(np.append(at, len(hashes))), words


def expanded(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """A weighted set as a plain one of the same similarity: the k-th occurrence of an element is an element of its own."""
    often = np.flatnonzero(counts > 1)
    if len(often):
        again = spread(np.ones(len(often), np.int64), counts[often] - 1).astype(np.uint64)
        with np.errstate(over="ignore"):
            hashes = np.sort(np.concatenate([hashes, ta.mix(np.repeat(hashes[often], counts[often] - 1) + again * np.uint64(ta.BASE))]))
    return hashes.tobytes()


def fingerprints(words: ta.Words) -> list[bytes]:
    return [blake2b(words.hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(words.bounds, words.bounds[1:])]


SKETCH = "row_file long, row_at long, doc_id long, node binary, sig binary, bands array<long>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SKETCH; node, sig and bands are null where a text has no words."""
    for batch in ta.slices(batches):
        hashes, bounds, counts, words = shingle_sets(ta.pieces(batch.column(3)))
        marks = signatures(hashes, bounds, K, counts)
        with np.errstate(over="ignore"):
            keys = np.ascontiguousarray(marks).view(np.uint64).reshape(batch.num_rows, BANDS)
            keys = ta.mix(keys + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(ta.BASE)).view(np.int64)
        bare = np.diff(bounds) == 0
        data, width = marks.tobytes(), 2 * K
        columns = [
            pa.array([None if no else x for no, x in zip(bare.tolist(), fingerprints(words))], pa.binary()),
            pa.array([None if no else data[i * width : i * width + width] for i, no in enumerate(bare.tolist())], pa.binary()),
            pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), BANDS, mask=pa.array(bare)).cast(pa.list_(pa.int64())),
        ]
        yield pa.record_batch([*batch.columns[:3], *columns], names=["row_file", "row_at", "doc_id", "node", "sig", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, node) to (node, set)."""
    for batch in ta.slices(batches):
        hashes, bounds, counts, _ = shingle_sets(ta.pieces(batch.column(0)))
        sets = [expanded(hashes[a:b], counts[a:b]) for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        yield pa.record_batch([batch.column(1), pa.array(sets, pa.binary())], names=["node", "set"])


def overlap(x: np.ndarray, y: np.ndarray) -> float:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / max(1, len(x) + len(y) - both)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
        ok = [overlap(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= THRESHOLD for x, y in zip(left, right)]
        yield pa.record_batch([pa.array([p for p, good in zip(a, ok) if good], pa.binary()), pa.array([p for p, good in zip(b, ok) if good], pa.binary())], names=["a", "b"])


def signature_hits(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Which pairs agree on POSSIBLE of the coordinates."""
    x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(len(s), K) for s in (left, right))
    same = np.zeros((len(x), len(y)), np.uint8)
    for j in range(K):
        same += x[:, j, None] == y[None, :, j]
    return same >= POSSIBLE * K


def set_hits(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Which pairs of shingle sets have a similarity of THRESHOLD or more."""
    xs, ys = ([np.frombuffer(s, np.uint64) for s in side] for side in (left, right))
    nx, ny = np.array([len(s) for s in xs]), np.array([len(s) for s in ys])
    terms, of = np.unique(np.concatenate(xs + ys), return_inverse=True)
    a, b = np.zeros((len(xs), 1), np.int32), np.zeros((1, len(ys)), np.int32)
    both = a + b
    step = 1 << 14
    rows, cols = np.repeat(np.arange(len(xs)), nx), np.repeat(np.arange(len(ys)), ny)
    of_x, of_y = of[: nx.sum()], of[nx.sum() :]
    for low in range(0, len(terms), step):
        m, n = np.zeros((len(xs), min(step, len(terms) - low)), np.float32), np.zeros((len(ys), min(step, len(terms) - low)), np.float32)
        px, py = (of_x >= low) & (of_x < low + step), (of_y >= low) & (of_y < low + step)
        m[rows[px], of_x[px] - low] = 1
        n[cols[py], of_y[py] - low] = 1
        both += np.rint(m @ n.T).astype(np.int32)
    return both >= THRESHOLD * (nx[:, None] + ny[None, :] - both)


def _tiles(hits):
    """For each tile: pairs of components that a hit joins, without those that follow from others of the tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, "tile"):
            comp, data, minor = (table.column(c).to_pylist() for c in ("comp", "data", "minor"))
            few, all_ = [i for i, m in enumerate(minor) if m], [i for i, m in enumerate(minor) if not m]
            if not few or not all_:
                continue
            found = hits([data[i] for i in few], [data[i] for i in all_])
            up = {c: c for c in comp}

            def top(c, up=up):
                while up[c] != c:
                    up[c] = up[up[c]]
                    c = up[c]
                return c

            a, b = [], []
            for x, y in zip(*np.nonzero(found)):
                p, q = top(comp[few[x]]), top(comp[all_[y]])
                if p != q:
                    up[max(p, q)] = min(p, q)
                    a.append(comp[few[x]])
                    b.append(comp[all_[y]])
            if a:
                yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return run


def _meet(groups: DataFrame, data: DataFrame, hits) -> DataFrame:
    """Pairs of components, (a, b), that a hit between members of one group joins.

    groups: group, node, comp; data: node, data. Members outside a group's largest component meet all its members; both sides
    are dealt to tiles of about TILE by hashes, so no task holds a whole group.
    """
    sizes = groups.groupBy("group", "comp").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("group").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"))
    largest = largest.where("n > most").withColumn("across", F.ceil(F.col("n") / TILE).cast("int")).withColumn("down", F.ceil((F.col("n") - F.col("most")) / TILE).cast("int"))
    rows = groups.join(largest, "group").join(data, "node")
    everyone = rows.withColumn("x", F.pmod(F.xxhash64("node"), "across")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("down") - 1))).withColumn("minor", F.lit(False))
    minority = rows.where("comp <> main").withColumn("y", F.pmod(F.xxhash64("node", F.lit(1)), "down")).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("across") - 1))).withColumn("minor", F.lit(True))
    columns = [F.xxhash64("group", F.col("x").cast("long"), F.col("y").cast("long")).alias("tile"), "comp", "data", "minor"]
    tiles = everyone.select(*columns).union(minority.select(*columns))
    tiles = tiles.repartition("tile").sortWithinPartitions("tile")
    return tiles.mapInArrow(_tiles(hits), "a binary, b binary")


def classified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """SKETCH's first four columns for each row of docs, and the label and n_copies of each node.

    docs: as with_row_key gives them.
    """
    docs = docs.select(F.col("row_file"), F.col("row_at"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = stored(docs.mapInArrow(_sketch, SKETCH), "sketch")
    worded = sketch.where("node is not null")
    first = F.first(F.struct("row_file", "row_at", "sig", "bands"))
    nodes = stored(worded.groupBy("node").agg(F.count("*").alias("n_copies"), first.alias("s")).select("node", "n_copies", "s.*"), "nodes")

    # keys of all bands meet as two longs a row; nodes and signatures are fetched for shared buckets only
    rows = nodes.select("node", F.posexplode("bands").alias("band", "key")).select("node", F.xxhash64("band", "key").alias("group")).withColumn("draw", F.xxhash64("group", "node"))
    shared = rows.groupBy("group").agg(F.count("*").alias("n"), F.min("draw").alias("first")).where("n > 1").drop("n")
    buckets = stored(rows.join(shared, "group").select("group", "node", (F.col("draw") == F.col("first")).alias("leads")), "buckets")

    wanted = buckets.select("node").distinct().join(nodes.select("node", "row_file", "row_at"), "node")
    sets = stored(docs.join(wanted, ["row_file", "row_at"]).select("text", "node").mapInArrow(_sets, "node binary, set binary"), "sets")

    leaders = buckets.where("leads").select("group", F.col("node").alias("a"))
    stars = buckets.where("not leads").select("group", F.col("node").alias("b")).join(leaders, "group").select("a", "b").where("a <> b").distinct()
    stars = stars.join(nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b").join(nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
    agree = F.expr(f"size(filter(sequence(0, {K - 1}), i -> substring(sig_a, 2 * i + 1, 2) = substring(sig_b, 2 * i + 1, 2)))")
    stars = stars.where(agree >= POSSIBLE * K).select("a", "b")
    pairs = stars.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b").join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    pairs = pairs.select("a", "b", "set_a", "set_b")
    links = stored(pairs.mapInArrow(_verify, "a binary, b binary"), "links")
    comps = stored(components(links), "comps")

    known = comps.select("node", F.col("label").alias("comp"))
    members = buckets.join(known, "node", "left").select("group", "node", F.coalesce("comp", "node").alias("comp"))
    possible = stored(_meet(members, nodes.select("node", F.col("sig").alias("data")), signature_hits), "possible")

    clusters = components(possible).select(F.col("node").alias("comp"), F.xxhash64("label").alias("group"))
    inside = sets.join(known, "node", "left").select("node", F.coalesce("comp", "node").alias("comp")).join(clusters, "comp").select("group", "node", "comp")
    more = stored(_meet(inside, sets.select("node", F.col("set").alias("data")), set_hits), "more")

    # what `more` joins are components of links: their labels alone are joined anew
    joined = components(more).select(F.col("node").alias("comp"), F.col("label").alias("whole"))
    classes = nodes.select("node", "n_copies").join(known, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    classes = classes.join(joined, "comp", "left").select("node", "n_copies", F.coalesce("whole", "comp").alias("label"))
    classes = stored(classes, "classes")
    dropped(nodes, buckets, sets, links, comps, possible, more)
    return sketch.select("row_file", "row_at", "doc_id", "node"), classes


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, n_copies) for each row of docs, as the module describes.

    class_id: the least doc_id of the class (the doc_id itself where it is alone); n_copies: rows of the same words. A null doc_id
    counts as the largest. Other columns of docs aren't read.
    """
    rows, classes = classified(_with_key(docs, doc_id, text), doc_id, text)
    least = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(classes, "node")
    least = stored(least, "least")
    named = least.select("node", "label", "n_copies").join(least.groupBy("label").agg(F.min("least").alias("class_id")), "label").select("node", "class_id", "n_copies")
    linked = rows.where("node is not null").join(named, "node").select("doc_id", "class_id", "n_copies")
    bare = rows.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("n_copies"))
    return linked.union(bare)


def _with_key(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    keyed, (row_file, row_at) = with_row_key(docs)
    return keyed.select(F.col(row_file).alias("row_file"), F.col(row_at).alias("row_at"), F.col(f"`{doc_id}`"), F.col(f"`{text}`"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document: its class of near copies."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def keep_one(docs: DataFrame) -> DataFrame:
    """Exactly one row of each class, all columns as they are: that of the least doc_id (null is the largest), of those the one whose
    words have the least fingerprint, of those the first in the input's files. Rows without words always stay."""
    keyed, names = with_row_key(docs)
    rows, classes = classified(keyed.select(*[F.col(n).alias(a) for n, a in zip(names, ("row_file", "row_at"))], "doc_id", "text"))
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "node", "row_file", "row_at").alias("place")
    best = rows.where("node is not null").groupBy("node").agg(F.min(place).alias("place")).join(classes, "node").groupBy("label").agg(F.min("place").alias("place"))
    bare = rows.where("node is null").select("row_file", "row_at")
    kept = stored(best.select("place.row_file", "place.row_at").union(bare).toDF(*names), "kept")
    return with_columns_of(keyed.join(kept, names, "left_semi"), docs)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs without near copies of documents that stay."""
    return keep_one(docs)
