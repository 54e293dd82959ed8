"""Token counts that follow edits.

A document is a row of leaves, each some hundred bytes of whole pre-tokens, under a tree of sums of bytes and tokens. `build_trees`
stores a tree for each document; `apply_edits` joins stored trees with a table of edits and the texts, finds the leaves of an
edit by descending the sums, encodes only these again and updates the sums on their way to the root.

The region of an edit is the leaves that it touches, from the last leaf that begins eight bytes or more before it (whether a pre-token
begins at a place depends on the two characters after it at most). Behind the region the following leaf lends its first characters as
context: if a pre-token still begins where that leaf does, nothing behind changes; else the leaf joins the region. A region becomes one
leaf; one that has grown to several times its size is split again, which rebuilds the tree from its leaves' counts.

Edge cases: a null text is an empty one: one empty leaf, no tokens. Offsets are bytes of the text as the edits before left it, moved
back to the next boundary of characters; those beyond the end append. An edit of a null or unknown doc_id touches nothing; an edit of
a repeated id is applied to each row of it. Repeated rows share a stored tree and are edited each by itself. A null insert is an
empty one. Edits of one document are applied in the order of seq, then at, end and insert; as each needs the one before, they are one
row's work.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import textarrays as ta
from terravane.llm.bpe import RANKS, Merger, Slices, merger
from terravane.llm.jobs import read_table, stored

LEAF_BYTES = 256
#: A leaf is split once it holds this many times LEAF_BYTES.
SPLIT_AT = 8
#: Bytes before an edit at which a region begins at the latest: two characters.
CONTEXT = 8

Edit = tuple[int, int, bytes]


class TokenTree:
    """leaves: bytes of each leaf; sums[0] and sums[1]: heap-ordered sums of bytes and tokens over a power of two of leaves."""

    def __init__(self, leaves: list[bytes], sums: list[list[int]]):
        self.leaves, self.sums = leaves, sums
        self.size = len(sums[0]) // 2

    @classmethod
    def of(cls, leaves: list[bytes], tokens: list[int]) -> TokenTree:
        return cls(leaves, [heap([len(x) for x in leaves]), heap(tokens)])

    @classmethod
    def stored(cls, text: bytes, byte_sums: list[int], token_sums: list[int], n_leaves: int) -> TokenTree:
        size = len(byte_sums) // 2
        ends = np.cumsum(byte_sums[size : size + n_leaves]).tolist()
        return cls([text[a:b] for a, b in zip([0, *ends], ends)], [byte_sums, token_sums])

    @property
    def n_bytes(self) -> int:
        return self.sums[0][1]

    @property
    def n_tokens(self) -> int:
        return self.sums[1][1]

    @property
    def text(self) -> bytes:
        return b"".join(self.leaves)

    def leaf_at(self, byte: int) -> tuple[int, int]:
        """The leaf that holds a byte, and where the leaf starts. byte: below n_bytes, or 0."""
        sums, i, start = self.sums[0], 1, 0
        if not self.n_bytes:
            return 0, 0
        while i < self.size:
            i *= 2
            if byte - start >= sums[i]:
                start += sums[i]
                i += 1
        return i - self.size, start

    def _whole(self, byte: int) -> int:
        """The boundary of characters at or before a byte."""
        byte = min(max(byte, 0), self.n_bytes)
        if byte == self.n_bytes:
            return byte
        leaf, start = self.leaf_at(byte)
        data = self.leaves[leaf]
        while byte > start and (data[byte - start] & 0xC0) == 0x80:
            byte -= 1
        return byte

    def region(self, edit: Edit) -> Region:
        a = self._whole(edit[0])
        b = self._whole(max(a, edit[1]))
        first, start = self.leaf_at(max(min(a, self.n_bytes - 1), 0))
        while start and a - start < CONTEXT:
            first, start = self.leaf_at(start - 1)
        last = max(first, self.leaf_at(min(b, max(self.n_bytes - 1, 0)))[0])
        old = b"".join(self.leaves[first : last + 1])
        return Region(self, first, last, old[: a - start] + edit[2] + old[b - start :])

    def put(self, first: int, last: int, text: bytes, tokens: int) -> None:
        """Make leaves first:last + 1 one leaf of this text; the others of them stay as empty ones."""
        for i in range(first, last + 1):
            self.leaves[i] = text if i == first else b""
            for sums, value in zip(self.sums, (len(text), tokens) if i == first else (0, 0)):
                at = i + self.size
                change = value - sums[at]
                while change and at:
                    sums[at] += change
                    at //= 2


class Region:
    """Leaves first to last of a tree, and the text that replaces theirs."""

    def __init__(self, tree: TokenTree, first: int, last: int, text: bytes):
        self.tree, self.first, self.last, self.text, self.encoded = tree, first, last, text, 0

    def following(self) -> int | None:
        """The next leaf that isn't empty."""
        return next((i for i in range(self.last + 1, len(self.tree.leaves)) if self.tree.leaves[i]), None)

    def context(self) -> bytes:
        """The first characters behind the region."""
        out, i = b"", self.last
        while len(out) < CONTEXT and (i := next((j for j in range(i + 1, len(self.tree.leaves)) if self.tree.leaves[j]), None)) is not None:
            out += self.tree.leaves[i][: 2 * CONTEXT]
        end = min(len(out), CONTEXT)
        while end < len(out) and (out[end] & 0xC0) == 0x80:
            end += 1
        return out[:end]

    def widen(self) -> None:
        self.last = self.following()
        self.text += self.tree.leaves[self.last]


def heap(values: list[int]) -> list[int]:
    size = 1 << max(0, (len(values) - 1).bit_length())
    sums = [0] * size + values + [0] * (size - len(values))
    for i in range(size - 1, 0, -1):
        sums[i] = sums[2 * i] + sums[2 * i + 1]
    return sums


def trees(parts: list[bytes], m: Merger, leaf_bytes: int = LEAF_BYTES) -> list[TokenTree]:
    """A tree for each text, all encoded together; a leaf begins at the first pre-token in each leaf_bytes bytes of its text."""
    cut = Slices(parts)
    counts = m.cache.look_up(cut.data, cut.starts)[1]
    totals = np.concatenate([[0], np.cumsum(counts)])
    at = cut.starts[:-1]
    ends = np.concatenate([[0], np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))])
    out = []
    for text, low, a, b in zip(parts, ends.tolist(), cut.bounds.tolist(), cut.bounds[1:].tolist()):
        own = at[a:b] - low
        begin = np.flatnonzero(np.concatenate([[True], np.diff(own // leaf_bytes) > 0])) if b > a else np.zeros(1, np.int64)
        places = [*own[begin].tolist(), len(text)] if b > a else [0, 0]
        out.append(TokenTree.of([text[x:y] for x, y in zip(places, places[1:])], np.diff(totals[[*(a + begin).tolist(), b]]).tolist() if b > a else [0]))
    return out


def edit_all(forest: list[TokenTree], edits: list[Edit | None], m: Merger) -> list[int]:
    """Apply one edit to each tree, none where it is None; returns the bytes encoded again for each."""
    done = [0] * len(forest)
    todo = [(i, forest[i].region(e)) for i, e in enumerate(edits) if e is not None]
    while todo:
        tails = [r.context() for _, r in todo]
        cut = Slices([r.text + tail for (_, r), tail in zip(todo, tails)])
        counts = m.cache.look_up(cut.data, cut.starts)[1]
        totals = np.concatenate([[0], np.cumsum(counts)])
        wider, low = [], 0
        for k, ((i, r), tail) in enumerate(zip(todo, tails)):
            end = low + len(r.text)
            done[i] += len(r.text) + len(tail)
            place = int(np.searchsorted(cut.starts, end))
            if tail and cut.starts[place] != end:
                r.widen()
                wider.append((i, r))
            else:
                forest[i] = _replaced(r, int(totals[place] - totals[cut.bounds[k]]), m)
            low = end + len(tail)
        todo = wider
    return done


def _replaced(r: Region, tokens: int, m: Merger) -> TokenTree:
    tree = r.tree
    tree.put(r.first, r.last, r.text, tokens)
    if len(r.text) <= SPLIT_AT * LEAF_BYTES:
        return tree
    new = trees([r.text], m)[0]
    if len(new.leaves) == 1:
        return tree
    counts = tree.sums[1][tree.size : tree.size + len(tree.leaves)]
    counts[r.first : r.last + 1] = new.sums[1][new.size : new.size + len(new.leaves)]
    return TokenTree.of([*tree.leaves[: r.first], *new.leaves, *tree.leaves[r.last + 1 :]], counts)


TREE = "doc_id long, text_hash long, n_leaves int, byte_sums array<int>, token_sums array<int>"


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return docs.withColumn("text_hash", F.xxhash64("text", F.octet_length("text")))


def build_trees(docs: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    """TREE: the stored tree of each distinct (doc_id, text), in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in ta.slices(batches):
            forest = trees(ta.pieces(batch.column(1)), m)
            columns = [pa.array([len(t.leaves) for t in forest], pa.int32()), *[pa.array([t.sums[k] for t in forest], pa.list_(pa.int32())) for k in (0, 1)]]
            yield pa.record_batch([batch.column(0), batch.column(2), *columns], names=["doc_id", "text_hash", "n_leaves", "byte_sums", "token_sums"])

    return stored(_keyed(docs, text).mapInArrow(run, TREE).dropDuplicates(["doc_id", "text_hash"]), "token_trees")


def apply_edits(docs: DataFrame, stored_trees: DataFrame, edits: DataFrame, text: str = "text", path: str = RANKS) -> DataFrame:
    """Each document with its edits applied: TREE's columns after them, and more.

    edits: doc_id, seq, at, end, insert (string). Further columns: n_tokens, n_bytes (before), n_edits, n_tokens_edited,
    n_bytes_edited, edited_crc32, n_bytes_encoded_again, text (after).
    """
    fields = "seq long, at long, end long, insert string"
    script = edits.selectExpr("cast(doc_id as long) doc_id", "named_struct('seq', cast(seq as long), 'at', cast(at as long), 'end', cast(end as long), 'insert', coalesce(insert, '')) edit").where("doc_id is not null")
    script = script.groupBy("doc_id").agg(F.sort_array(F.collect_list("edit")).alias("edits"))
    pending = stored_trees.join(script, "doc_id", "left").withColumnsRenamed({"doc_id": "tree_doc", "text_hash": "tree_hash"})
    rows = _keyed(docs, text)
    rows = rows.join(pending, rows.doc_id.eqNullSafe(pending.tree_doc) & (rows.text_hash == pending.tree_hash)).select("doc_id", "text", "n_leaves", "byte_sums", "token_sums", F.coalesce("edits", F.array().cast(f"array<struct<{fields}>>".replace(" long", ":long").replace(" string", ":string"))).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = merger(path)
        for batch in ta.slices(batches):
            leaves, bytes_, tokens, scripts = (batch.column(k).to_pylist() for k in (2, 3, 4, 5))
            forest = [TokenTree.stored(*x) for x in zip(ta.pieces(batch.column(1)), bytes_, tokens, leaves)]
            before = [(t.n_tokens, t.n_bytes) for t in forest]
            again = np.zeros(len(forest), np.int64)
            for turn in range(max(map(len, scripts))):
                now = [(s[turn]["at"], s[turn]["end"], s[turn]["insert"].encode()) if turn < len(s) else None for s in scripts]
                again += edit_all(forest, now, m)
            texts = [t.text for t in forest]
            numbers = [[n for n, _ in before], [n for _, n in before], list(map(len, scripts)), [t.n_tokens for t in forest], [t.n_bytes for t in forest], list(map(zlib.crc32, texts)), again]
            columns = [pa.array([len(t.leaves) for t in forest], pa.int32()), *[pa.array([t.sums[k] for t in forest], pa.list_(pa.int32())) for k in (0, 1)], *[pa.array(n, pa.int64()) for n in numbers], pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.record_batch([batch.column(0), *columns], names=NAMES)

    edited = rows.mapInArrow(run, f"{EDITED}, text string")
    return edited.select("doc_id", F.xxhash64("text", F.octet_length("text")).alias("text_hash"), *edited.columns[1:])


EDITED = TREE.replace(" text_hash long,", "") + ", n_tokens long, n_bytes long, n_edits long, n_tokens_edited long, n_bytes_edited long, edited_crc32 long, n_bytes_encoded_again long"
NAMES = [c.strip().split(" ")[0] for c in EDITED.split(",")] + ["text"]

#: What the edits of `sample_edits` put in.
INSERTS = ["", " revised", "é 2024\n", "'ll", "  ", "日本。"]


def sample_edits(docs: DataFrame, edits: int = 3, text: str = "text") -> DataFrame:
    """`edits` edits for each distinct doc_id: replacements of 0 to 40 bytes at places that hashes of the id give."""
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.coalesce(F.octet_length(text), F.lit(0))).alias("n")).where("doc_id is not null")
    rows = ids.select("doc_id", "n", F.explode(F.sequence(F.lit(1), F.lit(edits))).alias("seq")).withColumn("draw", F.xxhash64("doc_id", "seq"))
    at = F.pmod(F.col("draw"), F.col("n") + 1)
    insert = F.element_at(F.array(*map(F.lit, INSERTS)), (F.pmod(F.shiftright("draw", 16), F.lit(len(INSERTS))) + 1).cast("int"))
    return rows.select("doc_id", "seq", at.alias("at"), (at + F.pmod(F.shiftright("draw", 8), F.lit(41))).alias("end"), insert.alias("insert"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of all documents before and after three edits, by way of stored trees and a table of edits."""
    docs = read_table(spark, sf_dir, "documents")
    edited = apply_edits(docs, build_trees(docs), sample_edits(docs))
    return edited.select("doc_id", "n_tokens", "n_bytes", "n_edits", "n_leaves", "n_tokens_edited", "n_bytes_edited", "edited_crc32", "n_bytes_encoded_again")
