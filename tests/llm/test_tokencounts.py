import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane.llm import tokencounts as tc
from terravane.llm.bpe import merger

from ..conftest import DATA
from .conftest import ODD

PIECES = ["a", " ", "\n", "it's", "'", "ll", " the", "é", "12", "!", "  ", "\t", "\r\n", "　", "x" * 90, " " + "word" * 20, " one two three four" * 20, "日本語。" * 30, " " * 300]


def count(data):
    return len(merger().encode([data])[0]) // 4


def whole(data, at):
    at = min(at, len(data))
    while 0 < at < len(data) and (data[at] & 0xC0) == 0x80:
        at -= 1
    return at


def edited(data, a, b, new):
    a = whole(data, a)
    return data[:a] + new + data[whole(data, max(a, b)) :]


@given(st.integers(0, 10**6))
@settings(max_examples=120, deadline=None)
def test_edits_equal_counting_again(seed):
    rng, m = random.Random(seed), merger()
    data = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 150))).encode()
    forest = tc.trees([data], m)
    assert forest[0].n_tokens == count(data)
    for _ in range(6):
        a = rng.randint(0, len(data) + 3)
        b = a + rng.choice([0, 0, 1, 2, 7, 60, 10_000])
        new = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 0, 1, 20]))).encode()
        data = edited(data, a, b, new)
        tc.edit_all(forest, [(a, b, new)], m)
        assert forest[0].text == data and forest[0].n_tokens == count(data) and forest[0].n_bytes == len(data)
        leaves = forest[0].sums[1][forest[0].size :][: len(forest[0].leaves)]
        assert leaves == [count(x) for x in forest[0].leaves]


@given(st.lists(st.sampled_from([" ", "a", "'", "s", "\n", "1", ".", "é"]), max_size=14), st.integers(0, 14), st.integers(0, 4), st.sampled_from(["", " ", "a", "'", "s", "\n", "  ", "x 'l"]))
@settings(max_examples=400, deadline=None)
def test_tiny_leaves(chars, at, gone, new):
    """Leaves of a pre-token or two, so that every boundary is met."""
    data, m = ("x" * 9 + " " + "".join(chars)).encode(), merger()
    forest = tc.trees([data], m, leaf_bytes=1)
    tc.edit_all(forest, [(9 + at, 9 + at + gone, new.encode())], m)
    assert forest[0].text == edited(data, 9 + at, 9 + at + gone, new.encode())
    assert forest[0].n_tokens == count(forest[0].text)


@pytest.mark.parametrize("text", ["plain words all the way ", "日本語のテキスト、句読点。", "été naïve, où çà Łódź "])
def test_only_the_region_is_encoded_again(text):
    forest = tc.trees([(text * 4000).encode()], merger())
    assert len(forest[0].leaves) > 200
    assert tc.edit_all(forest, [(50_000, 50_003, b"xyz")], merger())[0] < 4 * tc.LEAF_BYTES


def check(rows, texts, edits):
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.n_tokens, r.n_bytes) == (count(data), len(data))
        for e in edits.get(r.doc_id, []):
            data = edited(data, e.at, e.end, (e.insert or "").encode())
        assert (r.n_tokens_edited, r.edited_crc32, r.n_bytes_edited) == (count(data), zlib.crc32(data), len(data))


def by_doc(edits):
    out = {}
    for e in sorted(edits, key=lambda e: e.seq):
        out.setdefault(e.doc_id, []).append(e)
    return out


def test_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = tc.op3_token_counts(spark, DATA).collect()
    assert len(rows) == len(texts) and {r.n_edits for r in rows} == {3}
    check(rows, texts, by_doc(tc.sample_edits(docs).collect()))


def test_odd_rows(docs_of):
    docs = docs_of(ODD).withColumn("n_leaves", F.lit("clash")).withColumn("edits", F.lit("clash"))
    edits = tc.sample_edits(docs, 2)
    rows = tc.apply_edits(docs, tc.build_trees(docs), edits).collect()
    assert len(rows) == len(ODD)
    check(rows, dict(enumerate(ODD)), by_doc(edits.collect()))
    assert tc.apply_edits(docs_of([]), tc.build_trees(docs_of([])), edits).count() == 0


def test_edits_table(spark, docs_of):
    """Repeated and null ids, unknown ids, ties of seq, null inserts; edited trees are edited again."""
    docs = docs_of(["one two", "one two", "three", "four", None], ids=[1, 1, 1, None, 2])
    edits = spark.createDataFrame([(1, 1, 3, 3, "!"), (1, 2, 0, 1, None), (None, 1, 0, 9, "x"), (77, 1, 0, 9, "x"), (2, 5, 4, 9, "new")], "doc_id long, seq int, at int, end int, insert string")
    done = tc.apply_edits(docs, tc.build_trees(docs), edits)
    assert sorted((r.doc_id or 0, r.text) for r in done.collect()) == [(0, "four"), (1, "hr!ee"), (1, "ne! two"), (1, "ne! two"), (2, "new")]
    again = tc.apply_edits(done.select("doc_id", "text"), done.drop("text").dropDuplicates(["doc_id", "text_hash"]), edits.where("doc_id = 2"))
    assert all(r.n_tokens_edited == count(r.text.encode()) for r in again.collect())
    assert tc.apply_edits(docs, tc.build_trees(docs), edits.limit(0)).where("n_edits = 0").count() == 5
