import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terravane.llm import quality
from terravane.llm import textarrays as ta
from terravane.llm.labelled import bounded

from ..conftest import DATA
from .conftest import ODD

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_counts_equal_brute_force(docs_of, spark):
    texts = [*ODD, "a b c a b c", "x\nx\n y\n\nx", "é é é é", "#$ *|<>", "a\x00b c\u2028d", *[r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(80).collect()]]
    rows = quality.judge(docs_of(texts).withColumn("kept", F.lit("clash")), None).orderBy("doc_id").collect()
    for r, text in zip(rows, texts):
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute_force(text or "")
        assert r.base_failed == (got[0] < 50 or 100 * got[4] > 50 * got[0]) and r.kept == (not r.base_failed)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2
    model = quality.train(docs, labels.where(fold == 0))
    rows = quality.judge(docs.where(fold == 1), model).join(labels, "doc_id").toPandas()
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert (good.probability >= quality.KEEP_AT).mean() > 0.98
    print("bad rows below the threshold by the classifier alone:", (bad.probability < quality.KEEP_AT).mean())
    assert (bad.probability < quality.KEEP_AT).mean() > 0.5 and (~bad.kept).mean() > 0.95  # with the base rules


def test_no_labels(spark, docs_of):
    assert quality.train(docs_of(["a b"]), spark.createDataFrame([], "doc_id long, quality int")) is None
    assert quality.judge(docs_of([]), None).count() == 0


def test_kept_rows_keep_their_columns(docs_of):
    docs = docs_of([" ".join(f"w{i}" for i in range(60)), "short", None]).withColumn("probability", F.lit(2))
    kept = quality.keep_good(docs, None)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [0]


def test_platt_is_monotone():
    a, _ = quality.platt(np.array([-2.0, -1, 1, 2]), np.array([0, 0, 1, 1]))
    assert a > 0


def test_sample_is_bounded_in_bytes(spark):
    rows = [(i, "x" * (10 if i % 7 else 5000), 1) for i in range(50)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    found = bounded(sample, 200).collect()
    assert sum(len(r.text) for r in found) == 200
    assert bounded(sample, 5).count() == 0 and bounded(sample, 10**6).count() == 50


def plain_grams(text):
    """Bins and values of a text's features, gram by gram."""
    u = np.uint64
    lone = lambda b: ta.span_hashes(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0]
    words = [lone(w.encode()) for w in WORD.findall(text)]
    chars = [lone(c.encode()) for c in text]
    one = lambda x: ta.mix(np.array([x], u))[0]
    with np.errstate(over="ignore"):
        kinds = [[h * quality.ODD for h in words], [one(a * u(3) + b) for a, b in zip(words, words[1:])]]
        kinds += [[one(sum((chars[i + k] * quality.GRAM_PLACES[k] for k in range(n)), u(0))) for i in range(len(chars) - n + 1)] for n in (3, 4)]
    out = Counter()
    for grams in kinds:
        for g in grams:
            out[int(g >> quality.TO_BIN)] += 1 / len(grams)
    return out


@given(st.lists(st.text("ab é日\n \t#\x00", max_size=14), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_features_and_scores_equal_brute_force(texts):
    words = ta.Words([t.encode() for t in texts], lower=False, is_word=ta.NOT_SPACE)
    grams = quality.Grams(words)
    weights = np.random.default_rng(1).normal(size=1 << quality.BITS)
    for text, (bins, values), score in zip(texts, grams.rows(len(texts)), grams.scores(weights)):
        want = plain_grams(text)
        assert dict(zip(bins.tolist(), np.round(values, 9).tolist())) == {b: round(v, 9) for b, v in want.items()}
        assert abs(score - sum(weights[b] * v for b, v in want.items())) < 1e-9


def test_features_of_the_sample_are_small():
    bins, values = quality.rows_of([b"one two three two"])[0]
    assert bins.dtype.itemsize == 4 and abs(values.sum() - 4) < 1e-9  # four kinds, each of weight one
