import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from terravane.llm import bpe, decontaminate, pii, quality, registry

from ..conftest import DATA
from .test_neardup import classes_by_brute_force
from .test_quality import brute_force as counts


def by_hand(rows, items, verdicts):
    """Texts that come through, from rows (doc_id, text) by the plain versions of the stages; verdicts: the classifier's, by text."""
    good = [(i, t) for i, t in rows if counts(t or "")[0] >= 50 and 100 * counts(t or "")[4] <= 50 * counts(t or "")[0] and verdicts[t or ""]]
    classes = classes_by_brute_force([t for _, t in good])
    best = {}
    for c, (i, t) in zip(classes, good):
        if c not in best or (i is None, i or 0) < (best[c][0] is None, best[c][0] or 0):
            best[c] = (i, t)
    words = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    windows = {tuple(w[k : k + 10]) for w in map(words, items) for k in range(max(1, len(w) - 9)) if w}
    clean = [(i, t) for i, t in best.values() if not any(tuple(words(t)[k : k + n]) in windows for n in {len(w) for w in windows} for k in range(len(words(t)) - n + 1))]
    return sorted(((i is None, i or 0), len(bpe.merger().encode([pii.masked(t, pii.all_spans(t)[1]).encode()])[0]) // 4) for i, t in clean)


@pytest.fixture
def tables(spark, docs_of, words, tmp_path):
    """Repeated rows, repeated and null ids, empty texts, near copies, a benchmark passage, personal data; columns that clash."""

    def make(rows, items):
        docs = docs_of([t for _, t in rows]).withColumn("n", F.monotonically_increasing_id())
        ids = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(rows)], "k long, id long")
        docs = docs.join(ids, F.col("doc_id") == F.col("k")).select(F.col("id").alias("doc_id"), "text", "lang", "source", "n_chars", F.lit(1).alias("kept_id"), F.lit("x").alias("node"), F.lit(2).alias("row_at"), F.lit(3).alias("segment"))
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return make


def test_odd_rows_against_plain_versions(spark, tables, words):
    a, b, c, d = (words(80, k) for k in range(4))
    item = " ".join(words(12, 90))
    near = " ".join([*a[:79], "changed"])
    rows = [(1, " ".join(a)), (1, " ".join(a)), (1, " ".join(b)), (0, near), (None, " ".join(b)), (5, " ".join(c)), (None, " ".join(c)), (None, None), (None, ""), (3, " "), (7, " ".join([*d, item])), (8, " ".join([*d[:40], "mail joe@example.org", *d[40:]])), (8, "x y " * 60)]
    path = tables(rows, [(1, item), (1, item), (None, None), (2, "")])
    found = corpus_pipeline.run(spark, path).collect()
    verdicts = dict.fromkeys({t or "" for _, t in rows}, True)
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens) for r in found) == by_hand(rows, [item], verdicts)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns


def test_empty_tables(spark, tables):
    assert corpus_pipeline.run(spark, tables([], [])).count() == 0


def test_documents_against_plain_versions(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    judged = quality.judge(docs, quality.train(docs, labels)).select("doc_id", "probability").join(docs.select("doc_id", "text"), "doc_id").collect()
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    want = by_hand([(r.doc_id, r.text) for r in judged], items, {r.text or "": r.probability >= quality.KEEP_AT for r in judged})
    found = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(((False, r.doc_id), r.n_tokens) for r in found) == want


def test_contract():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "personal_data", "byte_level_bpe"]
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 11))
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert decontaminate.WINDOW == 10
