import duckdb
import pytest
from pyspark.sql import functions as F

from terravane.llm import decontaminate as dc

from .conftest import ODD


@pytest.fixture
def bench(spark, words):
    items = [(i, " ".join(words(14, 50 + i))) for i in range(6)] + [(6, "tiny item"), (7, None), (8, "!!!"), (6, "tiny item"), (9, "The")]
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.fixture
def planted(docs_of, words):
    one = words(14, 51)
    texts = [" ".join(words(200, 1)), " ".join([*words(30, 2), *one, *words(30, 3)]), " ".join(one[3:13]).upper(), " ".join(one[:9]), "a tiny, item of the", " ".join(one[:5] + ["x"] + one[5:]), " ".join([*one[7:10], *words(9, 4), *one[:7]]), " ".join([*one[7:10], *words(12, 4), *one[:7]]), *ODD]
    return docs_of(texts)


def oracle(docs, bench):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("benchmark", bench.toPandas())
    return sorted(map(tuple, con.sql(dc.ORACLE).fetchall()))


@pytest.mark.parametrize("block", [dc.BLOCK_BYTES, 64])
def test_equals_sql(planted, bench, block):
    found = dc.contamination(planted.withColumn("items", F.lit("clash")), bench, block)
    rows = found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "n_near_items").collect()
    assert sorted(map(tuple, rows)) == oracle(planted, bench)


def test_clean_rows_stay(planted, bench):
    kept = dc.keep_clean(planted.withColumn("segment", F.lit(1)), bench, 64)
    want = {r[0] for r in oracle(planted, bench) if not r[5]}
    assert {r.doc_id for r in kept.collect()} == want and "segment" in kept.columns


def test_empty_tables(docs_of, planted, bench):
    assert dc.contamination(docs_of([]), bench).count() == 0
    assert dc.contamination(planted, bench.limit(0)).where("contaminated").count() == 0


def test_proximity(docs_of, spark):
    texts = ["blue x x green red", "red green", "red" + " x" * 30 + " green blue", "red green blue", "red green" + " x" * 17 + " blue", "red green" + " x" * 18 + " blue"]
    found = dc.contamination(docs_of(texts), spark.createDataFrame([(1, "red green blue")], "item_id long, text string"))
    assert [r.n_near_items for r in found.orderBy("doc_id").collect()] == [1, 0, 0, 1, 1, 0]


def test_one_index_serves_many_benchmarks(docs_of, spark):
    index = dc.build_index(docs_of(["red green blue", "cyan pink"]))
    for item, slot in (("green blue", 0), ("pink", 1)):
        hits = dc.search_all(index, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
        assert [(h.starts, h.ends) for h in hits] == [([1], [3])] if slot == 0 else [([1], [2])]


def test_repeated_rows_go_together(docs_of, bench):
    docs = docs_of(["a tiny item", "a tiny item", "clean words", "clean words", None], ids=[1, 1, 1, None, None]).withColumn("row_file", F.lit("clash"))
    kept = dc.keep_clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, "clean words"), (1, "clean words")]
