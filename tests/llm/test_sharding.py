import random
import zlib

from pyspark.sql import functions as F

from terravane.llm import sharding
from terravane.llm.jobs import new_path, stored

from ..conftest import DATA
from .conftest import ODD


def test_rows_law_on_documents(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = sharding.op8_sharding(spark, DATA).collect()
    assert {r.doc_id for r in rows} == set(docs) and len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
        text = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(text) + 8, zlib.crc32(text), "rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and set(by) <= set(range(24))


def test_odd_rows_and_order(spark, docs_of):
    docs = docs_of(ODD * 40, ids=list(range(len(ODD) * 40))).withColumn("shard", F.lit("clash")).withColumn("slot", F.lit(None).cast("int"))
    out = sharding.write_shards(docs, new_path(spark, "t"), shards=7, bucket_bytes=100_000)
    rows = sorted((r.shard, r.slot, r.record.doc_id) for r in out.collect())
    assert sorted(i for _, _, i in rows) == list(range(len(ODD) * 40))
    order = [i for _, _, i in rows]
    assert sum(a < b for a, b in zip(order, order[1:])) / len(order) < 0.6  # not in order any more


def test_empty_and_few(spark, docs_of):
    assert sharding.write_shards(docs_of([]), new_path(spark, "t")).count() == 0
    few = sharding.write_shards(docs_of(["a", "a", None]), new_path(spark, "t")).collect()
    assert len({r.shard for r in few}) == 3 and {r.slot for r in few} == {0}


def test_copies_are_scattered_and_settings_change_nothing(spark, docs_of):
    docs = stored(docs_of(["same text"] * 4000, ids=[7] * 4000).withColumn("row_at", F.lit(1)).withColumn("n", F.monotonically_increasing_id()).coalesce(1), "same")
    places = []
    for partitions in ("4", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        out = sharding.write_shards(docs, new_path(spark, "t"), shards=5, bucket_bytes=4000)
        places.append(sorted((r.record.n, r.shard, r.slot) for r in out.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert places[0] == places[1]
    by = {}
    for n, shard, _ in places[0]:
        by.setdefault(shard, []).append(n)
    assert {len(v) for v in by.values()} == {800} and all(min(v) < 200 and max(v) > 3800 for v in by.values())


def test_records_are_dealt_once(spark, docs_of):
    """And to the same places, even where Spark doesn't broadcast by itself, as when it learns too late how few buckets there are."""
    rng = random.Random(8)
    texts = [rng.randbytes(5000).hex() for _ in range(400)]
    docs = stored(docs_of(texts).coalesce(1), "dealt")
    written, places = [], []
    for threshold in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            before = {s.stageId() for s in _stages(spark)}
            out = sharding.write_shards(docs, new_path(spark, "t"), shards=5, bucket_bytes=400_000)
            written.append(sum(s.shuffleWriteBytes() for s in _stages(spark) if s.stageId() not in before))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        places.append(sorted((r.record.doc_id, r.record.text, r.shard, r.slot) for r in out.collect()))
    assert [p[:2] for p in places[0]] == list(enumerate(texts)) and places[0] == places[1]
    assert all(2_000_000 < n < 6_000_000 for n in written)  # 4 MB of hex digits, 2 MB at the very least


def _stages(spark):
    """All stages so far, with what they wrote."""
    context, jvm = spark.sparkContext._jsc.sc(), spark._jvm
    context.listenerBus().waitUntilEmpty()
    quantiles = spark.sparkContext._gateway.new_array(jvm.double, 0)
    found = context.statusStore().stageList(None, False, False, quantiles, jvm.java.util.ArrayList())
    return [found.apply(i) for i in range(found.size())]
