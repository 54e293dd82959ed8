"""Sharding by a two-pass external shuffle; DataFrame functions only.

Pass one scatters records uniformly into buckets that fit in memory, by a seeded hash of their id, content and place in the input's
files, so that copies of one row are scattered like any others; each bucket is a partition of its own. Pass two shuffles each bucket
(Spark's shuffle() is a seeded Fisher-Yates shuffle of an array) and writes it. Prefix sums of the bucket sizes give every record its rank in the whole, and ranks are
cut into shards whose row counts differ by at most one (the law `rows`). A bucket lies in one shard or a few neighbours, so the second
pass writes without another exchange. The number of buckets follows from the bytes alone, and where a record goes from the seed, the
input's files and that number, not from settings of the session.

Edge cases: a null text has no bytes; null ids are scattered by content. Repeated rows are records of their own. No records: no rows.
Fewer records than shards: the rest of the shards is empty. A record longer than a bucket makes a bucket larger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from terravane.llm.jobs import new_path, read_table, with_row_key

SHARDS = 24
BUCKET_BYTES = 8 << 20


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 42, bucket_bytes: int = BUCKET_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write docs to path as one folder of Parquet files for each shard, and return them as a table.

    Columns: record (all columns of docs), slot (the place in the shard, from 0), shard.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8
    total = docs.agg(F.sum(size.cast("long"))).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), 1)
    names, (docs, (_, row_at)) = docs.columns, with_row_key(docs)
    draw = F.xxhash64(F.lit(seed), F.col(doc_id).cast("string"), F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.col(row_at))
    bucket = F.pmod(draw, F.lit(buckets)).cast("int").alias("bucket")

    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = docs.select(bucket).groupBy("bucket").agg(F.count("*").alias("n"))
    # one row a bucket
    bases = sizes.withColumn("base", F.coalesce(F.sum("n").over(whole), F.lit(0))).withColumn("total", F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).drop("n")

    records = docs.select(bucket, draw.alias("draw"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("record"))
    scattered = records.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket", "draw", F.col(f"record.`{doc_id}`"))
    gathered = scattered.groupBy("bucket").agg(F.collect_list("record").alias("records"))
    # broadcast by a hint, one row a partition: a plan that is free to choose may sort both sides, and then deals all records once more
    shuffled = gathered.join(F.broadcast(bases), "bucket").select("base", "total", F.shuffle("records", seed).alias("records"))
    ranked = shuffled.select("base", "total", F.posexplode("records").alias("pos", "record")).withColumn("rank", F.col("base") + F.col("pos"))
    shard = F.expr(f"cast(rank * {shards} div total as int)")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    placed = ranked.withColumn("shard", shard).withColumn("slot", (F.col("rank") - first).cast("long"))
    placed.select("record", "slot", "shard").write.option("compression", "zstd").partitionBy("shard").parquet(path)
    schema = placed.select("record", "slot", "shard").schema
    return spark.read.schema(schema).parquet(path)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, as their shards' files have them."""
    docs = read_table(spark, sf_dir, "documents")
    written = write_shards(docs, new_path(spark, "shards"))
    text = F.coalesce(F.col("record.text"), F.lit(""))
    return written.select(
        F.col("record.doc_id").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
