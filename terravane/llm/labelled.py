"""Bounded samples of labelled documents, to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.llm.jobs import stored


def in_held_out_third(doc_id: str = "doc_id") -> Column:
    """Rows whose crc32(doc_id as text) has the remainder 1 modulo 3; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, allowed: Column | None = None) -> DataFrame:
    """(doc_id, text, label) of at most `rows` labelled documents, the first by a hash of doc_id, written to the shared folder.

    Rows without a label, and ids that labels lacks, don't count; of repeated ids one row stays. The ids, at most `rows`, are
    the side that is broadcast.
    """
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    if allowed is not None:
        ids = ids.where(allowed)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return stored(docs.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label").dropDuplicates(["doc_id"]), "labelled")


def bounded(sample: DataFrame, most_bytes: int) -> DataFrame:
    """The rows of a sample, in the order of a hash of doc_id, whose texts together take most_bytes at most; a longer text is passed over."""
    draw = F.xxhash64("doc_id")
    sizes = sample.select(draw.alias("draw"), F.octet_length("text").alias("n")).where(F.col("n") <= most_bytes).orderBy("draw").collect()  # a row each
    last, total = None, 0
    for row in sizes:
        total += row.n
        if total > most_bytes:
            break
        last = row.draw
    return sample.where((draw <= F.lit(last)) & (F.octet_length("text") <= most_bytes)) if last is not None else sample.limit(0)
