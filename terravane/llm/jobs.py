"""Tables that cut lineage, and helpers for Arrow stages."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset and the master is local (tests), a folder of our own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="terravane-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Lets Spark drop the shuffle files of a query when it ends, not when the driver next collects garbage.
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def give_back() -> None:
    """Hands memory that this process has freed, but still holds, to the system: the driver's Python has no use for what training took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not the GNU C library
        ctypes.CDLL(None).malloc_trim(0)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read again: lost executors cost no more than the running stage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")  # the table stands, so the shuffles that made it needn't
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP_KEY, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables of `stored` that no plan needs any more."""
    for df in tables:
        spark = df.sparkSession
        own = PurePosixPath("/" + (shared_dir(spark).partition(":")[2] or shared_dir(spark)).lstrip("/"))
        for folder in {PurePosixPath("/" + (f.partition(":")[2] or f).lstrip("/")).parent for f in df.inputFiles()}:
            if folder.parent == own:
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{folder.name}")
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def with_row_key(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with two long columns that together tell its rows apart, however often the plan is run, and their names.

    They are a hash of the file and the row's place in it; docs that aren't read from files are stored first.
    """
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        docs = stored(docs, "rows")
    names = []
    for name in ("row_file", "row_at"):
        while name in docs.columns:
            name += "_"
        names.append(name)
    return docs.withColumns({names[0]: F.xxhash64("_metadata.file_path"), names[1]: F.col("_metadata.row_index")}), names


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows that share `key`, from batches in which equal keys stand together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(key))
        if batch.num_rows > 1:
            cuts = np.flatnonzero(np.asarray(pc.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False), bool)) + 1
        else:
            cuts = np.zeros(0, np.int64)
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            now = column[a].as_py()
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def with_columns_of(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])
