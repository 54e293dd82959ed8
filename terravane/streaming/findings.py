"""Findings over streams of recorded rows: the row-wise checks of operators.quality run on a stream as they stand; counts by
code are kept in windows, late rows within the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counts(findings: DataFrame, time: str, window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """(start, code, severity, n) of a stream (or table) of findings with a timestamp column."""
    rows = findings.withWatermark(time, late) if findings.isStreaming else findings
    out = rows.groupBy(F.window(time, window), "code", "severity").agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), "code", "severity", "n")
