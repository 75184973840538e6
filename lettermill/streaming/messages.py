"""The same message operations over streams: repeats dropped within a watermark, conversations as sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def without_late_repeats(stream: DataFrame, keys: list[str], at: str = "ts", delay: str = "1 hour") -> DataFrame:
    """The first row of each key; state is kept for delay only."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def sessions(stream: DataFrame, person: str, at: str = "ts", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """A person's messages without a pause longer than gap: start, end and how many."""
    grouped = stream.withWatermark(at, delay).groupBy(F.session_window(at, gap).alias("session"), person)
    return grouped.agg(F.count(F.lit(1)).alias("n")).select(person, F.col("session.start").alias("start"), F.col("session.end").alias("end"), "n")
