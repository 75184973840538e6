"""What the operators of this subpackage share: tables, shared storage, word patterns, run-wide settings."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import stored

#: A word is a longest run of characters other than the space and the five ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


#: Bits of a filter over 64-bit digests; 16 MB, whatever the input. It spares later passes most rows; a crowded filter
#: only lets more rows through, which exact joins then drop.
FILTER_BITS = 1 << 27


def bit_filter(rows: DataFrame, digest: str) -> np.ndarray:
    """One bit for each digest (long) modulo FILTER_BITS, set by executors in slices of 4 KB."""
    at = F.pmod(F.col(digest), F.lit(FILTER_BITS)) + 1  # the bitmap functions count from 1
    slices = rows.groupBy(F.bitmap_bucket_number(at).alias("slice")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).toLocalIterator()
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in slices:
        out[(r["slice"] - 1) * 4096 : r["slice"] * 4096] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def passes(bits: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Which of the digests (uint64) have their bit set."""
    at = digests & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reads one of the driver's parquet tables through Spark's reader, so any Hadoop path works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Cuts lineage: writes df as Parquet into the shared folder and reads it back. Rows survive the
    loss of any executor, and later plans start from a plain scan. The folder goes when the driver ends."""
    return stored(df, label)


def forgotten(df: DataFrame) -> None:
    """Deletes what written() wrote, if nothing that is still to run reads it."""
    files = df.inputFiles()
    if files:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Batches of at most n rows to Python for what is written inside; long texts need short batches."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
