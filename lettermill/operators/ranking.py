"""Distributed ranks: no window ever holds a whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Digits of the hex key that make a bucket: 16 ** 3 buckets a group.
BUCKET_DIGITS = 3


def hash_key(*columns: Column, seed: int = 42) -> Column:
    """Hex digest of the columns' texts (null as nothing) and a seed: a reproducible random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]).cast("binary"))


def with_rank(df: DataFrame, key: Column, ties: list[str], group: list[str] = (), name: str = "rank", total: str = "total") -> DataFrame:
    """Adds the 1-based rank by (key, ties) within group, and the group's rows. key: hex digests, so equal slices of the key
    range are equal buckets; ranks within a bucket are added to the counts of the buckets before it, one row a bucket."""
    keyed = df.withColumn("__key", key).withColumn("__bucket", F.substring("__key", 1, BUCKET_DIGITS))
    counts = keyed.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    over = Window.partitionBy(*(group or [F.lit(0)]))
    counts = counts.withColumn("__before", F.sum("__n").over(over.orderBy("__bucket")) - F.col("__n")).withColumn(total, F.sum("__n").over(over)).drop("__n")
    side = counts.select(*[F.col(c).alias(f"__{c}") for c in group], F.col("__bucket").alias("__b"), "__before", total)
    same = F.col("__bucket") == F.col("__b")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    inside = Window.partitionBy(*group, "__bucket").orderBy("__key", *ties)
    return keyed.withColumn("__row", F.row_number().over(inside)).join(side, same).withColumn(name, F.col("__before") + F.col("__row")).select(*df.columns, name, total)


def keep_first(df: DataFrame, key: list[Column], order: list[str]) -> DataFrame:
    """The first row of each key. A sum with partial results a task, so a key with most of the rows costs one row a task; it
    sorts by a digest, however long the keys are. Equal in order: any one."""
    plain = F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("\x00")) for k in key])
    row = F.struct(*[F.col(c) for c in df.columns])
    first = df.select(F.sha2(plain, 256).alias("__key"), F.struct(*order).alias("__order"), row.alias("__row")).groupBy("__key").agg(F.min_by("__row", "__order").alias("__row"))
    return first.select("__row.*")
