"""Exact deduplication by content sort, with DataFrame functions only.

Splitters drawn from a bounded sample of (leading bytes, row key) divide the rows into ranges of about equal
bytes, and each range is a task's own. Each range is sorted externally by its whole normalised text and then by identifier, so equal texts become
neighbours; a comparison of each full text with its neighbour's starts a new run wherever they differ. As the
row key takes part in the splitters, copies of one text may cover many ranges, however many there are: no range
grows with a group of copies. The runs of one text that lie in several ranges meet afterwards through their
SHA-256, one small row a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, partitions, written

#: Leading bytes of the normalised text that splitters compare.
LEAD_BYTES = 24
#: Sampled rows for each range; the driver holds this many times the number of ranges at most (and the
#: binomial spread of the sample).
SAMPLE_PER_RANGE = 40


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _splitters(keys: DataFrame, n: int) -> list:
    """Keys (lead, tie) that cut the rows into n ranges of about equal bytes. keys: lead, tie, bytes."""
    rows = keys.count()
    if rows == 0 or n < 2:
        return []
    share = min(1.0, SAMPLE_PER_RANGE * n / rows)
    drawn = sorted((bytes(r[0]), r[1], r[2]) for r in (keys if share == 1.0 else keys.sample(share, 17)).collect())
    each, at, out = sum(r[2] for r in drawn) / n, 0, []
    for lead, tie, size in drawn:
        if at >= each * (len(out) + 1) and (lead, tie) not in out[-1:]:
            out.append((lead, tie))
        at += size
    return out[: n - 1]


def _numbers(spark, n: int) -> list[int]:
    """A number for each of n partitions that a shuffle by it leads there: ranges so named never share a task while others
    stand empty."""
    place = F.pmod(F.hash("id"), F.lit(n))
    rows = spark.range(32 * n).groupBy(place.alias("place")).agg(F.min("id").alias("id")).collect()
    return [r["id"] for r in sorted(rows, key=lambda r: r["place"])]


def _range_of(lead: Column, tie: Column, splitters: list) -> Column:
    """Number of splitters at or below (lead, tie), searched in two levels of about sqrt(n) each."""
    if not splitters:
        return F.lit(0).cast("long")
    pair = lambda s: F.struct(F.lit(bytearray(s[0])).alias("lead"), F.lit(s[1]).cast("long").alias("tie"))
    width = max(1, int(len(splitters) ** 0.5))
    groups = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    key = F.struct(lead.alias("lead"), tie.alias("tie"))
    heads = F.array(*[pair(g[0]) for g in groups])
    fine = F.array(*[F.array(*[pair(s) for s in g]) for g in groups])
    coarse = F.size(F.filter(heads, lambda s: s <= key))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(coarse, F.lit(1))), lambda s: s <= key))
    return F.when(coarse == 0, F.lit(0)).otherwise((coarse - 1) * F.lit(width) + inside)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after normalised(). A null text counts as empty. The smallest id of a
    group stays; a null id sorts after every other, so it stays only in a group of null ids. Rows that repeat an
    id are rows of their own: each counts, and all rows that carry the smallest id are kept. An empty table gives
    an empty result; other columns are ignored, whatever their names.
    """
    n = partitions(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("content"))
    lead = F.substring(F.col("content").cast("binary"), 1, LEAD_BYTES)
    tie = F.xxhash64(F.col("id"))
    cut = docs.select(F.substring(F.regexp_replace(F.coalesce(F.substring(F.col(text_col), 1, 4 * LEAD_BYTES), F.lit("")), SPACES, " ").cast("binary"), 1, LEAD_BYTES).alias("lead"), F.xxhash64(F.col(id_col).cast("long")).alias("tie"), (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)) + 64).alias("bytes"))
    splitters = _splitters(cut, n)
    names = _numbers(docs.sparkSession, n) if splitters else []
    part = _range_of(lead, tie, splitters)
    rows = rows.withColumn("part", F.element_at(F.array(*[F.lit(x).cast("long") for x in names]), (part % len(names) + 1).cast("int")) if names else part)
    sorted_range = Window.partitionBy("part").orderBy(F.col("content"), F.col("id").asc_nulls_last())
    up_to_here = sorted_range.rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag("content").over(sorted_range)
    runs = (
        rows.withColumn("head", (before.isNull() | (before != F.col("content"))).cast("int"))
        .withColumn("run", F.sum("head").over(up_to_here))
        .select("id", "part", "run", "head", F.when(F.col("head") == 1, F.sha2(F.col("content"), 256)).alias("digest"))
    )
    runs = written(runs, "exact-runs")
    one = (
        runs.groupBy("part", "run").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("rows"), F.max("digest").alias("text_sha256"))
    )
    whole = one.groupBy("text_sha256").agg(F.min("low").alias("keep_id"), F.sum("rows").alias("group_size"))
    merged = one.select("part", "run", "text_sha256").join(whole, "text_sha256")
    return runs.select("id", "part", "run").join(merged, ["part", "run"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's rows, all columns, without exact copies: of equal texts the smallest id stays. If rows repeat
    that id with that text, all of them stay. Nulls as in exact_groups."""
    groups = exact_groups(docs, id_col, text_col).where("kept").select(F.col(id_col).alias("kept_id"), "text_sha256").distinct()
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"), F.sha2(normalised(F.col(text_col)), 256).alias("sha"))
    return rows.join(groups, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("sha") == F.col("text_sha256")), "left_semi").select("doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return exact_groups(table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents),
g AS (SELECT content, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY content)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(t.content) AS text_sha256
FROM t JOIN g USING (content)
"""
