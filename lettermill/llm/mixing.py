"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a hash-random key. Within its source the key range is cut into buckets of about BUCKET_ROWS rows
(the range sort), bucket totals are summed in order (one small row a bucket), and a running sum inside each bucket
completes the distributed prefix sum of token counts: a source with most of the rows becomes many buckets and no
task holds a source. A source's budget is met by whole epochs plus the prefix of the random order that the rest
pays for; the last row of that prefix is cut at the word where the budget ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, table, word_count, written

#: Sources by code point weigh these in turn.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MAX_EPOCHS = 3
BUCKET_ROWS = 1000
SEED = 17
#: Tables of at most this many rows (one a source, under 200 bytes each) are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 20_000


def _with_source(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """rows joined to one row a source; broadcast only if counted to be small. A null source equals a null source."""
    small = per_source.count() <= BROADCAST_ROWS
    side = per_source.withColumnRenamed("source", "__s")
    return rows.join(F.broadcast(side) if small else side, rows["source"].eqNullSafe(side["__s"])).drop("__s")


def source_targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, source_rows, target. Targets share the total by weight; none is above max_epochs times its
    source's size, and the excess is shared anew by weight: a water level that the capped sources (smallest cap for
    their weight first) leave to the rest. One row a source is all this sorts. A null source is a source, the last; sources
    of size 0 have target 0; without rows there are no targets."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(0))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = (
        per.withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * float(max_epochs))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    earlier = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("capped", F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))).withColumn("taken_weight", F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    level = (F.sum("source_size").over(everything) - F.col("capped")) / (F.sum("weight").over(everything) - F.col("taken_weight"))
    per = per.withColumn("level", level).withColumn("water", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    return per.select("source", "source_size", "source_rows", F.least("cap", F.coalesce("water", F.lit(0.0)) * F.col("weight")).alias("target"))


def _key(id_col: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"))


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED) -> DataFrame:
    """One row per input row: id, key, source, size, source_size, target, whole_copies, extra, taken.

    whole_copies full epochs and the first extra words of one more copy are taken. A null text has size 0 and takes
    nothing; a null source is a source, last in order; a null id counts as the empty string for the key. Rows that
    repeat an id are ordered by size; of rows alike in both, which is cut is open but the multiset of results is not.
    Empty tables give empty results. Other columns are ignored.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    sized = written(sized, "mix-sizes")
    per = written(source_targets(sized, weights, max_epochs), "mix-targets")
    rows = _with_source(sized.withColumn("key", _key(F.col("id"), seed)), per)
    budget = F.floor(F.col("target") + 0.5).cast("long")
    hashed = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    buckets = F.ceil(F.col("source_rows") / BUCKET_ROWS)
    rows = (
        rows.withColumn("whole_copies", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", budget - F.col("whole_copies") * F.col("source_size"))
        .withColumn("bucket", F.floor(hashed * buckets / F.lit(2**32)).cast("long"))
    )
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    in_order = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("offset", F.coalesce(F.sum("in_bucket").over(in_order), F.lit(0))).select(F.col("source").alias("__s"), F.col("bucket").alias("__b"), "offset")
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(inside)).join(offsets, F.col("source").eqNullSafe(F.col("__s")) & (F.col("bucket") == F.col("__b")))
    before = F.col("offset") + F.col("upto") - F.col("size")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before)).cast("long")
    return rows.withColumn("extra", extra).select(
        F.col("id").alias(id_col), "key", "source", "size", "source_size", "target", "whole_copies", "extra", (F.col("whole_copies") * F.col("size") + F.col("extra")).alias("taken")
    )


def mixed_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=WEIGHTS, max_epochs=MAX_EPOCHS, seed=SEED) -> DataFrame:
    """The mix itself: docs' rows and columns, each as often as it is taken; where a source's budget ends inside a
    document, that last copy holds its first words, joined by a space (n_chars, if present, follows).

    Texts don't move: the place where each source's order is cut is one small row a source, and every row compares its
    own key with it. Rows alike in id and size at the cut are all cut alike. Nulls as in mix(); a document without words
    takes nothing and goes.
    """
    plan = mix(docs, id_col, text_col, source_col, weights, max_epochs, seed)
    at = F.struct(F.col("key"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col("size"))
    cuts = plan.groupBy("source").agg(
        F.max("whole_copies").alias("__whole"), F.max(F.when(F.col("extra") > 0, at)).alias("__cut"), F.max_by("extra", F.when(F.col("extra") > 0, at)).alias("__words")
    )
    cuts = written(cuts, "mix-cuts")
    # the document travels whole, so its columns' names can't clash with these
    named = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    small = cuts.count() <= BROADCAST_ROWS
    side = cuts.withColumnRenamed("source", "__s")
    rows = named.join(F.broadcast(side) if small else side, F.col("source").eqNullSafe(F.col("__s")))
    own = F.struct(_key(F.col("id"), seed).alias("key"), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.col("size").alias("size"))
    extra = F.when(F.col("__cut").isNull() | (own > F.col("__cut")), F.lit(0)).when(own == F.col("__cut"), F.col("__words")).otherwise(F.col("size"))
    rows = rows.withColumn("extra", extra).withColumn("n", F.when(F.col("size") > 0, F.col("__whole") + (F.col("extra") > 0).cast("long")).otherwise(0)).where("n > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    part = (F.col("copy") > F.col("__whole")) & (F.col("extra") < F.col("size"))
    words = F.array_join(F.slice(F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("extra").cast("int")), " ")
    rows = rows.withColumn("cut", F.when(part, words))
    doc = F.col("doc").withField(text_col, F.coalesce("cut", "text"))
    if "n_chars" in docs.columns:
        doc = doc.withField("n_chars", F.coalesce(F.length("cut").cast(docs.schema["n_chars"].dataType), F.col("doc.n_chars")))
    return rows.select(doc.alias("doc")).select("doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _targets_sql(rows: str, weights=WEIGHTS, max_epochs=MAX_EPOCHS) -> str:
    cases = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(weights))
    return f"""
per AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM {rows} GROUP BY source),
weighed AS (SELECT *, CASE (rank - 1) % {len(weights)} {cases} END::DOUBLE AS weight FROM per),
capped AS (SELECT *, source_size * {float(max_epochs)}::DOUBLE AS cap, source_size * {float(max_epochs)}::DOUBLE / weight AS ratio FROM weighed),
levels AS (SELECT *, ((SELECT sum(source_size) FROM per) - coalesce(sum(cap) OVER w, 0)) / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER w, 0)) AS level
  FROM capped WINDOW w AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(cap, coalesce((SELECT max(level) FROM levels WHERE level <= ratio), 0) * weight) AS target FROM levels)"""


def _taken_sql(rows: str) -> str:
    return f"""
{_targets_sql(rows)},
keyed AS (SELECT d.*, t.source_size, t.target, md5('{SEED}:' || coalesce(d.doc_id::VARCHAR, '')) AS key, floor(t.target + 0.5)::BIGINT AS budget
  FROM {rows} d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
placed AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole,
  sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM keyed),
mixed AS (SELECT *, greatest(0, least(size, budget - whole * source_size - before))::BIGINT AS extra FROM placed)"""


SQL = rf"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
{_taken_sql('sized')}
SELECT doc_id, size, source_size, target, (whole * size + extra)::BIGINT AS taken FROM mixed
"""
