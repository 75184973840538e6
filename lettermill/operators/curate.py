"""Reply pairs, standalone samples, splits and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import noise_flags
from ..functions.ids import hash_split
from ..functions.regexlib import stripped, word_total
from .ranking import hash_key, with_rank

# Replies that say nothing.
TRIVIAL_REPLIES = ("ok", "k", "kk", "thanks", "thank you", "ty", "cool", "nice", "got it", "noted", "sure")


def context_pairs(messages: DataFrame, k: int = 6, min_target: int = 3, thread: str = "conversation_key", order=("date", "thread_index")) -> DataFrame:
    """Each reply of the owner with the messages before it: of the last k - 1 turns those that are no noise, else the last
    partner message with text. Noise, media, short and trivial replies and those without context go."""
    noise = noise_flags(F.col("body_text"))
    marked = messages.withColumn("__noise", noise["noise"]).withColumn("__media", noise["media"]).withColumn("__plain", stripped(F.col("body_text")))
    by = Window.partitionBy(thread).orderBy(*order)
    turn = F.struct(F.col("turn_role").alias("role"), F.col("body_text").alias("text"), F.col("__noise").alias("noise"))
    framed = marked.withColumn("__frame", F.collect_list(turn).over(by.rowsBetween(-(k - 1), -1)))
    partner = F.when((F.col("turn_role") == "partner") & (F.length("__plain") > 0), F.col("__plain"))
    framed = framed.withColumn("__last", F.last(partner, ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)))
    own = framed.where((F.col("turn_role") == "you") & ~F.col("__noise") & ~F.col("__media") & (F.length("__plain") >= min_target) & ~F.lower("__plain").isin(*TRIVIAL_REPLIES))
    kept = F.transform(F.filter("__frame", lambda t: ~t["noise"]), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    fallback = F.when(F.col("__last").isNotNull(), F.array(F.struct(F.lit("partner").alias("role"), F.col("__last").alias("text"))))
    own = own.withColumn("context", F.when(F.size(kept) > 0, kept).otherwise(fallback)).where("context is not null")
    return own.select(_id("pair", thread), "context", F.col("__plain").alias("target_text"), _meta(thread))


def standalone(messages: DataFrame, min_chars: int = 40, thread: str = "conversation_key") -> DataFrame:
    """The owner's messages that stand for themselves: long enough, or 30 characters or five words."""
    noise, plain = noise_flags(F.col("body_text")), stripped(F.col("body_text"))
    rows = messages.where(F.col("turn_role") == "you").withColumn("__noise", noise["noise"] | noise["media"]).withColumn("__plain", plain)
    long = (F.length("__plain") >= min_chars) | (F.length("__plain") >= 30) | (word_total(F.col("__plain")) >= 5)
    return rows.where(~F.col("__noise") & long).select(_id("mono", thread), F.col("__plain").alias("text"), _meta(thread))


def _id(kind: str, thread: str) -> Column:
    own = F.coalesce(F.when(F.length("message_id") > 0, F.col("message_id")), F.col(thread))
    return F.concat(F.lit(f"{kind}-"), own, F.lit("-"), F.coalesce(F.col("thread_index").cast("string"), F.lit(""))).alias("id")


def _meta(thread: str) -> Column:
    return F.struct("platform", F.col(thread).alias("conversation"), "date", "lang", F.length("__plain").alias("len_chars")).alias("meta")


def exact_split(ids: DataFrame, column: str, train: float = 0.8, val: float = 0.1, seed: int = 42, group: list[str] = ()) -> DataFrame:
    """Distinct ids (by group) with split: int(n * train) train, int(n * val) val, the rest test, in a seeded order."""
    ranked = with_rank(ids.select(*group, column).distinct(), hash_key(F.col(column), seed=seed), [column], list(group))
    first, second = F.floor(F.col("total") * train), F.floor(F.col("total") * train) + F.floor(F.col("total") * val)
    return ranked.withColumn("split", F.when(F.col("rank") <= first, "train").when(F.col("rank") <= second, "val").otherwise("test")).drop("rank", "total")


def with_hash_split(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("split", hash_split(F.col(column)))


def split_counts(rows: DataFrame, by: list[str]) -> DataFrame:
    """Counts for every combination of by and of its beginnings, one pass; null means all."""
    return rows.rollup(*by).agg(F.count(F.lit(1)).alias("n"))


def corpus_stats(records: DataFrame, pairs: DataFrame, monos: DataFrame) -> DataFrame:
    """One row: totals, mean lengths (0.0 if there are none), counts by platform and by language as maps."""
    def tally(column):
        counts = records.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return counts.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(column, F.lit("unknown")), "n")))).alias(f"by_{column}"))

    def mean(df, name):
        return df.agg(F.count(F.lit(1)).alias(f"{name}_total"), F.coalesce(F.avg("meta.len_chars"), F.lit(0.0)).alias(f"avg_{name}_len"))

    total = records.agg(F.count(F.lit(1)).alias("records_total"), F.countDistinct("conversation_key").alias("unique_conversations"))
    return total.crossJoin(tally("platform")).crossJoin(tally("lang")).crossJoin(mean(pairs, "pair")).crossJoin(mean(monos, "mono"))


def split_leakage(items: DataFrame, split: DataFrame, thread: str = "conversation") -> DataFrame:
    """Threads that stand in more than one split, as splits made language by language allow."""
    return items.join(split, thread).groupBy(thread).agg(F.collect_set("split").alias("splits")).where(F.size("splits") > 1)


def in_split(items: DataFrame, split: DataFrame, thread: str = "conversation") -> DataFrame:
    """items with the split of their thread; items of threads in no split go. Both sides are large: an equi-join that adapts."""
    return items.join(split.select(F.col(thread).alias("__t"), "split"), F.col(thread) == F.col("__t")).drop("__t")


def split_by_language(items: DataFrame, lang: str = "lang", thread: str = "conversation", **shares) -> DataFrame:
    """lang, thread, split: each language's threads split by themselves, of those in which items stand."""
    return exact_split(items.where(F.col(lang).isNotNull() & (F.col(lang) != "unknown")).select(lang, thread), thread, group=[lang], **shares)


def first_partner_turn(context: Column) -> Column:
    """Text of the first (not the latest) partner turn; null without one."""
    return F.get(F.filter(context, lambda t: t["role"] == "partner"), F.lit(0))["text"]


def answered(pairs: DataFrame, date: Column) -> DataFrame:
    """partner_email, your_response, original_id, meta of pairs from 2020 on whose first partner turn and target have text."""
    from ..functions.ids import from_2020_on

    rows = pairs.where(from_2020_on(date)).select(first_partner_turn(F.col("context")).alias("partner_email"), F.col("target_text").alias("your_response"), F.col("id").alias("original_id"), "meta")
    return rows.where((F.length("partner_email") > 0) & (F.length("your_response") > 0))


def selection_stats(scored: DataFrame, selected: Column) -> DataFrame:
    """One row: total, selected, selection_rate (0.0 for none), and the selected rows' mean style and specialised scores."""
    return scored.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(selected).alias("selected"), F.coalesce(F.try_divide(F.count_if(selected).cast("double"), F.count(F.lit(1))), F.lit(0.0)).alias("selection_rate"),
        F.coalesce(F.avg(F.when(selected, F.col("style_score"))), F.lit(0.0)).alias("avg_style"), F.coalesce(F.avg(F.when(selected, F.col("specialized_score"))), F.lit(0.0)).alias("avg_specialized"),
    )
