"""The canonical message view and what is computed a thread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import language_bucket
from ..functions.ids import conversation_key
from ..functions.regexlib import let
from .ranking import keep_first


def message_view(conversations: DataFrame) -> DataFrame:
    """Chat turns as messages: assistant turns are the owner's."""
    mine = F.col("role") == "assistant"
    return conversations.select(
        F.lit("chat").alias("platform"), F.col("conv_id").cast("string").alias("conversation_id"), F.concat_ws("-", "conv_id", "turn").alias("message_id"),
        F.lpad(F.col("turn").cast("string"), 6, "0").alias("date"), F.col("turn").cast("long").alias("thread_index"),
        F.when(mine, "you").otherwise("partner").alias("turn_role"), F.when(mine, "outbound").otherwise("inbound").alias("direction"), F.coalesce("text", F.lit("")).alias("body_text"),
    )


def cleaned(messages: DataFrame, aggressive_tail: bool = True) -> DataFrame:
    """Bodies cleaned by platform, empty ones dropped, language bucket and conversation key added."""
    kind = F.lower(F.coalesce("platform", F.lit("")))
    by_platform = lambda t: F.when(kind == "whatsapp", T.clean_chat_placeholders(t)).when(kind == "gmail", T.clean_mail_tail(t, aggressive_tail)).otherwise(t)
    body = let(T.strip_quotes_and_signatures(T.clean_common(F.coalesce("body_text", F.lit("")))), by_platform)
    out = messages.withColumn("body_text", body)
    out = out.where(F.length("body_text") > 0).withColumn("lang", language_bucket(F.col("body_text")))
    return out.withColumn("date", F.coalesce("date", F.lit(""))).withColumn("conversation_key", conversation_key(F.col("platform"), F.col("conversation_id")))


def without_repeats(messages: DataFrame, order: list[str]) -> DataFrame:
    """The first message of each normalised text and role, over all platforms and conversations."""
    return keep_first(messages, [T.dedup_text(F.concat(F.col("body_text"), F.lit("|"), F.col("turn_role")))], order)


def participated(messages: DataFrame, scope: list[str]) -> DataFrame:
    """Messages of threads in which the owner wrote, scope by scope."""
    own = messages.where(F.col("direction") == "outbound").select(*scope).distinct()
    return messages.join(own, scope, "left_semi")


def thread_index(messages: DataFrame, thread: str = "conversation_id", date: str = "date", tie: str = "message_id") -> DataFrame:
    """0-based place in the thread by date (null first) and tie, and the thread's length."""
    w = Window.partitionBy(thread)
    return messages.withColumn("thread_index", F.row_number().over(w.orderBy(F.coalesce(F.col(date).cast("string"), F.lit("")), tie)) - 1).withColumn("thread_len", F.count(F.lit(1)).over(w))


def thread_stats(messages: DataFrame, thread: str, at: Column, person: Column) -> DataFrame:
    """Size, earliest time (0 for none) and sorted participants a thread."""
    return messages.groupBy(thread).agg(F.count(F.lit(1)).alias("thread_len"), F.min(F.coalesce(at, F.lit(0))).alias("earliest"), F.sort_array(F.collect_set(person)).alias("participants"))


def majority(df: DataFrame, group: str, value: str, order: str, unknown: str = "unknown") -> DataFrame:
    """The most frequent known value a group; of equals the one first seen."""
    counts = df.where(F.col(value).isNotNull() & (F.col(value) != unknown)).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return counts.groupBy(group).agg(F.max_by(value, F.struct("n", (-F.col("first")).alias("earlier"))).alias("majority"))


def language_backfill(df: DataFrame, group: str, lang: str, order: str, unknown: str = "unknown") -> DataFrame:
    """Unknown languages become the group's majority."""
    most = majority(df, group, lang, order, unknown)
    return df.join(most, group, "left").withColumn(lang, F.when(F.coalesce(F.col(lang), F.lit(unknown)) == unknown, F.coalesce("majority", F.lit(unknown))).otherwise(F.col(lang))).drop("majority")


def first_n(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows in order; none for 0."""
    return df.orderBy(*order).limit(n)


def conversation_order(messages: DataFrame, thread: str, by: str = "path", path: str = "source_file") -> DataFrame:
    """thread and place (sorts as conversations are taken): by path, path without case, or size (characters in all, small
    first, then the thread)."""
    if by == "size":
        return messages.groupBy(thread).agg(F.struct(F.lpad(F.coalesce(F.sum(F.length("body_text")), F.lit(0)).cast("string"), 20, "0").alias("first"), F.first(thread).cast("string").alias("then")).alias("place"))
    name = F.min(F.lower(path) if by == "folded" else F.col(path))
    return messages.groupBy(thread).agg(F.struct(F.coalesce(name, F.lit("")).alias("first"), F.first(thread).cast("string").alias("then")).alias("place"))


def running_limit(messages: DataFrame, n: int, thread: str, by: str = "path", path: str = "source_file", index: str = "thread_index") -> DataFrame:
    """The first n messages as conversations are taken one after another, each in its own order; none for 0. The best n of each
    task are all that moves."""
    placed = messages.join(conversation_order(messages, thread, by, path), thread)
    return placed.orderBy("place", index).limit(n).drop("place")


def direction_counts(messages: DataFrame, thread: str = "conversation_id") -> DataFrame:
    """One row: messages, inbound, outbound, conversations."""
    side = lambda d: F.count_if(F.col("direction") == d).alias(d)
    return messages.agg(F.count(F.lit(1)).alias("messages"), side("inbound"), side("outbound"), F.countDistinct(thread).alias("conversations"))
