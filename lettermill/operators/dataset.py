"""Chat datasets for training: validation, mapping, mixing, rendering."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.regexlib import stripped
from ..sources.shared import stored
from .ranking import hash_key, with_rank

# Left-overs that a clean example doesn't hold, and the cue of standalone examples.
ARTEFACTS = ("virus-free", "www.avast.com", "sent from my", "get outlook for")
MONO_CUE = "(Write a short message continuing the thread.)"
STYLE = "You respond concisely in the owner's natural tone."


def clean_text(text: Column) -> Column:
    low, good = F.lower(text), F.length(stripped(text)) >= 3
    for a in ARTEFACTS:
        good = good & ~F.contains(low, F.lit(a))
    return F.coalesce(good, F.lit(False))


def valid_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.where((F.size("context") > 0) & clean_text(F.col("target_text")))


def valid_monos(monos: DataFrame) -> DataFrame:
    return monos.where(clean_text(F.col("text")))


def _message(role: Column, content: Column) -> Column:
    return F.struct(role.alias("role"), content.alias("content"))


def chat_from_pairs(pairs: DataFrame, min_target: int = 0) -> DataFrame:
    """Messages of a pair, the target last, and the target as label."""
    rows = valid_pairs(pairs).where(F.length("target_text") >= min_target)
    turns = F.transform("context", lambda t: _message(F.when(t["role"] == "you", "assistant").otherwise("user"), t["text"]))
    return rows.select("id", F.concat(turns, F.array(_message(F.lit("assistant"), F.col("target_text")))).alias("messages"), F.col("target_text").alias("labels"))


def chat_from_monos(monos: DataFrame, style: str = STYLE) -> DataFrame:
    fixed = [_message(F.lit("system"), F.lit(style)), _message(F.lit("user"), F.lit(MONO_CUE))]
    return valid_monos(monos).select("id", F.array(*fixed, _message(F.lit("assistant"), F.col("text"))).alias("messages"), F.col("text").alias("labels"))


def rendered(chats: DataFrame) -> DataFrame:
    """The messages as one text."""
    return chats.withColumn("text", F.array_join(F.transform("messages", lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"], F.lit("<|end|>\n"))), ""))


def weighted_mix(pairs: DataFrame, monos: DataFrame, pair_weight: int = 3, mono_weight: int = 1, limit: int | None = None, seed: int = 42) -> DataFrame:
    """Rows of both (id, messages, labels) in the given ratio, without replacement: each side gives its share of limit (by
    default of all rows), or what it has. kind and a seeded order key are added. Both sides are stored first, as they are counted
    and ranked; only two counts come to the driver."""
    pairs, monos = (stored(x.select("id", "messages", "labels"), "mix") for x in (pairs, monos))
    have_p, have_m = pairs.count(), monos.count()
    total = limit if limit else have_p + have_m
    weights = pair_weight + mono_weight
    want_p = int(total * (pair_weight / weights)) if weights else min(have_p, total)
    want_m = total - want_p if weights else max(0, total - want_p)
    out = None
    for kind, rows, n in (("pair", pairs, min(want_p, have_p)), ("mono", monos, min(want_m, have_m))):
        ranked = with_rank(rows, hash_key(F.col("id"), seed=seed), ["id", "labels"]).where(F.col("rank") <= n).drop("rank", "total")
        ranked = ranked.withColumn("kind", F.lit(kind))
        out = ranked if out is None else out.unionByName(ranked)
    return out.withColumn("order_key", hash_key(F.col("kind"), F.col("id"), seed=seed))


#: Bytes of text that a partition of like lengths holds, and how finely lengths are told apart.
BUCKET_BYTES, LENGTH_STEPS = 64 << 20, 16


def length_buckets(rows: DataFrame, column: str, n: int) -> DataFrame:
    """Rows of like length in the same partition, for batches with little padding. About n partitions of like size in bytes,
    and as many more as keep each near BUCKET_BYTES. Lengths are counted first, in LENGTH_STEPS steps an octave: what comes to
    the driver is one row a step. Rows of one step that don't fit one partition are dealt by their hash."""
    step = F.floor(F.log2(F.coalesce(F.length(column), F.lit(0)) + 1) * LENGTH_STEPS).cast("int")
    sizes = dict(rows.groupBy(step.alias("step")).agg(F.sum(F.coalesce(F.octet_length(column), F.lit(0)) + 64).alias("bytes")).collect())
    share, before, first, parts = max(1, min(BUCKET_BYTES, -(-sum(sizes.values()) // n))), 0, [], []
    for s in range(max(sizes, default=0) + 1):
        upto = before + sizes.get(s, 0)
        first.append(before // share)
        parts.append(max(1, -(-upto // share) - before // share))
        before = upto
    own = lambda values: F.get(F.lit(values), step)
    part = (own(first) + F.pmod(F.xxhash64(*rows.columns), own(parts))).cast("int")
    return rows.repartitionById(max(1, -(-before // share)), part).sortWithinPartitions(F.length(column))


def without_nulls(rows: DataFrame) -> DataFrame:
    """Mapped examples that came to nothing go: those without messages or labels."""
    return rows.where(F.col("messages").isNotNull() & (F.size("messages") > 0) & F.col("labels").isNotNull())


def validation_set(pairs: DataFrame, monos: DataFrame, seed: int = 42) -> DataFrame:
    """All rows of both (id, messages, labels) in their own proportions, with kind and a seeded order key."""
    both = without_nulls(pairs).select("id", "messages", "labels", F.lit("pair").alias("kind")).unionByName(without_nulls(monos).select("id", "messages", "labels", F.lit("mono").alias("kind")))
    return both.withColumn("order_key", hash_key(F.col("kind"), F.col("id"), seed=seed))


def tokenized(rows: DataFrame, column: str, path: str | None = None, most: int = 2048) -> DataFrame:
    """rows with tokens, the first `most` of the text's, and n_tokens, how many it has in all; no padding. path: a tokenizer file
    (ids); without one, words. A null text has none."""
    if path is None:
        from ..functions.regexlib import words

        return rows.withColumn("__all", F.coalesce(words(F.col(column)), F.expr("cast(array() as array<string>)"))).withColumn("tokens", F.slice("__all", F.lit(1), F.lit(most))).withColumn("n_tokens", F.size("__all").cast("long")).drop("__all")
    @F.pandas_udf("ids array<int>, n long")
    def encode(texts: pd.Series) -> pd.DataFrame:
        from tokenizers import Tokenizer

        ids = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
        return pd.DataFrame({"ids": [i[:most] for i in ids], "n": [len(i) for i in ids]})

    return rows.withColumn("__e", encode(F.col(column))).withColumn("tokens", F.col("__e.ids")).withColumn("n_tokens", F.col("__e.n")).drop("__e")
