"""Human-rating analytics over rows of prompt_id, key (Human, Base, LoRA), guess, confidence_1to5, answer, rater_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TYPES = ("Human", "Base", "LoRA")
MACHINE = "AI"


def _correct(owner: str) -> Column:
    return F.when(F.col("key") == "Human", F.col("guess") == owner).otherwise(F.col("guess") == MACHINE)


def _known(df: DataFrame) -> DataFrame:
    return df.where(F.col("key").isin(*TYPES))


def accuracy_by_type(df: DataFrame, owner: str) -> DataFrame:
    right = F.coalesce(_correct(owner), F.lit(False)).cast("long")
    return _known(df).groupBy("key").agg(F.avg(right).alias("accuracy"), F.sum(right).alias("correct"), F.count(F.lit(1)).alias("total"), (1 - F.avg(right)).alias("deception_rate"))


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Long form: key, guess, the share of the key's rows with that guess. Rows without key or guess don't count."""
    counts = df.where("key is not null and guess is not null").groupBy("key", "guess").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("key", "guess", (F.col("n") / F.sum("n").over(Window.partitionBy("key"))).alias("share"))


def deception_rates(df: DataFrame, owner: str) -> DataFrame:
    wrong = F.when(F.col("key") == "Human", F.col("guess") == MACHINE).otherwise(F.col("guess") == owner)
    return _known(df).groupBy("key").agg(F.avg(F.coalesce(wrong, F.lit(False)).cast("int")).alias("deception_rate"))


def detection_accuracy(df: DataFrame, normalise_labels: bool = False) -> DataFrame:
    """Share of rows in which machine and human are told apart. Guesses are compared to the names of the types, which they
    never are; normalise_labels=True compares them to the machine's label instead."""
    machine = F.coalesce(F.col("key").isin("Base", "LoRA"), F.lit(False))
    guessed = F.coalesce(F.col("guess") == MACHINE if normalise_labels else F.col("guess").isin("Base", "LoRA"), F.lit(False))
    return df.agg(F.avg((machine == guessed).cast("int")).alias("ai_detection_accuracy"))


def confidence_by_type(df: DataFrame) -> DataFrame:
    c = F.col("confidence_1to5")
    return _known(df).groupBy("key").agg(F.avg(c).alias("mean_confidence"), F.stddev_samp(c).alias("std_confidence"), F.median(c).alias("median_confidence"))


def misidentification(df: DataFrame) -> DataFrame:
    return _known(df).where("guess is not null and guess != key").groupBy("key", "guess").agg(F.count(F.lit(1)).alias("n"))


def lora_vs_base(df: DataFrame, owner: str) -> DataFrame:
    """One row of rates and the ratios derived from them; a ratio whose denominator isn't positive is 0."""
    rate = lambda k: F.avg(F.when(F.col("key") == k, F.coalesce(F.col("guess") == owner, F.lit(False)).cast("int")))
    r = _known(df).agg(rate("LoRA").alias("lora"), rate("Base").alias("base"), rate("Human").alias("human")).where("lora is not null and base is not null and human is not null")
    safe = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    l, b, h = F.col("lora"), F.col("base"), F.col("human")  # noqa: E741
    return r.select(
        l.alias("lora_deception_rate"), b.alias("base_deception_rate"), h.alias("human_human_rate"), (l - b).alias("lora_advantage"),
        safe(l - b, h - b).alias("relative_human_likeness"), safe(l, h).alias("human_likeness_ratio"), safe(l - b, 1 - b).alias("deception_efficiency"),
    )


def _guessed(df: DataFrame, owner: str | None) -> DataFrame:
    """correct_guess as the guess equal to the type's name or, with an owner, as _correct()."""
    return df.withColumn("correct_guess", F.coalesce(_correct(owner) if owner else F.col("guess") == F.col("key"), F.lit(False)).cast("double"))


def answer_lengths(df: DataFrame) -> DataFrame:
    n = F.length("answer")
    return df.groupBy("key").agg(F.avg(n).alias("mean_length"), F.stddev_samp(n).alias("std_length"), F.count(n).alias("n"))


def confidence_correlation(df: DataFrame, owner: str | None = None) -> DataFrame:
    return _guessed(df, owner).agg(F.corr(F.col("confidence_1to5").cast("double"), "correct_guess").alias("confidence_accuracy_correlation"))


def prompt_difficulty(df: DataFrame, owner: str | None = None) -> DataFrame:
    return _guessed(df, owner).groupBy("prompt_id").agg(F.avg("correct_guess").alias("difficulty_score"), F.avg("confidence_1to5").alias("avg_confidence"))


def rater_consistency(df: DataFrame, owner: str | None = None) -> DataFrame:
    return _guessed(df, owner).groupBy("rater_id").agg(F.avg("correct_guess").alias("accuracy"), F.avg("confidence_1to5").alias("avg_confidence"))


def distribution(df: DataFrame) -> DataFrame:
    counts = df.where("key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("key", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("share"))


def totals(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("responses"), F.countDistinct("prompt_id").alias("prompts"), F.countDistinct("rater_id").alias("raters"), *[F.count_if(F.col("key") == t).alias(f"n_{t.lower()}") for t in TYPES])


def generation_stats(df: DataFrame, variants: list[str]) -> DataFrame:
    """variant, n, n_ok, rate, mean_words, std_words: generated texts that don't begin with ERROR, and their words."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(v).alias("variant"), F.col(v).alias("text")) for v in variants])).alias("x")).select("x.*")
    ok = ~F.coalesce(F.col("text").startswith("ERROR"), F.lit(True))
    words = F.when(ok, F.regexp_count("text", F.lit(r"\S+")))
    return long.groupBy("variant").agg(F.count(F.lit(1)).alias("n"), F.count_if(ok).alias("n_ok"), F.avg(ok.cast("int")).alias("rate"), F.avg(words).alias("mean_words"), F.stddev_pop(words).alias("std_words"))


def report(df: DataFrame, owner: str) -> DataFrame:
    """The comparison as lines of text, with a verdict."""
    r = lora_vs_base(df, owner)
    verdict = F.when(F.col("lora_advantage") > 0.1, "strong").when(F.col("lora_advantage") > 0, "some").otherwise("no")
    return r.select(F.concat_ws("\n", F.format_string("tuned model taken for the owner: %.1f%%", F.col("lora_deception_rate") * 100), F.format_string("base model taken for the owner: %.1f%%", F.col("base_deception_rate") * 100), F.format_string("owner recognised: %.1f%%", F.col("human_human_rate") * 100), F.concat(verdict, F.lit(" advantage of the tuned model"))).alias("report"))
