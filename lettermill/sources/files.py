"""Readers and writers of the engine's file formats. All paths go through Spark, so any store it reads will do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TURN = "struct<role:string,text:string>"
MESSAGE_SCHEMA = (
    "platform string, source_file string, conversation_id string, message_id string, date string, subject string, subject_norm string, `from` string, "
    "`to` array<string>, cc array<string>, bcc array<string>, participants array<string>, direction string, turn_role string, account string, sender_domain string, "
    "partner_id string, partner_ids array<string>, is_reply boolean, reply_to_message_id string, content_type string, attachments struct<count:int,types:array<string>>, "
    "body_raw string, body_text string, reactions array<struct<actor:string,emoji:string,date:string>>, lang string, char_len int, token_est int, has_emoji boolean, "
    "thread_index int, thread_len int, turn_id string, split string, is_ack boolean, labels array<string>"
)
PAIR_SCHEMA = f"id string, context array<{TURN}>, target_text string, meta struct<platform:string,conversation_hash:string,date:string,lang:string,len_chars:int>"
MONO_SCHEMA = "id string, text string, meta struct<platform:string,conversation_hash:string,date:string,lang:string,len_chars:int,subject_norm:string>"


def read_jsonl(spark: SparkSession, paths, schema: str = MESSAGE_SCHEMA, strict: bool = True) -> DataFrame:
    """JSON lines. strict: a malformed line fails the job; else malformed lines and missing files are left out. With
    input_order, which sorts as the lines do within a file."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").option("ignoreMissingFiles", not strict)
    return reader.json(paths).withColumn("input_order", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")))


def read_json_array(spark: SparkSession, paths, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(paths)


def read_partitioned(spark: SparkSession, root: str, language: str | None = None) -> DataFrame:
    """Rows written by write_partitioned; a language reads its folder only."""
    rows = spark.read.option("basePath", root).json(root)
    return rows.where(F.col("lang_part") == language) if language else rows


def write_partitioned(rows: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """JSON lines by language, kind and split; rows of unknown language stay out. rows: lang_part, kind, split and the rest."""
    rows.where("lang_part is not null and lang_part != 'unknown'").write.mode(mode).option("ignoreNullFields", False).partitionBy("lang_part", "kind", "split").json(root)


def write_jsonl(df: DataFrame, path: str, order: list | None = None, one_file: bool = False, mode: str = "errorifexists") -> None:
    """JSON lines with nulls written out; one_file and order are for small results."""
    out = df.orderBy(*order) if order else df
    (out.coalesce(1) if one_file else out).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A small result as one JSON array."""
    df.agg(F.to_json(F.collect_list(F.struct("*"))).alias("value")).coalesce(1).write.mode(mode).text(path)


def write_dataset(train: DataFrame, validation: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Both parts of a dataset as Parquet, by split."""
    train.withColumn("split", F.lit("train")).unionByName(validation.withColumn("split", F.lit("validation"))).write.mode(mode).partitionBy("split").parquet(path)


def read_dataset(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def read_ratings(spark: SparkSession, root: str, names: str = "*raters_packet*.csv") -> DataFrame:
    """Rater CSVs (…raters_packet….csv) of a folder, with experiment_id and rater_id from the file's name."""
    rows = spark.read.option("header", True).option("pathGlobFilter", names).schema("prompt_id string, answer string, key string, guess string, confidence_1to5 int").csv(root)
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    return rows.withColumn("experiment_id", F.regexp_replace(stem, r"_?raters_packet.*$", "")).withColumn("rater_id", F.regexp_extract(stem, r"raters_packet_?(.*)$", 1))


def edits_cleaned(rows: DataFrame) -> DataFrame:
    """Edit marks out of body_text, target_text, text and context[].text, where present, and changed: how many fields changed.
    Write the result to a new path: the input is never overwritten."""
    from ..functions.text import clean_edited

    changed = F.lit(0)
    out = rows
    for c in [c for c in ("body_text", "target_text", "text") if c in rows.columns]:
        changed = changed + F.coalesce((clean_edited(F.col(c)) != F.col(c)).cast("int"), F.lit(0))
    if "context" in rows.columns:
        changed = changed + F.size(F.filter(F.coalesce("context", F.array()), lambda t: clean_edited(t["text"]) != t["text"]))
    out = out.withColumn("changed", changed)
    for c in [c for c in ("body_text", "target_text", "text") if c in rows.columns]:
        out = out.withColumn(c, clean_edited(F.col(c)))
    if "context" in rows.columns:
        out = out.withColumn("context", F.transform("context", lambda t: t.withField("text", clean_edited(t["text"]))))
    return out


def rewrite_tree(spark: SparkSession, root: str, out: str, schema: str, names: str = "*.jsonl") -> DataFrame:
    """Every file of JSON lines below root, edit marks cleaned, under out in a folder that names its path below root; the result
    counts rows and changed fields a file."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", names).json(root)
    below = F.regexp_extract(F.col("_metadata.file_path"), rf"{root.rstrip('/').split('/')[-1]}/(.+)$", 1)
    done = edits_cleaned(rows.withColumn("source_path", below))
    done.drop("changed").write.option("ignoreNullFields", False).partitionBy("source_path").json(out)
    return done.groupBy("source_path").agg(F.count(F.lit(1)).alias("rows"), F.sum("changed").cast("long").alias("changed"))


def write_stats(stats: DataFrame, root: str, by: str = "lang_part", mode: str = "errorifexists") -> None:
    """Statistics as JSON, a folder a language; rows without a language are the overall ones."""
    stats.withColumn(by, F.coalesce(by, F.lit("all"))).repartition(by).write.mode(mode).partitionBy(by).json(root)
