"""Social-platform exports: folders of message_*.json parts, one folder a conversation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import MEDIA_KEYS, georgian_first, is_ack
from ..functions.ids import conversation_id, hash_split, iso_from_ms, partner_id, short_hash
from ..operators.messages import language_backfill

_ANY = "array<struct<uri:string>>"
PART_SCHEMA = f"""participants array<string>, thread_path string, messages array<struct<
sender_name:string, timestamp_ms:bigint, content:string, message_id:string, replied_to_message_id:string, replied_to_message:struct<message_id:string>,
photos:{_ANY}, videos:{_ANY}, audio_files:{_ANY}, voice_messages:{_ANY}, gifs:{_ANY}, sticker:struct<uri:string>, share:struct<link:string,share_text:string>,
reactions:array<struct<reaction:string,actor:string>>>>"""


def read_parts(spark: SparkSession, root: str, chunks: bool = False, names: str = "message_*.json") -> DataFrame:
    """folder, file, participants (names), thread_path, messages, raw (each message as it stands) of every part that is JSON;
    UTF-8, else Latin-1. Participants may be objects with a name or plain strings. chunks: the folder's first level below
    root is part of a conversation's identity."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(root)
    text = F.coalesce(F.try_validate_utf8(F.col("content").cast("string")), F.decode("content", "ISO-8859-1"))
    rows = raw.select(F.regexp_replace("path", r"/[^/]*$", "").alias("folder"), F.col("path").alias("file"), F.from_json(text, PART_SCHEMA, {"mode": "PERMISSIVE"}).alias("p"), F.from_json(text, "messages array<string>", {"mode": "PERMISSIVE"})["messages"].alias("raw"))
    below = F.regexp_extract("folder", rf"{root.rstrip('/').split('/')[-1]}/([^/]+)", 1)
    named = F.transform("p.participants", lambda x: F.coalesce(F.get_json_object(x, "$.name"), x)).alias("participants")
    return rows.where("p.messages is not null").select("folder", "file", named, "p.thread_path", "p.messages", "raw", (below if chunks else F.lit(None).cast("string")).alias("chunk"))


def media_types(m: Column) -> Column:
    """One entry for each medium, in the order of the keys."""
    parts = []
    for key, kind in MEDIA_KEYS[:-2]:
        parts.append(F.array_repeat(F.lit(kind), F.coalesce(F.greatest(F.size(m[key]), F.lit(0)), F.lit(0))))
    parts.append(F.when(m["sticker"].isNotNull(), F.array(F.lit("sticker"))).otherwise(F.expr("cast(array() as array<string>)")))
    parts.append(F.when(m["share"].isNotNull(), F.array(F.lit("link"))).otherwise(F.expr("cast(array() as array<string>)")))
    return F.concat(*parts)


def parse(spark: SparkSession, root: str, me: Sequence[str], platform: str = "instagram", keep_emoji_only: bool = False, detector=None, names: str = "message_*.json") -> DataFrame:
    """Canonical messages of all conversations below root. platform: instagram or facebook, which differ in identifiers and in
    how texts are repaired."""
    prefix, chunks = ("fb-", True) if platform == "facebook" else ("ig-", False)
    parts = read_parts(spark, root, chunks, names)
    thread = ["folder", "chunk"]
    rows = parts.select(*thread, "file", "thread_path", "participants", F.posexplode(F.arrays_zip(F.col("messages").alias("m"), F.col("raw").alias("source"))).alias("pos", "both"))
    rows = rows.select("*", F.col("both.m").alias("m"), F.array_sort(F.json_object_keys("both.source")).alias("source_keys")).drop("both")
    repaired = T.fix_mojibake(F.coalesce(F.col("m.content"), F.lit("")), percent=chunks)
    rows = rows.withColumn("raw", T.fix_double_escapes(repaired)).withColumn("ts", F.coalesce("m.timestamp_ms", F.lit(0)))
    named = lambda c: T.sender_or_placeholder(T.name_norm(c), c)
    rows = rows.withColumn("sender", named(F.coalesce("m.sender_name", F.lit(""))))
    # in an array only column functions run: actors' names go without the compatibility form
    actor = lambda c: T.sender_or_placeholder(T.name_norm(c, form=None), c)
    group = Window.partitionBy("folder", F.coalesce("chunk", F.lit("")))
    order = group.orderBy("ts", "file", "pos")
    names = parts.select(*thread, F.explode("participants").alias("name")).select(*thread, named(F.col("name")).alias("n")).unionByName(rows.select(*thread, F.col("sender").alias("n")))
    who = names.groupBy(*thread).agg(F.sort_array(F.collect_set("n")).alias("people"))
    head = rows.groupBy(*thread).agg(F.min("ts").alias("earliest"), F.min_by("thread_path", F.when(F.length("thread_path") > 0, F.col("file"))).alias("path"), F.min("file").alias("first_file"))
    rows = rows.withColumn("thread_index", F.row_number().over(order) - 1).withColumn("thread_len", F.count(F.lit(1)).over(group))
    for side in (who, head):
        renamed = side.withColumnRenamed("folder", "__f").withColumnRenamed("chunk", "__c")
        rows = rows.join(renamed, (F.col("folder") == F.col("__f")) & F.col("chunk").eqNullSafe(F.col("__c"))).drop("__f", "__c")
    place = [F.coalesce("path", F.regexp_extract("folder", r"([^/]+)$", 1))] + ([F.col("chunk")] if chunks else [])
    rows = rows.withColumn("conversation_id", conversation_id(prefix, F.col("people"), F.col("earliest"), *place))
    body = T.normalized(T.redact_social(T.truncate_quotes(F.col("raw"))), "NFC")
    types, link = media_types(F.col("m")), F.length("m.share.link") > 0
    mine = F.col("sender").isin(*me)
    rows = rows.withColumns({"body_text": body, "types": types, "mine": mine})
    content = F.when(link, "link").when(F.size("types") > 0, F.element_at("types", 1)).when(F.length("raw") > 0, "text").otherwise("other")
    native = F.col("m.message_id") if platform == "instagram" else F.lit(None).cast("string")
    synthetic = F.concat_ws("-", "conversation_id", F.lpad(F.col("thread_index").cast("string"), 5, "0"))
    reply = F.coalesce(F.nullif("m.replied_to_message_id", F.lit("")), F.col("m.replied_to_message.message_id"))
    others = F.array_except("people", F.array("sender"))
    reactions = F.transform(F.filter("m.reactions", lambda r: F.length(r["reaction"]) > 0), lambda r: F.struct(actor(F.coalesce(r["actor"], F.lit(""))).alias("actor"), r["reaction"].alias("emoji"), iso_from_ms(F.col("ts")).alias("date")))
    if not keep_emoji_only:
        rows = rows.where(~T.only_emoji(F.col("raw")))
    out = rows.select(
        F.lit(platform).alias("platform"), F.col("first_file").alias("source_file"), "conversation_id", F.coalesce(F.nullif(native, F.lit("")), synthetic).alias("message_id"), iso_from_ms(F.col("ts")).alias("date"),
        F.col("sender").alias("from"), others.alias("to"), F.col("people").alias("participants"), F.when(F.col("mine"), "outbound").otherwise("inbound").alias("direction"), F.when(F.col("mine"), "you").otherwise("partner").alias("turn_role"),
        partner_id(F.when(F.col("mine"), others).otherwise(F.array("sender"))).alias("partner_id"), F.array_sort(F.transform(F.array_except("people", F.array(*[F.lit(x) for x in me])), lambda p: short_hash(p))).alias("partner_ids"),
        reply.isNotNull().alias("is_reply"), reply.alias("reply_to_message_id"), content.alias("content_type"), F.struct(F.size("types").alias("count"), F.array_distinct("types").alias("types")).alias("attachments"),
        F.col("raw").alias("body_raw"), "body_text", reactions.alias("reactions"), georgian_first(F.col("body_text"), detector=detector).alias("lang"), F.length("body_text").alias("char_len"), T.token_est(F.col("body_text"), up=True).alias("token_est"),
        T.has_emoji(F.col("raw")).alias("has_emoji"), "thread_index", "thread_len", hash_split(F.col("conversation_id")).alias("split"), is_ack(F.col("body_text")).alias("is_ack"),
        "source_keys",
    )
    return language_backfill(out, "conversation_id", "lang", "thread_index")
