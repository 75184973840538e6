"""Chat exports as text files, a file a conversation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import SYSTEM_STARTS, chat_content_type, chat_reply_hint, georgian_first, is_ack
from ..functions.ids import chat_date, conversation_id, hash_split, iso_from_ms, partner_id, short_hash
from ..operators.messages import language_backfill

# The two forms of a message's first line.
BRACKET = r"^\[([^\]]+)\]\s(?:([^:]+):\s)?(.*)$"
DASH = r"^([^-]+?)\s-\s(?:([^:]+):\s)?(.*)$"


def messages(files: DataFrame, offset: str = "+00:00") -> DataFrame:
    """files: file, value (the whole text). Result: file, ms, sender (null for none), text, place.

    A line that begins a message and has a date opens one; other lines continue it. After a first line whose date can't be
    read, which itself is added to the message before, lines up to the next first line are left out. Blank lines add a line
    break to an open message.
    """
    lines = files.select("file", F.posexplode(F.split(F.translate("value", T.ODD_SPACES, " " * 8), "\n", -1)).alias("pos", "line")).withColumn("line", F.regexp_replace("line", r"\r$", ""))
    lines = lines.withColumn("last", F.max("pos").over(Window.partitionBy("file"))).where("not (pos = last and line = '')").drop("last")
    blank = T.tidy(F.col("line")) == ""
    form = F.when(F.col("line").rlike(BRACKET), F.lit(BRACKET)).when(F.col("line").rlike(DASH), F.lit(DASH))
    part = lambda i: F.when(form == BRACKET, F.regexp_extract("line", BRACKET, i)).when(form == DASH, F.regexp_extract("line", DASH, i))
    lines = lines.withColumns({"stamp": F.when(~blank, chat_date(part(1), offset)), "sender": F.nullif(part(2), F.lit("")), "body": part(3)})
    kind = F.when(blank, "blank").when(form.isNull(), "more").when(F.col("stamp").isNotNull(), "first").otherwise("undated")
    lines = lines.withColumn("kind", kind)
    by = Window.partitionBy("file").orderBy("pos")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("number", F.sum((F.col("kind") == "first").cast("int")).over(so_far))
    lines = lines.withColumn("open", F.last(F.when(F.col("kind").isin("first", "undated"), F.col("kind")), ignorenulls=True).over(so_far) == "first")
    kept = lines.where("number > 0 and (kind in ('first', 'undated') or open)")
    said = F.when(F.col("kind") == "first", F.col("body")).when(F.col("kind") == "blank", F.lit("")).otherwise(F.col("line"))
    whole = kept.groupBy("file", "number").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", said.alias("said")))), lambda x: x["said"]), "\n").alias("text"),
        F.min_by("stamp", "pos").alias("stamp"), F.min_by("sender", "pos").alias("sender"), F.min_by("body", "pos").alias("body"),
    )
    return whole.select("file", (F.unix_millis("stamp")).alias("ms"), "sender", "text", "body", F.col("number").alias("place"))


def parse(spark: SparkSession, root: str, me: Sequence[str], offset: str = "+00:00", keep_emoji_only: bool = False, detector=None) -> DataFrame:
    """Canonical messages of all .txt files below root; bytes that aren't UTF-8 are replaced."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(root)
    files = raw.select(F.col("path").alias("file"), F.make_valid_utf8(F.col("content").cast("string")).alias("value"))
    rows = messages(files, offset)
    system = F.col("sender").isNull()
    for s in SYSTEM_STARTS:
        system = system | F.col("body").startswith(s)
    rows = rows.withColumn("from", F.when(system, "system").otherwise(T.name_norm(F.col("sender"), chat=True))).withColumn("system", system)
    people = rows.where("not system and `from` != 'unknown'").groupBy("file").agg(F.sort_array(F.collect_set("from")).alias("participants"))
    head = rows.groupBy("file").agg(F.min("ms").alias("earliest"))
    by = Window.partitionBy("file")
    rows = rows.withColumn("thread_index", F.row_number().over(by.orderBy("ms", "place")) - 1).withColumn("thread_len", F.count(F.lit(1)).over(by))
    rows = rows.join(people, "file", "left").join(head, "file").withColumn("participants", F.coalesce("participants", F.expr("cast(array() as array<string>)")))
    rows = rows.withColumn("conversation_id", conversation_id("wa-", F.col("participants"), F.col("earliest"), F.regexp_extract("file", r"([^/]+)$", 1)))
    if not keep_emoji_only:
        rows = rows.where(~T.only_emoji(F.col("text")))
    body = T.redact_social(T.truncate_chat_quotes(T.normalized(F.col("text"), "NFC")), ("weli", "year"))
    mine = ~F.col("system") & F.col("from").isin(*me)
    rows = rows.withColumns({"body_text": body, "mine": mine})
    others = F.when(F.col("system"), F.col("participants")).otherwise(F.array_except("participants", F.array("from")))
    kind = chat_content_type(F.col("text"))
    media = ~kind.isin("text", "other")
    out = rows.select(
        F.lit("whatsapp").alias("platform"), F.col("file").alias("source_file"), "conversation_id", F.concat_ws("-", "conversation_id", F.lpad(F.col("thread_index").cast("string"), 5, "0")).alias("message_id"), iso_from_ms(F.col("ms")).alias("date"),
        "from", others.alias("to"), "participants", F.when(F.col("mine"), "outbound").otherwise("inbound").alias("direction"), F.when(F.col("mine"), "you").otherwise("partner").alias("turn_role"),
        partner_id(F.when(F.col("mine"), others).otherwise(F.array("from"))).alias("partner_id"), F.array_sort(F.transform(F.array_except("participants", F.array(*[F.lit(x) for x in me])), lambda p: short_hash(p))).alias("partner_ids"),
        chat_reply_hint(F.col("text")).alias("is_reply"), F.lit(None).cast("string").alias("reply_to_message_id"), kind.alias("content_type"),
        F.struct(media.cast("int").alias("count"), F.when(media, F.array(kind)).otherwise(F.expr("cast(array() as array<string>)")).alias("types")).alias("attachments"),
        F.col("text").alias("body_raw"), "body_text", georgian_first(F.col("body_text"), detector=detector).alias("lang"), F.length("body_text").alias("char_len"), T.token_est(F.col("body_text"), up=True).alias("token_est"),
        T.has_emoji(F.col("text")).alias("has_emoji"), "thread_index", "thread_len", hash_split(F.col("conversation_id")).alias("split"), is_ack(F.col("body_text")).alias("is_ack"),
    )
    return language_backfill(out, "conversation_id", "lang", "thread_index")
