"""Readers, parsers and writers as named queries: raw exports are made of the driver's tables in the shared folder, read back
through the engine's own readers, and held against SQL over the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import ids as I
from ..functions import text as T
from ..functions.regexlib import sql_stripped, sql_words
from ..operators import curate, dataset, generation, messages, stylometry
from ..operators.ranking import hash_key
from ..sources import chat_text, files, mailbox, social
from ..sources.shared import scratch
from . import views
from .catalog import _PAIRED, _docs, _records, _split_sql, _table, _turn_pairs, query

#: Conversations are dealt into so many chat files and social folders a table of small size.
CHATS = 20


def _joined(c: str) -> Column:
    return F.array_join(c, "|")


# ---- mail ---------------------------------------------------------------------------------------------------------------

# a message a turn: seconds since the first of March 2023, two hours ahead of UTC
_SECS = "(conv_id * 3600 + turn * 60)"


def _mailbox(spark, d) -> str:
    mine, secs = F.col("role") == "assistant", F.expr(_SECS)
    day = F.date_format(F.date_add(F.lit("2023-03-01").cast("date"), F.floor(secs / 86400).cast("int")), "EEE, dd MMM yyyy")
    clock = F.format_string("%02d:%02d:%02d +0200", F.floor(secs % 86400 / 3600), F.floor(secs % 3600 / 60), secs % 60)
    markup = F.replace(F.replace(F.col("said"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    html = F.col("turn") % 3 == 2
    head = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\n"))
    rows = _table(spark, d, "conversations").withColumn("said", F.regexp_replace(F.coalesce("text", F.lit("")), r"(^|\n)From ", "$1>From "))
    one = F.concat(
        F.lit("From sender@example.org Wed Mar 01 00:00:00 2023\n"), head("X-GM-THRID", F.concat(F.lit("t"), "conv_id")),
        head("From", F.when(mine, "Me <Me@Example.org>").otherwise(F.concat(F.lit('"Pat, '), "conv_id", F.lit('" <P'), "conv_id", F.lit("@Mail.example.com>")))),
        head("To", F.when(mine, F.concat(F.lit("p"), "conv_id", F.lit("@mail.example.com, P"), "conv_id", F.lit("@MAIL.example.com"))).otherwise("me@example.org")),
        F.when(F.col("conv_id") % 2 == 0, "Cc: Team <team@example.org>, boss@example.org\n").otherwise(""),
        head("Subject", F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("=?utf-8?q?Re=3A_Plan_caf=C3=A9_"), "conv_id", F.lit("?="))).otherwise(F.concat(F.lit("Fwd: Plan  "), "conv_id"))),
        head("Date", F.concat(day, F.lit(" "), clock)), head("Message-ID", F.concat(F.lit("<"), F.lpad("conv_id", 9, "0"), F.lit("."), F.lpad("turn", 5, "0"), F.lit("@x>"))),
        F.when(F.col("turn") > 0, F.concat(F.lit("In-Reply-To: <"), F.lpad("conv_id", 9, "0"), F.lit("."), F.lpad((F.col("turn") - 1).cast("string"), 5, "0"), F.lit("@x>\n"))).otherwise(""),
        F.when(F.col("turn") % 2 == 0, "X-Gmail-Labels: Inbox, Important,,\n").otherwise(""),
        F.when(html, "Content-Type: text/html; charset=utf-8\n").otherwise("Content-Type: text/plain; charset=utf-8\n"), F.lit("Content-Transfer-Encoding: 8bit\n\n"),
        F.when(html, F.concat(F.lit("<p>"), markup, F.lit("</p>"))).otherwise(F.col("said")), F.lit("\n"),
    )
    path = scratch(spark, "mailbox")
    rows.select(one.alias("value"), "conv_id").repartition("conv_id").select("value").write.text(path)
    return path


_SAID = "regexp_replace(coalesce(text, ''), '(^|\\n)From ', '\\1>From ', 'g')"
_MAIL = f"""
WITH m AS (SELECT conv_id, turn, role = 'assistant' AS mine, {sql_stripped(_SAID)} AS body_raw FROM conversations), k AS (SELECT * FROM m WHERE body_raw <> ''), own AS (SELECT DISTINCT conv_id FROM k WHERE mine)
SELECT '<' || lpad(conv_id::VARCHAR, 9, '0') || '.' || lpad(turn::VARCHAR, 5, '0') || '@x>' AS message_id, 't' || conv_id AS conversation_id, strftime(TIMESTAMP '2023-03-01' + to_seconds({_SECS} - 7200), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS date,
 CASE WHEN conv_id % 2 = 0 THEN 'Re: Plan café ' || conv_id ELSE 'Fwd: Plan  ' || conv_id END AS subject, CASE WHEN conv_id % 2 = 0 THEN 'Plan café ' || conv_id ELSE 'Plan ' || conv_id END AS subject_norm,
 CASE WHEN mine THEN 'me@example.org' ELSE 'p' || conv_id || '@mail.example.com' END AS sender, CASE WHEN mine THEN 'p' || conv_id || '@mail.example.com' ELSE 'me@example.org' END AS recipients,
 CASE WHEN conv_id % 2 = 0 THEN 'team@example.org|boss@example.org' ELSE '' END AS cc, CASE WHEN mine THEN 'outbound' ELSE 'inbound' END AS direction, CASE WHEN mine THEN 'you' ELSE 'partner' END AS turn_role,
 CASE WHEN mine THEN 'me@example.org' END AS account, CASE WHEN mine THEN 'example.org' END AS sender_domain, turn > 0 AS is_reply, CASE WHEN turn > 0 THEN '<' || lpad(conv_id::VARCHAR, 9, '0') || '.' || lpad((turn - 1)::VARCHAR, 5, '0') || '@x>' END AS reply_to,
 CASE WHEN turn % 3 = 2 THEN 'text/html' ELSE 'text/plain' END AS content_type, CASE WHEN turn % 2 = 0 THEN 'Inbox|Important' END AS labels, body_raw,
 row_number() OVER (PARTITION BY conv_id ORDER BY {_SECS}, turn) - 1 AS thread_index FROM k WHERE conv_id IN (SELECT conv_id FROM own)"""


@query(_MAIL)
def mail_export(spark, d):
    """A mailbox parsed: header decoding, addresses, dates, threads, labels, body choice, participation."""
    rows = mailbox.parse(spark, _mailbox(spark, d), ["ME@example.org"])
    return rows.select(
        "message_id", "conversation_id", "date", "subject", "subject_norm", F.col("from").alias("sender"), _joined("to").alias("recipients"), _joined("cc").alias("cc"), "direction", "turn_role", "account", "sender_domain", "is_reply",
        F.col("reply_to_message_id").alias("reply_to"), "content_type", _joined("labels").alias("labels"), "body_raw", F.col("thread_index").cast("long").alias("thread_index"),
    )


@query(f"SELECT count(*) AS messages, count(*) FILTER (direction = 'inbound') AS inbound, count(*) FILTER (direction = 'outbound') AS outbound, count(DISTINCT conversation_id) AS conversations FROM ({_MAIL})")
def mail_summary(spark, d):
    return messages.direction_counts(mailbox.parse(spark, _mailbox(spark, d), ["me@example.org"]))


# ---- chat text ------------------------------------------------------------------------------------------------------------

_CHAT_SAID = "translate(coalesce(text, ''), '-[:', '.(;')"
_CHAT_SECS = "(conv_id * 1000 + turn)"


def _chats(spark, d) -> str:
    secs = F.expr(_CHAT_SECS)
    day = F.date_add(F.lit("2023-02-13").cast("date"), F.floor(secs / 86400).cast("int"))
    hour = F.floor(secs % 86400 / 3600)
    minutes = F.format_string("%02d:%02d", F.floor(secs % 3600 / 60), secs % 60)
    bracket = F.concat(F.lit("["), F.date_format(day, "M/d/yy"), F.lit(", "), ((hour + 11) % 12 + 1).cast("string"), F.lit(":"), minutes, F.when(hour < 12, " AM] ").otherwise(" PM] "))
    dash = F.concat(F.date_format(day, "dd/MM/yyyy"), F.lit(", "), hour.cast("string"), F.lit(":"), minutes, F.lit(" - "))
    # month first is read first: the day-first form only stands for days over 12
    stamp = F.when((F.col("turn") % 2 == 1) & (F.dayofmonth(day) > 12), dash).otherwise(bracket)
    who = F.when(F.col("role") == "assistant", "Me Myself: ").when(F.col("role") == "system", "").otherwise(F.concat(F.lit("Pat "), F.col("conv_id") % 3, F.lit(": ")))
    said = F.concat(F.when(F.col("role") == "system", "Messages and calls are end-to-end encrypted. ").otherwise(""), F.expr(_CHAT_SAID))
    rows = _table(spark, d, "conversations").select((F.col("conv_id") % CHATS).alias("chat"), secs.alias("secs"), F.concat(stamp, who, said).alias("value"))
    path = scratch(spark, "chats")
    rows.repartition("chat").sortWithinPartitions("chat", "secs").select("chat", "value").write.partitionBy("chat").text(path)
    return path


_CHAT_ROWS = f"""
WITH s AS (SELECT conv_id % {CHATS} AS chat, {_CHAT_SECS} AS secs, role, CASE WHEN role = 'system' THEN 'Messages and calls are end-to-end encrypted. ' ELSE '' END || {_CHAT_SAID} AS body,
  CASE WHEN role = 'assistant' THEN 'me_myself' WHEN role = 'system' THEN 'system' ELSE 'pat_' || (conv_id % 3) END AS sender FROM conversations),
i AS (SELECT *, row_number() OVER (PARTITION BY chat ORDER BY secs) - 1 AS thread_index, count(*) OVER (PARTITION BY chat) AS thread_len FROM s),
p AS (SELECT chat, list_sort(list(DISTINCT sender)) AS people FROM s WHERE sender <> 'system' GROUP BY chat)
"""


@query(_CHAT_ROWS + f"""SELECT chat, thread_index, thread_len, strftime(TIMESTAMP '2023-02-13' + to_seconds(secs), '%Y-%m-%dT%H:%M:%S') || 'Z' AS date, sender, array_to_string([x FOR x IN people IF x <> sender], '|') AS recipients,
 array_to_string(people, '|') AS participants, array_to_string(list_sort([substr(sha1(x), 1, 10) FOR x IN people IF x <> 'me_myself']), '|') AS partner_ids, CASE WHEN sender = 'me_myself' THEN 'outbound' ELSE 'inbound' END AS direction,
 CASE WHEN sender = 'me_myself' THEN 'you' ELSE 'partner' END AS turn_role, body AS body_raw, {C.sql_chat_content_type('body')} AS content_type, {C.sql_chat_reply_hint('body')} AS is_reply FROM i LEFT JOIN p USING (chat) WHERE NOT {T.sql_only_emoji('body')}""")
def chat_export(spark, d):
    """Chat files parsed: two forms of first lines, continuation lines, system lines, times, places in the thread."""
    rows = chat_text.parse(spark, _chats(spark, d), ["me_myself"])
    chat = F.regexp_extract("source_file", r"chat=(\d+)", 1).cast("long").alias("chat")
    return rows.select(
        chat, F.col("thread_index").cast("long").alias("thread_index"), "thread_len", "date", F.col("from").alias("sender"), _joined("to").alias("recipients"), _joined("participants").alias("participants"), _joined("partner_ids").alias("partner_ids"),
        "direction", "turn_role", "body_raw", "content_type", "is_reply",
    )


@query(_CHAT_ROWS + ", o AS (SELECT chat, secs, body, sum(length(body)) OVER (PARTITION BY chat) AS size FROM s) SELECT chat, secs, body FROM o ORDER BY size, lpad(chat::VARCHAR, 9, '0'), secs LIMIT 200")
def running_limit_by_size(spark, d):
    """The first 200 messages, small conversations first."""
    said = F.concat(F.when(F.col("role") == "system", "Messages and calls are end-to-end encrypted. ").otherwise(""), F.expr(_CHAT_SAID))
    rows = _table(spark, d, "conversations").select(F.lpad((F.col("conv_id") % CHATS).cast("string"), 9, "0").alias("thread"), F.expr(_CHAT_SECS).alias("secs"), said.alias("body_text"))
    return messages.running_limit(rows, 200, "thread", "size", index="secs").select(F.col("thread").cast("long").alias("chat"), "secs", F.col("body_text").alias("body"))


@query("SELECT conv_id, turn FROM conversations ORDER BY lower('Inbox/' || (conv_id % 7)), conv_id, turn LIMIT 150")
def running_limit_by_path(spark, d):
    """The first 150 messages, conversations by path without case."""
    rows = _table(spark, d, "conversations").select("conv_id", "turn", F.lpad("conv_id", 12, "0").alias("thread"), F.concat(F.lit("Inbox/"), F.col("conv_id") % 7).alias("source_file"))
    return messages.running_limit(rows, 150, "thread", "folded", index="turn").select("conv_id", "turn")


@query("SELECT conv_id, turn FROM conversations ORDER BY conv_id, turn LIMIT 100")
def first_messages(spark, d):
    return messages.first_n(_table(spark, d, "conversations"), ["conv_id", "turn"], 100).select("conv_id", "turn")


# ---- social JSON ------------------------------------------------------------------------------------------------------------


def _social(spark, d) -> str:
    """A folder for each conversation group, one JSON part in it; names as objects and as plain strings."""
    mine = F.col("role") == "assistant"
    name = F.when(mine, "Me Myself").otherwise(F.concat(F.lit("Pat "), F.col("conv_id") % 3))
    number = F.expr(_CHAT_SECS)
    uri = F.struct(F.lit("a.jpg").alias("uri"))
    message = F.struct(
        number.alias("order"), name.alias("sender_name"), (F.lit(1700000000000) + number * 1000 + F.col("turn") * 7).alias("timestamp_ms"), F.coalesce("text", F.lit("")).alias("content"),
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit("m"), number)).alias("message_id"), F.when(F.col("turn") % 4 == 1, F.concat(F.lit("m"), number - 1)).alias("replied_to_message_id"),
        F.when(F.col("turn") % 4 == 3, F.struct(F.concat(F.lit("m"), number - 1).alias("message_id"))).alias("replied_to_message"), F.when(F.col("turn") % 5 == 4, F.array(uri, uri)).alias("photos"), F.when(F.col("turn") % 5 == 3, F.array(uri)).alias("videos"),
        F.when(F.col("turn") % 3 == 0, F.array(F.struct(F.lit("👍").alias("reaction"), F.lit("Pat 1").alias("actor")), F.struct(F.lit("").alias("reaction"), F.lit("Pat 2").alias("actor")))).alias("reactions"),
    )
    rows = _table(spark, d, "conversations").withColumn("g", F.col("conv_id") % CHATS)
    parts = rows.groupBy("g").agg(F.sort_array(F.collect_list(message)).alias("messages"))
    plain, named = F.array(F.lit("Me Myself"), F.lit("Silent One")), F.array(F.struct(F.lit("Me Myself").alias("name")), F.struct(F.lit("Silent One").alias("name")))
    path_ = F.concat(F.lit("inbox/g_"), "g").alias("thread_path")
    value = F.when(F.col("g") % 2 == 0, F.to_json(F.struct(plain.alias("participants"), path_, "messages"))).otherwise(F.to_json(F.struct(named.alias("participants"), path_, "messages")))
    out = scratch(spark, "social")
    parts.select("g", value.alias("value")).repartition("g").write.partitionBy("g").text(out)
    return out


@query(f"""
WITH s AS (SELECT conv_id % {CHATS} AS g, {_CHAT_SECS} AS n, turn, coalesce(text, '') AS body, CASE WHEN role = 'assistant' THEN 'me_myself' ELSE 'pat_' || (conv_id % 3) END AS sender, 1700000000000 + {_CHAT_SECS} * 1000 + turn * 7 AS ms FROM conversations),
h AS (SELECT g, min(ms) AS earliest, list_sort(list_distinct(list(sender) || ['me_myself', 'silent_one'])) AS people FROM s GROUP BY g),
i AS (SELECT s.*, people, row_number() OVER (PARTITION BY g ORDER BY ms, n) - 1 AS thread_index, count(*) OVER (PARTITION BY g) AS thread_len, 'ig-' || substr(sha1(array_to_string(people, '|') || '|' || earliest || '|inbox/g_' || g), 1, 10) AS conversation_id FROM s JOIN h USING (g))
SELECT conversation_id, CASE WHEN turn % 2 = 0 THEN 'm' || n ELSE conversation_id || '-' || lpad(thread_index::VARCHAR, 5, '0') END AS message_id, thread_index, thread_len, strftime(make_timestamp((ms // 1000) * 1000000), '%Y-%m-%dT%H:%M:%S') || 'Z' AS date,
 sender, array_to_string([x FOR x IN people IF x <> sender], '|') AS recipients, array_to_string(list_sort([substr(sha1(x), 1, 10) FOR x IN people IF x <> 'me_myself']), '|') AS partner_ids, CASE WHEN sender = 'me_myself' THEN 'outbound' ELSE 'inbound' END AS direction,
 turn % 2 = 1 AS is_reply, CASE WHEN turn % 2 = 1 THEN 'm' || (n - 1) END AS reply_to, CASE turn % 5 WHEN 4 THEN 'photo' WHEN 3 THEN 'video' ELSE CASE WHEN body <> '' THEN 'text' ELSE 'other' END END AS content_type,
 (CASE turn % 5 WHEN 4 THEN 2 WHEN 3 THEN 1 ELSE 0 END)::INT AS attachments, body AS body_raw, CASE WHEN turn % 3 = 0 THEN 'pat_1=👍' END AS reactions, {I.sql_hash_split('conversation_id')} AS split FROM i WHERE NOT {T.sql_only_emoji('body')}""")
def social_export(spark, d):
    """Social parts parsed: participants, thread path, identifiers, replies, media, reactions, times, splits."""
    rows = social.parse(spark, _social(spark, d), ["me_myself"], names="*.txt")
    shown = F.array_join(F.transform("reactions", lambda r: F.concat(r["actor"], F.lit("="), r["emoji"])), "|")
    return rows.select(
        "conversation_id", "message_id", F.col("thread_index").cast("long").alias("thread_index"), "thread_len", "date", F.col("from").alias("sender"), _joined("to").alias("recipients"), _joined("partner_ids").alias("partner_ids"), "direction", "is_reply",
        F.col("reply_to_message_id").alias("reply_to"), "content_type", F.col("attachments.count").alias("attachments"), "body_raw", shown.alias("reactions"), "split",
    )


@query(f"""SELECT conv_id % {CHATS} AS g, {_CHAT_SECS} AS number, array_to_string(list_sort(['content', 'order', 'sender_name', 'timestamp_ms'] || CASE WHEN turn % 2 = 0 THEN ['message_id'] ELSE [] END || CASE turn % 4 WHEN 1 THEN ['replied_to_message_id'] WHEN 3 THEN ['replied_to_message'] ELSE [] END
 || CASE turn % 5 WHEN 4 THEN ['photos'] WHEN 3 THEN ['videos'] ELSE [] END || CASE WHEN turn % 3 = 0 THEN ['reactions'] ELSE [] END), '|') AS keys FROM conversations""")
def source_keys(spark, d):
    """Keys of each raw message, through the chunked reader."""
    parts = social.read_parts(spark, _social(spark, d), chunks=True, names="*.txt").select(F.regexp_extract("chunk", r"g=(\d+)", 1).cast("long").alias("g"), F.explode("raw").alias("m"))
    return parts.select("g", F.get_json_object("m", "$.order").cast("long").alias("number"), _joined(F.array_sort(F.json_object_keys("m"))).alias("keys"))


# ---- identifiers, dates ----------------------------------------------------------------------------------------------------


@query("SELECT doc_id, substr(sha1(text), 1, 10) AS short, substr(sha1(text), 1, 16) AS long FROM documents")
def short_hashes(spark, d):
    return _docs(spark, d).select("doc_id", I.short_hash(F.col("text")).alias("short"), I.short_hash(F.col("text"), 16).alias("long"))


@query("""SELECT conv_id, 'fb-' || substr(sha1(array_to_string(list_sort(list(DISTINCT role)), '|') || '|' || min(turn) || '|chunk|' || conv_id), 1, 10) AS conversation_id,
 array_to_string(list_sort([substr(sha1(x), 1, 10) FOR x IN list(DISTINCT role)]), '|') AS people, 'chat::' || conv_id AS conversation_key FROM conversations GROUP BY conv_id""")
def conversation_ids(spark, d):
    rows = _table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"), F.min("turn").alias("earliest"))
    return rows.select(
        "conv_id", I.conversation_id("fb-", F.col("roles"), F.col("earliest"), F.lit("chunk"), F.col("conv_id").cast("string")).alias("conversation_id"),
        _joined(F.array_sort(F.transform("roles", lambda r: I.short_hash(r)))).alias("people"), I.conversation_key(F.lit("chat"), F.col("conv_id").cast("string")).alias("conversation_key"),
    )


@query("SELECT event_id, strftime(make_timestamp(1600000000000000 + event_id * 86399999000), '%Y-%m-%dT%H:%M:%S') || 'Z' AS date FROM events")
def iso_dates(spark, d):
    return _table(spark, d, "events").select("event_id", I.iso_from_ms(F.lit(1600000000000) + F.col("event_id") * 86399999).alias("date"))


_AT = "TIMESTAMP '2015-01-01' + to_seconds(o_orderkey * 7919 % 300000000)"


@query(f"SELECT o_orderkey, epoch_ms(date_trunc('minute', {_AT}) - INTERVAL 90 MINUTE) AS us_ms, epoch_ms(({_AT}) - INTERVAL 90 MINUTE) AS second_ms, CASE WHEN day({_AT}) > 12 THEN epoch_ms(({_AT}) - INTERVAL 90 MINUTE) END AS day_first_ms FROM orders")
def chat_dates(spark, d):
    """Stamps in three of the ten forms, an hour and a half ahead of UTC."""
    at = F.expr("timestamp_ntz'2015-01-01 00:00:00'") + F.make_dt_interval(secs=(F.col("o_orderkey") * 7919 % 300000000).cast("decimal(18,6)"))
    form = lambda f: F.date_format(at, f)
    ms = lambda stamp: F.unix_millis(I.chat_date(stamp, "+01:30"))
    rows = _table(spark, d, "orders").select("o_orderkey", form("M/d/yy, h:mm a").alias("us"), F.concat(form("M/d/yyyy, h:mm:ss"), F.lit(" "), F.lower(form("a"))).alias("second"), form("dd/MM/yyyy, H:mm:ss").alias("first"), F.dayofmonth(at).alias("day"))
    return rows.select("o_orderkey", ms(F.col("us")).alias("us_ms"), ms(F.col("second")).alias("second_ms"), F.when(F.col("day") > 12, ms(F.col("first"))).alias("day_first_ms"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'user_' || substr(sha1('💬' || c_custkey), 1, 10) ELSE 'customer_' || c_custkey END AS sender FROM customer")
def sender_placeholders(spark, d):
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("💬"), F.col("c_custkey").cast("string"))).otherwise(F.concat(F.lit(" Customer-"), "c_custkey"))
    key = T.name_norm(F.when(F.col("c_custkey") % 3 == 0, "💬").otherwise(raw))
    return _table(spark, d, "customer").select("c_custkey", T.sender_or_placeholder(key, raw).alias("sender"))


@query("SELECT doc_id, nfc_normalize(text || ' e' || chr(769)) AS body FROM documents")
def unicode_nfc(spark, d):
    return _docs(spark, d).select("doc_id", T.normalized(F.concat("text", F.lit(" é")), "NFC").alias("body"))


_ARROWED = "text || chr(10) || '> earlier' || chr(10) || 'more'"


@query(f"SELECT conv_id, turn, {T.sql_truncate_chat_quotes(_ARROWED)} AS body, {T.sql_truncate_chat_quotes('text')} AS own FROM conversations")
def truncate_chat_quotes(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", T.truncate_chat_quotes(F.concat("text", F.lit("\n> earlier\nmore"))).alias("body"), T.truncate_chat_quotes(F.col("text")).alias("own"))


@query("""SELECT doc_id, CASE WHEN length(text) < 20 THEN 'unknown' WHEN contains(lower(text), ' der ') THEN 'de' ELSE 'en' END AS safe_lang,
 CASE WHEN regexp_matches(text, '[\\x{10A0}-\\x{10FF}]') THEN 'ka' WHEN length(trim(text)) < 30 THEN 'unknown' WHEN contains(lower(text), ' der ') THEN 'de' ELSE 'en' END AS georgian_first FROM documents""")
def detector_hook(spark, d):
    """A detector of the user's own behind the engine's rules."""
    own = lambda t: F.when(F.contains(F.lower(t), F.lit(" der ")), "de").otherwise("en")
    return _docs(spark, d).select("doc_id", C.detected(F.col("text"), detector=own).alias("safe_lang"), C.georgian_first(F.col("text"), detector=own).alias("georgian_first"))


@query("SELECT c_custkey, c_custkey % 4 = 0 AS as_words, c_custkey % 2 = 0 AS as_phrases FROM customer")
def media_share(spark, d):
    """Texts of placeholders alone: word by word only the glued form counts, as phrases all do."""
    text = F.when(F.col("c_custkey") % 4 == 0, "x[LINK]y a[link]b").when(F.col("c_custkey") % 4 == 2, "[2/13/23, 8:49 PM] Ana Lopez: image omitted image omitted").otherwise(F.col("c_name"))
    return _table(spark, d, "customer").select("c_custkey", C.mostly_media(text).alias("as_words"), (C.mostly_media(text, phrases=True) | C.mostly_media(text)).alias("as_phrases"))


# ---- files -------------------------------------------------------------------------------------------------------------------

_MARKED = "CASE WHEN conv_id % 2 = 0 THEN coalesce(text, '') || ' <Edited>' ELSE coalesce(text, '') END"


@query("SELECT 'm' || conv_id || '-' || turn AS id, coalesce(text, '') AS text, 'chat' AS platform, length(coalesce(text, ''))::INT AS len_chars FROM conversations")
def jsonl_roundtrip(spark, d):
    """Canonical JSON lines written and read back, all files of a folder by a glob."""
    meta = F.struct(F.lit("chat").alias("platform"), F.lit(None).cast("string").alias("date"), F.length(F.coalesce("text", F.lit(""))).alias("len_chars"))
    path = scratch(spark, "jsonl")
    files.write_jsonl(_table(spark, d, "conversations").select(F.concat(F.lit("m"), "conv_id", F.lit("-"), "turn").alias("id"), F.coalesce("text", F.lit("")).alias("text"), meta.alias("meta")), path)
    return files.read_jsonl(spark, f"{path}/*.json", files.MONO_SCHEMA).select("id", "text", "meta.platform", "meta.len_chars")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 > 0")
def jsonl_tolerant(spark, d):
    """Lines that are no JSON and blank lines are left out."""
    line = F.when(F.col("doc_id") % 3 == 0, F.when(F.col("doc_id") % 2 == 0, "nonsense {").otherwise("")).otherwise(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), "text")))
    path = scratch(spark, "loose")
    _docs(spark, d).select(line.alias("value")).write.text(path)
    return files.read_jsonl(spark, path, "id string, text string", strict=False).where("id is not null").select(F.col("id").cast("long").alias("doc_id"))


@query("SELECT doc_id, lang, text FROM documents WHERE lang = 'de'")
def partitioned_roundtrip(spark, d):
    """Rows by language, kind and split; one language's folder read back; unknown ones aren't written."""
    path = scratch(spark, "parts")
    rows = _docs(spark, d).select("doc_id", "text", F.coalesce("lang", F.lit("unknown")).alias("lang_part"), F.lit("mono").alias("kind"), I.hash_split(F.col("doc_id").cast("string")).alias("split"))
    files.write_partitioned(rows, path)
    return files.read_partitioned(spark, path, "de").select("doc_id", F.col("lang_part").alias("lang"), "text")


@query(f"SELECT doc_id, text FROM documents WHERE {I.sql_hash_split('doc_id::VARCHAR')} = 'val'")
def dataset_roundtrip(spark, d):
    path = scratch(spark, "dataset")
    rows = _docs(spark, d).select("doc_id", "text", I.hash_split(F.col("doc_id").cast("string")).alias("s"))
    files.write_dataset(rows.where("s = 'train'").drop("s"), rows.where("s = 'val'").drop("s"), path)
    return files.read_dataset(spark, path, "validation").select("doc_id", "text")


@query("SELECT item_id, text FROM benchmark")
def json_array_roundtrip(spark, d):
    path = scratch(spark, "array")
    files.write_json_array(_table(spark, d, "benchmark").select("item_id", "text"), path)
    return files.read_json_array(spark, path, "item_id long, text string")


@query(f"SELECT conv_id, turn, {T.sql_clean_edited(_MARKED)} AS text, {T.sql_clean_edited(_MARKED)} AS said, 2 * (({T.sql_clean_edited(_MARKED)}) <> ({_MARKED}))::BIGINT AS changed FROM conversations")
def edits_rewrite(spark, d):
    """Edit marks out of flat and nested texts, changes counted."""
    text = F.when(F.col("conv_id") % 2 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" <Edited>"))).otherwise(F.coalesce("text", F.lit("")))
    rows = _table(spark, d, "conversations").select("conv_id", "turn", text.alias("text"), F.array(F.struct(F.lit("you").alias("role"), text.alias("text"))).alias("context"))
    return files.edits_cleaned(rows).select("conv_id", "turn", "text", F.get("context", F.lit(0))["text"].alias("said"), F.col("changed").cast("long").alias("changed"))


@query(f"SELECT conv_id % 3 AS part, count(*) AS rows, sum((({T.sql_clean_edited(_MARKED)}) <> ({_MARKED}))::BIGINT)::BIGINT AS changed FROM conversations GROUP BY 1")
def tree_rewrite(spark, d):
    """A tree of JSON lines rewritten into a tree of its own, changes counted."""
    text = F.when(F.col("conv_id") % 2 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" <Edited>"))).otherwise(F.coalesce("text", F.lit("")))
    root, out = scratch(spark, "tree"), scratch(spark, "tree-out")
    _table(spark, d, "conversations").select(text.alias("text"), (F.col("conv_id") % 3).alias("part")).write.partitionBy("part").json(root)
    done = files.rewrite_tree(spark, root, out, "text string", names="*.json")
    return done.groupBy(F.regexp_extract("source_path", r"part=(\d+)", 1).cast("long").alias("part")).agg(F.sum("rows").alias("rows"), F.sum("changed").alias("changed"))


@query("SELECT lang AS rater_id, doc_id::VARCHAR AS prompt_id, CASE WHEN quality = 1 THEN 'Human' ELSE 'LoRA' END AS key, (1 + doc_id % 5)::INT AS confidence_1to5 FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL")
def ratings_csv(spark, d):
    """Packets of raters as CSV, read as one table with the rater from the path."""
    rows = _docs(spark, d).join(_table(spark, d, "labels"), "doc_id").where("lang is not null").select(
        F.col("doc_id").cast("string").alias("prompt_id"), F.lit("x, y").alias("answer"), F.when(F.col("quality") == 1, "Human").otherwise("LoRA").alias("key"), F.lit("AI").alias("guess"), (1 + F.col("doc_id") % 5).cast("int").alias("confidence_1to5"), "lang"
    )
    path = scratch(spark, "exp_raters_packet")
    rows.write.partitionBy("lang").option("header", True).csv(path)
    return files.read_ratings(spark, path, names="*.csv").select(F.col("lang").alias("rater_id"), "prompt_id", "key", "confidence_1to5")


_STATS = f"SELECT lang, split, count(*) AS n FROM (SELECT lang, {I.sql_hash_split('doc_id::VARCHAR')} AS split FROM documents WHERE lang IS NOT NULL) GROUP BY ALL"


@query(f"{_STATS} UNION ALL SELECT 'all', split, sum(n)::BIGINT FROM ({_STATS}) GROUP BY split")
def stats_files(spark, d):
    """Statistics a language and over all, written as JSON by language and read back."""
    rows = _docs(spark, d).where("lang is not null").select("lang", I.hash_split(F.col("doc_id").cast("string")).alias("split"))
    per = rows.groupBy("lang", "split").agg(F.count(F.lit(1)).alias("n"))
    path = scratch(spark, "stats")
    files.write_stats(per.unionByName(rows.groupBy("split").agg(F.count(F.lit(1)).alias("n")).withColumn("lang", F.lit(None).cast("string"))).withColumnRenamed("lang", "lang_part"), path)
    return spark.read.schema("split string, n long, lang_part string").json(path).select(F.col("lang_part").alias("lang"), "split", "n")


# ---- splits, selection, datasets, generation ------------------------------------------------------------------------------------


@query(views.PAIRS_SQL + f"""SELECT id, split FROM pairs JOIN ({_split_sql('', 'SELECT DISTINCT conv_id FROM conversations', 'conv_id')}) s ON s.conv_id = split_part(id, '-', 2)::BIGINT""")
def pairs_in_split(spark, d):
    """Pairs joined to their conversation's split."""
    split = curate.exact_split(_table(spark, d, "conversations"), "conv_id").select(F.concat(F.lit("chat::"), "conv_id").alias("conversation"), "split")
    pairs = curate.context_pairs(_records(spark, d)).select("id", "meta.conversation")
    return curate.in_split(pairs, split).select("id", "split")


@query(f"""
WITH c AS (SELECT DISTINCT conv_id, CASE WHEN conv_id % 3 = 0 THEN 'ka' ELSE 'en' END AS lang FROM ({views.PAIRS_SQL} SELECT split_part(id, '-', 2)::BIGINT AS conv_id FROM pairs)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5('42|' || conv_id), conv_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM c)
SELECT lang, conv_id, CASE WHEN k <= floor(n * 0.8) THEN 'train' WHEN k <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM r""")
def pair_language_split(spark, d):
    """Each language's pair conversations split by themselves."""
    conv = F.split_part(F.col("id"), F.lit("-"), F.lit(2)).cast("long")
    pairs = curate.context_pairs(_records(spark, d)).select(conv.alias("conv_id"), F.when(conv % 3 == 0, "ka").otherwise("en").alias("lang"))
    return curate.split_by_language(pairs, thread="conv_id")


@query(views.PAIRS_SQL + """SELECT id AS original_id, substr(first, 10) AS partner_email, target_text AS your_response FROM (SELECT id, [c FOR c IN ctx IF starts_with(c, 'partner: ')][1] AS first, target_text FROM pairs)
WHERE split_part(id, '-', 2)::BIGINT % 3 > 0 AND length(substr(first, 10)) > 0 AND length(target_text) > 0""")
def answered_pairs(spark, d):
    """Pairs from 2020 on with the first partner turn of their context."""
    date = F.when(F.split_part(F.col("id"), F.lit("-"), F.lit(2)).cast("long") % 3 > 0, "2021-05-01T10:00:00Z").otherwise("12/31/2019")
    return curate.answered(curate.context_pairs(_records(spark, d)), date).select("original_id", "partner_email", "your_response")


@query("SELECT doc_id, (2015 + doc_id % 10)::INT AS year, doc_id % 10 >= 5 AS kept FROM documents")
def year_forms(spark, d):
    """Years of dates in three forms, and the filter on them."""
    n = F.col("doc_id") % 10
    year = (2015 + n).cast("string")
    date = F.when(n % 3 == 0, F.concat(year, F.lit("-01-01T00:30:00+02:00"))).when(n % 3 == 1, F.concat(F.lit("12/31/"), year)).otherwise(F.concat(F.lit("31/12/"), year))
    return _docs(spark, d).select("doc_id", I.year_of(date).cast("int").alias("year"), I.from_2020_on(date).alias("kept"))


@query("SELECT count(*) AS total, count(*) FILTER (n_chars < 1000) AS selected, count(*) FILTER (n_chars < 1000) / count(*) AS selection_rate, coalesce(avg(n_chars) FILTER (n_chars < 1000), 0) AS avg_style, coalesce(avg(doc_id) FILTER (n_chars < 1000), 0) AS avg_specialized FROM documents")
def selection_stats(spark, d):
    rows = _docs(spark, d).select(F.col("n_chars").alias("style_score"), F.col("doc_id").alias("specialized_score"))
    return curate.selection_stats(rows, F.col("style_score") < 1000)


@query(views.PAIRS_SQL + views.CHAT_SQL + """SELECT id, 'pair' AS kind, md5('42|pair|' || id) AS order_key FROM chats UNION ALL SELECT id, 'mono', md5('42|mono|' || id) FROM monos_of_pairs""")
def validation_set(spark, d):
    rows = _records(spark, d)
    return dataset.validation_set(dataset.chat_from_pairs(curate.context_pairs(rows)), dataset.chat_from_monos(curate.standalone(rows))).select("id", "kind", "order_key")


@query(f"SELECT doc_id, len({sql_words('text')})::BIGINT AS n_tokens, array_to_string({sql_words('text')}[1:64], ' ') AS tokens FROM documents")
def truncated_tokens(spark, d):
    return dataset.tokenized(_docs(spark, d), "text", most=64).select("doc_id", "n_tokens", F.array_join("tokens", " ").alias("tokens"))


@query("SELECT doc_id, text FROM documents")
def length_batches(spark, d):
    return dataset.length_buckets(_docs(spark, d), "text", 8).select("doc_id", "text")


@query("SELECT conv_id, turn, text, row_number() OVER (ORDER BY lpad(turn::VARCHAR, 6, '0'), conv_id::VARCHAR, turn) AS place FROM conversations")
def global_order(spark, d):
    """The canonical order of messages, as places in it."""
    from ..operators.ranking import with_rank

    key = F.lower(F.hex(F.concat(F.lpad("turn", 6, "0"), F.lit("\x01"), F.col("conv_id").cast("string")).cast("binary")))
    return with_rank(_table(spark, d, "conversations"), key, ["turn"]).select("conv_id", "turn", "text", F.col("rank").alias("place"))


_SHORT = sql_stripped(f"'Re: ' || lower(substr({sql_stripped('said')}, 1, 20))")


@query(f"SELECT conv_id, turn, CASE WHEN length(said) % 7 = 0 THEN 'ERROR: odd length' ELSE {_SHORT} END AS answer FROM ({_PAIRED})")
def generated_answers(spark, d):
    """A model of the user's own in the engine's frame; failures become texts."""

    def call(prompt: str) -> str:
        if len(prompt) % 7 == 0:
            raise ValueError("odd length")
        return "Re: " + prompt.strip()[:20].lower()

    return generation.generated(_turn_pairs(spark, d).select("conv_id", "turn", "said"), "said", "answer", call).select("conv_id", "turn", "answer")


@query(f"SELECT conv_id, turn, CASE WHEN length(said) % 7 = 0 THEN 'ERROR: odd length' ELSE 'In short, ' || length(said) END AS rewrite FROM ({_PAIRED})")
def rewritten_answers(spark, d):
    failed = F.when(F.length("said") % 7 == 0, "ERROR: odd length").otherwise(F.col("said"))
    rows = _turn_pairs(spark, d).select("conv_id", "turn", failed.alias("first"))
    return generation.rewritten(rows, "first", "rewrite", lambda p: f"In short, {len(p) - 3}", instruction="Say").select("conv_id", "turn", "rewrite")


def _samples(spark, d) -> tuple[DataFrame, DataFrame]:
    rows = _turn_pairs(spark, d).withColumn("sample", F.concat_ws("-", "conv_id", "turn"))
    made = rows.select("sample", F.when(F.length("said") % 7 == 0, "ERROR: x").otherwise(F.col("said")).alias("base"), F.col("answer").alias("lora"))
    return rows.select("sample", "answer"), made


@query(f"""WITH p AS ({_PAIRED}), v AS (SELECT conv_id || '-' || turn AS sample, unnest(['base', 'lora']) AS variant FROM p WHERE length(said) % 7 > 0 AND NOT starts_with(said, 'ERROR') AND NOT starts_with(answer, 'ERROR'))
SELECT sample, variant, variant = 'lora' AS same FROM v""")
def generation_samples(spark, d):
    """Originals joined to generated texts: a sample and variant a row; a text is its original's equal in both measures."""
    originals, made = _samples(spark, d)
    rows = stylometry.analyzed(originals, made, "sample", "answer", ["base", "lora"])
    return rows.select("sample", "variant", ((F.col("variant") == "lora") & (F.col("delta") == 0)).alias("same"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE round((o_totalprice - (o_orderkey % 5)) / (o_orderkey % 5) * 100, 4) END AS change FROM orders")
def relative_improvement(spark, d):
    return _table(spark, d, "orders").select("o_orderkey", F.round(stylometry.improvement((F.col("o_orderkey") % 5).cast("double"), F.col("o_totalprice")), 4).alias("change"))


@query("SELECT conv_id, array_to_string(list_sort([x FOR x IN list(DISTINCT role) IF x <> 'user']), '|') AS others, array_to_string(list_sort([x FOR x IN list(DISTINCT role) IF x IN ('user', 'assistant')]), '|') AS both FROM conversations GROUP BY conv_id")
def set_operations(spark, d):
    rows = _table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("r"))
    return rows.select("conv_id", _joined(F.array_sort(F.array_except("r", F.array(F.lit("user"))))).alias("others"), _joined(F.array_sort(F.array_intersect("r", F.array(F.lit("user"), F.lit("assistant"))))).alias("both"))
