"""Every operator as a named query over the driver's tables, with the SQL it is held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import ids as I
from ..functions import lexicons as L
from ..functions import text as T
from ..functions.regexlib import Rule, sql_matches, sql_stripped, sql_text, sql_words, stripped, word_total
from ..operators import curate, dataset, messages, ratings, stylometry
from ..operators.ranking import hash_key, keep_first, with_rank
from . import views

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (spark, sf_dir) under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return put


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return messages.message_view(_table(spark, d, "conversations"))


# ---- text -----------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, {T.sql_tidy('text')} AS body FROM documents")
def whitespace_norm(spark, d):
    return _docs(spark, d).select("doc_id", T.tidy(F.col("text")).alias("body"))


_EDITED = "CASE WHEN conv_id % 2 = 0 THEN text || ' <This message was edited>' ELSE 'Edited. ' || text END"


def _edited():
    return F.when(F.col("conv_id") % 2 == 0, F.concat("text", F.lit(" <This message was edited>"))).otherwise(F.concat(F.lit("Edited. "), F.col("text")))


@query(f"SELECT conv_id, turn, {T.sql_clean_common(_EDITED)} AS body FROM conversations")
def clean_common(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", T.clean_common(_edited()).alias("body"))


@query(f"SELECT conv_id, turn, {T.sql_clean_edited(_EDITED)} AS body FROM conversations")
def edited_marker_clean(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", T.clean_edited(_edited()).alias("body"))


_SIGNED = "text || chr(10) || '> earlier' || chr(10) || '&gt;&nbsp;x,y' || chr(10) || 'Kind regards, Ana'"


def _signed():
    return F.concat("text", F.lit("\n> earlier\n&gt;&nbsp;x,y\nKind regards, Ana"))


@query(f"SELECT conv_id, turn, {T.sql_strip_quotes(_SIGNED)} AS body FROM conversations")
def quote_strip(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", T.strip_quotes_and_signatures(_signed()).alias("body"))


@query(f"SELECT doc_id, {T.sql_strip_quotes('text')} AS body FROM documents")
def quote_strip_documents(spark, d):
    return _docs(spark, d).select("doc_id", T.strip_quotes_and_signatures(F.col("text")).alias("body"))


@query(f"SELECT conv_id, turn, {T.sql_clean_mail_tail('text')} AS body FROM conversations")
def mail_tail_clean(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", T.clean_mail_tail(F.col("text")).alias("body"))


@query(f"SELECT conv_id, turn, {T.sql_clean_chat_placeholders(chr(39).join(['text || ', ' [2/13/23, 8:46:17 PM] Ana Lopez: image omitted', '']))} AS body FROM conversations")
def chat_placeholder_clean(spark, d):
    body = F.concat("text", F.lit(" [2/13/23, 8:46:17 PM] Ana Lopez: image omitted"))
    return _table(spark, d, "conversations").select("conv_id", "turn", T.clean_chat_placeholders(body).alias("body"))


@query(f"SELECT conv_id, turn, {T.sql_truncate_quotes(_SIGNED)} AS body FROM conversations")
def truncate_quotes(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", T.truncate_quotes(_signed()).alias("body"))


@query(f"SELECT doc_id, {T.sql_strip_mail_quotes('text')} AS body FROM documents")
def mail_quote_strip(spark, d):
    return _docs(spark, d).select("doc_id", T.strip_mail_quotes(F.col("text")).alias("body"))


@query(f"SELECT page_id, {T.sql_html_to_text('html')} AS body FROM pages")
def html_to_text(spark, d):
    return _table(spark, d, "pages").select("page_id", T.html_to_text(F.col("html")).alias("body"))


@query()
def html_to_text_full(spark, d):
    return _table(spark, d, "pages").select("page_id", T.html_to_text(F.col("html"), full=True).alias("body"))


_SUBJECT = "CASE WHEN conv_id % 2 = 0 THEN 'Re: Fwd:  ' || text ELSE ' FWD:' || text END"


@query(f"SELECT conv_id, turn, {T.sql_subject_norm(_SUBJECT)} AS subject FROM conversations")
def subject_norm(spark, d):
    raw = F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("Re: Fwd:  "), F.col("text"))).otherwise(F.concat(F.lit(" FWD:"), F.col("text")))
    return _table(spark, d, "conversations").select("conv_id", "turn", T.subject_norm(raw).alias("subject"))


@query(f"SELECT c_custkey, {T.sql_name_norm('c_name')} AS name FROM customer")
def name_norm(spark, d):
    return _table(spark, d, "customer").select("c_custkey", T.name_norm(F.col("c_name")).alias("name"))


@query(
    "SELECT doc_id, regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[EMAIL]', 'g'), 'https?://[^\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', '[LINK]', 'g') AS body FROM documents"
)
def pii_redact_email_url(spark, d):
    return _docs(spark, d).select("doc_id", Rule(r"https?://\S+", "[LINK]").column(Rule(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "[EMAIL]").column(F.col("text"))).alias("body"))


@query(f"SELECT doc_id, {T.sql_redact_mail('text')} AS body FROM documents")
def pii_redact_mail(spark, d):
    return _docs(spark, d).select("doc_id", T.redact_mail(F.col("text")).alias("body"))


@query(f"SELECT doc_id, {T.sql_redact_social('text')} AS body FROM documents")
def pii_redact_social(spark, d):
    return _docs(spark, d).select("doc_id", T.redact_social(F.col("text")).alias("body"))


@query()
def mojibake_repair(spark, d):
    """Repairs of the texts as they are, and (the tables hold few broken texts) of the whole texts broken with a sample
    appended: garbled is repaired to the text and the sample."""
    text = F.col("text")
    garbled = F.decode(F.encode(F.concat(text, F.lit(" “quoted” – text 😀 ")), "UTF-8"), "ISO-8859-1")
    return _table(spark, d, "conversations").select(
        "conv_id", "turn", T.fix_mojibake(text).alias("fixed"), T.fix_double_escapes(text).alias("unescaped"),
        T.fix_mojibake(garbled).alias("fixed_garbled"), T.fix_double_escapes(F.concat(text, F.lit(" \\u10D0"))).alias("unescaped_sample"),
    )


@query(f"SELECT doc_id, {T.sql_has_emoji('text')} AS has_emoji, {T.sql_only_emoji('text')} AS only_emoji FROM documents")
def emoji_flags(spark, d):
    return _docs(spark, d).select("doc_id", T.has_emoji(F.col("text")).alias("has_emoji"), T.only_emoji(F.col("text")).alias("only_emoji"))


@query(f"SELECT conv_id, turn, {C.sql_is_ack('text')} AS is_ack FROM conversations")
def ack_flag(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", C.is_ack(F.col("text")).alias("is_ack"))


_NOISE = C.sql_noise_flags("text")


@query(f"SELECT doc_id, {', '.join(f'{v} AS {k}' for k, v in _NOISE.items())} FROM documents")
def noise_flags(spark, d):
    flags = C.noise_flags(F.col("text"))
    return _docs(spark, d).select("doc_id", *[flags[k].alias(k) for k in _NOISE])


@query("SELECT doc_id, greatest(1, length(text) // 4)::INT AS floor_est, greatest(1, (length(text) + 3) // 4)::INT AS ceil_est FROM documents")
def token_estimates(spark, d):
    return _docs(spark, d).select("doc_id", T.token_est(F.col("text")).alias("floor_est"), T.token_est(F.col("text"), up=True).alias("ceil_est"))


@query(f"""SELECT conv_id, turn, {C.sql_chat_content_type('text')} AS content_type, {C.sql_chat_reply_hint('text')} AS reply_hint, {C.sql_chat_content_type("(text || ' image omitted')")} AS marked_type,
 {C.sql_chat_content_type("(text || ' www.example.org/a')")} AS linked_type, {C.sql_chat_reply_hint("('> ' || text)")} AS quoted_hint FROM conversations""")
def content_types(spark, d):
    """Of every text as it is, and of the whole text with a media mark, a link or a reply mark added."""
    text = F.col("text")
    return _table(spark, d, "conversations").select(
        "conv_id", "turn", C.chat_content_type(text).alias("content_type"), C.chat_reply_hint(text).alias("reply_hint"),
        C.chat_content_type(F.concat(text, F.lit(" image omitted"))).alias("marked_type"), C.chat_content_type(F.concat(text, F.lit(" www.example.org/a"))).alias("linked_type"),
        C.chat_reply_hint(F.concat(F.lit("> "), text)).alias("quoted_hint"),
    )


# ---- language -------------------------------------------------------------------------------------------------------

_BUCKETS = C.sql_language_bucket("documents", "doc_id", "text")


@query(_BUCKETS)
def lang_bucket(spark, d):
    return _docs(spark, d).select("doc_id", C.language_bucket(F.col("text")).alias("lang"))


@query(f"SELECT lang, count(*) AS n FROM ({_BUCKETS}) GROUP BY lang")
def lang_bucket_stats(spark, d):
    return lang_bucket(spark, d).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(C.sql_language_bucket("(SELECT conv_id * 1000 + turn AS id, text FROM conversations)", "id", "text"))
def lang_bucket_messages(spark, d):
    return _table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), C.language_bucket(F.col("text")).alias("lang"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '[\\x{10A0}-\\x{10FF}]') THEN 'ka' ELSE 'unknown' END AS lang FROM documents")
def georgian_first(spark, d):
    return _docs(spark, d).select("doc_id", C.georgian_first(F.col("text")).alias("lang"))


_KNOWN = "SELECT doc_id, source, CASE WHEN length(text) < 200 THEN 'unknown' ELSE lang END AS lang FROM documents"


@query(f"""
WITH t AS ({_KNOWN}), c AS (SELECT source, lang, count(*) AS n, min(doc_id) AS f FROM t WHERE lang <> 'unknown' GROUP BY ALL),
m AS (SELECT source, arg_max(lang, (n, -f)) AS most FROM c GROUP BY source)
SELECT doc_id, t.source, CASE WHEN lang = 'unknown' THEN coalesce(most, 'unknown') ELSE lang END AS lang FROM t LEFT JOIN m USING (source)""")
def lang_majority_backfill(spark, d):
    rows = _docs(spark, d).select("doc_id", "source", F.when(F.length("text") < 200, "unknown").otherwise(F.col("lang")).alias("lang"))
    return messages.language_backfill(rows, "source", "lang", "doc_id").select("doc_id", "source", "lang")


# ---- deduplication, threads, semi joins ---------------------------------------------------------------------------------

_DUP = T.sql_dedup_text("text")


@query(f"SELECT min(doc_id) AS doc_id, {_DUP} AS norm FROM documents GROUP BY 2")
def near_dup_keep_first(spark, d):
    rows = _docs(spark, d).select("doc_id", T.dedup_text(F.col("text")).alias("norm"))
    return keep_first(rows, [F.col("norm")], ["doc_id"])


@query(f"SELECT group_size, count(*) AS groups FROM (SELECT count(*) AS group_size FROM documents GROUP BY {_DUP}) GROUP BY 1")
def dup_group_sizes(spark, d):
    return _docs(spark, d).groupBy(T.dedup_text(F.col("text")).alias("k")).agg(F.count(F.lit(1)).alias("group_size")).groupBy("group_size").agg(F.count(F.lit(1)).alias("groups"))


@query("SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS thread_index, count(*) OVER (PARTITION BY user_id) AS thread_len FROM events")
def thread_index(spark, d):
    rows = _table(spark, d, "events").select("event_id", "user_id", "ts")
    return messages.thread_index(rows, "user_id", "ts", "event_id").select("event_id", "user_id", F.col("thread_index").cast("long"), "thread_len")


@query("SELECT conv_id, count(*) AS thread_len, min(turn) AS earliest, array_to_string(list_sort(list(DISTINCT role)), '|') AS participants FROM conversations GROUP BY conv_id")
def thread_stats(spark, d):
    rows = messages.thread_stats(_table(spark, d, "conversations"), "conv_id", F.col("turn"), F.col("role"))
    return rows.withColumn("participants", F.array_join("participants", "|"))


@query("SELECT c.conv_id, c.turn FROM conversations c WHERE c.conv_id IN (SELECT conv_id FROM conversations WHERE role = 'assistant')")
def participated_semi(spark, d):
    rows = _table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "assistant", "outbound").otherwise("inbound").alias("direction"))
    return messages.participated(rows, ["conv_id"]).select("conv_id", "turn")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_unlabelled(spark, d):
    return _docs(spark, d).select("doc_id").join(_table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@query("SELECT conv_id::VARCHAR AS conversation_id, CASE WHEN role = 'assistant' THEN 'you' ELSE 'partner' END AS turn_role, turn AS thread_index, coalesce(text, '') AS body_text FROM conversations")
def message_view(spark, d):
    return _messages(spark, d).select("conversation_id", "turn_role", "thread_index", "body_text")


# ---- pairs, standalone samples, splits --------------------------------------------------------------------------------


def _records(spark, d):
    rows = _messages(spark, d)
    return rows.withColumn("body_text", T.clean_common(F.col("body_text"))).where("body_text != ''").withColumn("conversation_key", I.conversation_key(F.col("platform"), F.col("conversation_id"))).withColumn("lang", F.lit("en"))


@query(views.PAIRS_SQL + "SELECT id, context, target_text FROM pairs")
def context_pairs(spark, d):
    pairs = curate.context_pairs(_records(spark, d))
    return pairs.select("id", F.array_join(F.transform("context", lambda t: F.concat(t["role"], F.lit(": "), t["text"])), "\n").alias("context"), "target_text")


@query(views.PAIRS_SQL + "SELECT size, count(*) AS n FROM pairs GROUP BY size")
def context_sizes(spark, d):
    return curate.context_pairs(_records(spark, d)).groupBy(F.size("context").cast("long").alias("size")).agg(F.count(F.lit(1)).alias("n"))


@query(views.MONO_SQL + "SELECT id, text FROM monos")
def mono_examples(spark, d):
    return curate.standalone(_records(spark, d)).select("id", "text")


_CURATED = f"""
WITH b AS (SELECT conv_id::VARCHAR AS conversation_id, turn AS thread_index, CASE WHEN role = 'assistant' THEN 'you' ELSE 'partner' END AS turn_role, {T.sql_strip_quotes(T.sql_clean_common("coalesce(text, '')"))} AS body_text FROM conversations),
f AS (SELECT arg_min({{'c': conversation_id, 'i': thread_index, 'r': turn_role, 'b': body_text}}, (lpad(thread_index::VARCHAR, 6, '0'), conversation_id, thread_index)) AS x FROM b WHERE body_text <> '' GROUP BY {T.sql_dedup_text("(body_text || '|' || turn_role)")}),
k AS (SELECT row_number() OVER (ORDER BY x.c, x.i) AS row_key, x.c AS conversation_id, x.i AS thread_index, x.r AS turn_role, x.b AS body_text FROM f), l AS ({C.sql_language_bucket("k", "row_key", "body_text")})
SELECT conversation_id, thread_index, turn_role, body_text, lang FROM k JOIN l USING (row_key)"""


@query(_CURATED)
def curated_records(spark, d):
    rows = messages.without_repeats(messages.cleaned(_messages(spark, d)), ["date", "conversation_id", "thread_index"])
    return rows.select("conversation_id", "thread_index", "turn_role", "body_text", "lang")


@query(views.PAIRS_SQL + f""", monos AS ({views.MONOS_SQL}), r AS (SELECT count(*) AS records_total, count(DISTINCT conv_id) AS unique_conversations FROM records),
p AS (SELECT count(*) AS pair_total, coalesce(avg(length(target_text)), 0) AS avg_pair_len FROM pairs), m AS (SELECT count(*) AS mono_total, coalesce(avg(length(text)), 0) AS avg_mono_len FROM monos)
SELECT *, '{{"chat":' || records_total || '}}' AS by_platform, '{{"en":' || records_total || '}}' AS by_lang FROM r, p, m""")
def corpus_stats(spark, d):
    rows = _records(spark, d)
    out = curate.corpus_stats(rows, curate.context_pairs(rows), curate.standalone(rows))
    return out.withColumns({c: F.to_json(c) for c in ("by_platform", "by_lang")})


def _split_sql(group: str, ids: str, column: str) -> str:
    over = f"PARTITION BY {group}" if group else ""
    return f"""
WITH r AS (SELECT *, row_number() OVER ({over} ORDER BY md5('42|' || {column}::VARCHAR), {column}) AS k, count(*) OVER ({over}) AS n FROM ({ids}))
SELECT {group + ', ' if group else ''}{column}, CASE WHEN k <= floor(n * 0.8) THEN 'train' WHEN k <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM r"""


@query(_split_sql("", "SELECT DISTINCT conv_id FROM conversations", "conv_id"))
def split_exact(spark, d):
    return curate.exact_split(_table(spark, d, "conversations"), "conv_id")


@query(_split_sql("lang", "SELECT DISTINCT lang, doc_id FROM documents", "doc_id"))
def split_per_lang(spark, d):
    return curate.exact_split(_docs(spark, d), "doc_id", group=["lang"])


@query(f"SELECT doc_id, {I.sql_hash_split('doc_id::VARCHAR')} AS split FROM documents")
def split_hash_sha1(spark, d):
    return _docs(spark, d).select("doc_id", I.hash_split(F.col("doc_id").cast("string")).alias("split"))


@query(f"SELECT lang, split, count(*) AS n FROM (SELECT lang, {I.sql_hash_split('doc_id::VARCHAR')} AS split FROM documents) GROUP BY ROLLUP (lang, split)")
def split_counts_rollup(spark, d):
    rows = _docs(spark, d).select("lang", I.hash_split(F.col("doc_id").cast("string")).alias("split"))
    return curate.split_counts(rows, ["lang", "split"])


# ---- chat datasets ------------------------------------------------------------------------------------------------------


def _flat(chats):
    return chats.select("id", F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"])), "\n").alias("messages"), "labels")


@query(views.PAIRS_SQL + views.CHAT_SQL + "SELECT id, messages, target_text AS labels FROM chats")
def chat_from_pairs(spark, d):
    return _flat(dataset.chat_from_pairs(curate.context_pairs(_records(spark, d))))


@query(views.MONO_SQL + f"SELECT id, 'system={dataset.STYLE.replace(chr(39), chr(39) * 2)}' || chr(10) || 'user={dataset.MONO_CUE}' || chr(10) || 'assistant=' || text AS messages, text AS labels FROM monos")
def chat_from_mono(spark, d):
    return _flat(dataset.chat_from_monos(curate.standalone(_records(spark, d))))


@query(views.MONO_SQL + f"SELECT id, '<|system|>' || chr(10) || '{dataset.STYLE.replace(chr(39), chr(39) * 2)}<|end|>' || chr(10) || '<|user|>' || chr(10) || '{dataset.MONO_CUE}<|end|>' || chr(10) || '<|assistant|>' || chr(10) || text || '<|end|>' || chr(10) AS text FROM monos")
def chat_template(spark, d):
    return dataset.rendered(dataset.chat_from_monos(curate.standalone(_records(spark, d)))).select("id", "text")


@query(views.PAIRS_SQL + views.CHAT_SQL + """, m AS (SELECT id FROM monos_of_pairs), sizes AS (SELECT (SELECT count(*) FROM chats) AS p, (SELECT count(*) FROM m) AS q),
want AS (SELECT p, q, floor((p + q) * 0.75)::BIGINT AS wp FROM sizes),
r AS (SELECT id, 'pair' AS kind, row_number() OVER (ORDER BY md5('42|' || id), id) AS k FROM chats UNION ALL SELECT id, 'mono', row_number() OVER (ORDER BY md5('42|' || id), id) FROM m)
SELECT id, kind FROM r, want WHERE k <= CASE kind WHEN 'pair' THEN least(wp, p) ELSE least(p + q - wp, q) END""")
def weighted_mix(spark, d):
    rows = _records(spark, d)
    return dataset.weighted_mix(dataset.chat_from_pairs(curate.context_pairs(rows)), dataset.chat_from_monos(curate.standalone(rows))).select("id", "kind")


# ---- style ---------------------------------------------------------------------------------------------------------------

_in = lambda terms: " + ".join(f"contains(low, {sql_text(t)})::INT" for t in terms)
_STYLE = f"""
SELECT doc_id, ({_in(stylometry.TECHNICAL + stylometry.BUSINESS)})::BIGINT AS specialized_score, n AS word_count,
 round(({_in(stylometry.STYLE)}) + ({_in(stylometry.PERSONAL)}) / 10 + 2 * ({_in(stylometry.SHORT_FORMS)}) + 1.5 * ({_in(stylometry.CASUAL)}), 6) AS style_score
FROM (SELECT doc_id, lower(text) AS low, len({sql_words('text')})::BIGINT AS n FROM documents)"""


@query(_STYLE)
def style_score(spark, d):
    return stylometry.style_scores(_docs(spark, d)).select("doc_id", "specialized_score", F.round("style_score", 6).alias("style_score"), "word_count")


@query(f"SELECT * FROM ({_STYLE}) WHERE specialized_score < 4 AND style_score > 1.5 AND word_count BETWEEN 6 AND 149 ORDER BY style_score DESC, specialized_score, doc_id LIMIT 50")
def eval_topk(spark, d):
    return stylometry.top_style(stylometry.style_scores(_docs(spark, d)).withColumn("style_score", F.round("style_score", 6)), 50, ["doc_id"]).select("doc_id", "specialized_score", "style_score", "word_count")


@query("SELECT year(o_orderdate) + 24 AS year, count(*) AS n FROM orders WHERE year(o_orderdate) + 24 >= 2020 GROUP BY 1")
def year_filter(spark, d):
    """Orders 24 years on: some before 2020, some after."""
    rows = _table(spark, d, "orders").select(F.concat((F.year("o_orderdate") + 24).cast("string"), F.date_format("o_orderdate", "-MM-dd'T'HH:mm:ss")).alias("date"))
    return rows.where(I.from_2020_on(F.col("date"))).groupBy(I.year_of(F.col("date")).cast("long").alias("year")).agg(F.count(F.lit(1)).alias("n"))


def _rounded(df, key, names):
    return df.select(key, *[F.round(F.col(n).cast("double"), 6).alias(n) for n in names])


_R = lambda e: f"round(({e})::DOUBLE, 6)"
_part = lambda a, b: f"CASE WHEN {b} > 0 THEN {a} / {b} ELSE 0 END"
_hits = lambda ws, xs: f"len([w FOR w IN {ws} IF w IN {C._sql_list(xs)}])"
_W, _S, _K = r"[\p{L}\p{N}]+", r"[^.!?]*[^.!?\s][^.!?]*", r"[\p{L}\p{N}]+|[^\s\p{L}\p{N}]"


@query(f"""
SELECT doc_id, {_R('n')} AS word_count, {_R('s')} AS sentence_count, {_R(_part('n', 's'))} AS avg_sentence_length, {_R(_part('list_sum([length(w) FOR w IN ws])', 'n'))} AS avg_word_length,
 {_R(_part('(length(text) - length(replace(text, chr(33), chr(0))) + len(regexp_extract_all(text, chr(33))))', 's'))} AS exclamation_ratio, {_R(_part(_hits('ws', stylometry.INFORMAL), 'n'))} AS informal_ratio
FROM (SELECT *, len(ws) AS n FROM (SELECT doc_id, text, regexp_extract_all(lower(text), '{_W}') AS ws, len(regexp_extract_all(text, '{_S}')) AS s FROM documents))""")
def basic_style(spark, d):
    return _rounded(stylometry.basic_features(_docs(spark, d)), "doc_id", ["word_count", "sentence_count", "avg_sentence_length", "avg_word_length", "exclamation_ratio", "informal_ratio"])


@query(f"""
WITH w AS (SELECT doc_id, unnest([x FOR x IN regexp_extract_all(lower(text), '{_W}') IF x NOT IN {C._sql_list(L.ENGLISH_STOPWORDS)}]) AS w FROM documents),
f AS (SELECT doc_id, w, count(*)::DOUBLE AS f FROM w GROUP BY ALL),
a AS (SELECT doc_id, sum(f) AS n, count(*)::DOUBLE AS v, count(*) FILTER (f = 1)::DOUBLE AS one, count(*) FILTER (f = 2)::DOUBLE AS two, sum(f * f) AS sq, sum(f * (f - 1)) AS fall FROM f GROUP BY doc_id)
SELECT doc_id, {_R('coalesce(v / n, 0)')} AS type_token_ratio, {_R('coalesce(one / n, 0)')} AS hapax_legomena_ratio, {_R('coalesce(two / n, 0)')} AS dis_legomena_ratio, {_R('coalesce(10000 * sq / (n * n), 0)')} AS yule_k,
 {_R('CASE WHEN n > 1 THEN fall / (n * (n - 1)) ELSE 0 END')} AS simpson_d, {_R('coalesce(pow(n, pow(v, -0.172)), 0)')} AS brunet_w, {_R('CASE WHEN one > 0 AND one < v THEN 100 * ln(n) / (1 - one / v) ELSE 0 END')} AS honore_statistic
FROM documents LEFT JOIN a USING (doc_id)""")
def lexical_richness(spark, d):
    names = ["type_token_ratio", "hapax_legomena_ratio", "dis_legomena_ratio", "yule_k", "simpson_d", "brunet_w", "honore_statistic"]
    return _rounded(stylometry.lexical_features(_docs(spark, d)), "doc_id", names)


@query(f"""
SELECT doc_id, {_R(_part(_hits('ts', stylometry.FUNCTION_WORDS), 'n'))} AS function_word_ratio, {_R(_part(_hits('ts', stylometry.PREPOSITIONS), 'n'))} AS preposition_ratio, {_R(_part(_hits('ts', stylometry.CONJUNCTIONS), 'n'))} AS conjunction_ratio,
 {_R(_part('n', 's'))} AS avg_words_per_sentence
FROM (SELECT *, len(ts) AS n FROM (SELECT doc_id, regexp_extract_all(lower(text), '{_K}') AS ts, len(regexp_extract_all(text, '{_S}')) AS s FROM documents))""")
def syntactic(spark, d):
    return _rounded(stylometry.syntactic_features(_docs(spark, d)), "doc_id", ["function_word_ratio", "preposition_ratio", "conjunction_ratio", "avg_words_per_sentence"])


def _ngram_sql(n):
    return f"""
WITH t AS (SELECT doc_id, lower({T.sql_tidy("coalesce(text, '')")}) AS t FROM documents), g AS (SELECT doc_id, t, unnest(CASE WHEN length(t) >= {n} THEN range(1, length(t) - {n - 2}) ELSE [] END) AS i FROM t),
f AS (SELECT doc_id, substr(t, i, {n}) AS g, count(*)::DOUBLE AS f FROM g GROUP BY ALL), a AS (SELECT doc_id, sum(f) AS n, count(*)::DOUBLE AS v FROM f GROUP BY ALL),
e AS (SELECT doc_id, any_value(n) AS n, any_value(v) AS v, -sum(f / n * log2(f / n)) AS h FROM f JOIN a USING (doc_id) GROUP BY ALL)
SELECT doc_id, {_R('coalesce(v / n, 0)')} AS char_{n}gram_ttr, {_R('coalesce(h, 0)')} AS char_{n}gram_entropy, {_R('coalesce(n / v, 0)')} AS char_{n}gram_avg_freq FROM documents LEFT JOIN e USING (doc_id)"""


def _ngrams(spark, d, n):
    names = [f"char_{n}gram_{x}" for x in ("ttr", "entropy", "avg_freq")]
    return stylometry.char_ngram_features(_docs(spark, d), n).select("doc_id", *[F.round(x, 6).alias(x) for x in names])


@query(_ngram_sql(3))
def char_ngrams_3(spark, d):
    return _ngrams(spark, d, 3)


@query(_ngram_sql(4))
def char_ngrams_4(spark, d):
    return _ngrams(spark, d, 4)


def _features_sql(source: str) -> str:
    """Common table expressions up to features: k and the 26 features, of source's k and text."""
    grams = lambda n: f"""
t{n} AS (SELECT k, t, unnest(CASE WHEN length(t) >= {n} THEN range(1, length(t) - {n - 2}) ELSE [] END) AS i FROM (SELECT k, lower({T.sql_tidy('text')}) AS t FROM src)), f{n} AS (SELECT k, substr(t, i, {n}) AS g, count(*)::DOUBLE AS f FROM t{n} GROUP BY ALL),
a{n} AS (SELECT k, sum(f) AS n, count(*)::DOUBLE AS v FROM f{n} GROUP BY k), g{n} AS (SELECT k, any_value(v / n) AS char_{n}gram_ttr, -sum(f / n * log2(f / n)) AS char_{n}gram_entropy, any_value(n / v) AS char_{n}gram_avg_freq FROM f{n} JOIN a{n} USING (k) GROUP BY k)"""  # noqa: E731
    found = [f"coalesce({f}, 0)::DOUBLE AS {f}" for f in stylometry.FEATURES]
    per = lambda x, y: f"(CASE WHEN {y} > 0 THEN ({x}) / {y} ELSE 0 END)"
    return f"""WITH src AS (SELECT k, coalesce(text, '') AS text FROM ({source})),
w AS (SELECT k, text, regexp_extract_all(lower(text), '{_W}') AS ws, regexp_extract_all(lower(text), '{_K}') AS ts, regexp_extract_all(text, '{_S}') AS ss FROM src),
basic AS (SELECT k, len(ws) AS word_count, len(ss) AS sentence_count, {per('len(ws)', 'len(ss)')} AS avg_sentence_length, {per('list_sum([length(x) FOR x IN ws])', 'len(ws)')} AS avg_word_length, {per(_hits('ws', stylometry.CONTRACTIONS), 'len(ws)')} AS contraction_ratio,
 {per("len(regexp_extract_all(text, '!'))", 'len(ss)')} AS exclamation_ratio, {per("len(regexp_extract_all(text, '[?]'))", 'len(ss)')} AS question_ratio, {per(_hits('ws', stylometry.INFORMAL), 'len(ws)')} AS informal_ratio,
 {per(_hits('ts', stylometry.FUNCTION_WORDS), 'len(ts)')} AS function_word_ratio, {per(_hits('ts', stylometry.PREPOSITIONS), 'len(ts)')} AS preposition_ratio, {per(_hits('ts', stylometry.CONJUNCTIONS), 'len(ts)')} AS conjunction_ratio,
 {per('len(ts)', 'len(ss)')} AS avg_words_per_sentence, {per(f"len([x FOR x IN ss IF contains(x, ',') AND len({sql_words('x')}) > 15])", 'len(ss)')} AS complexity_ratio FROM w),
u AS (SELECT k, unnest([x FOR x IN ws IF x NOT IN {C._sql_list(L.ENGLISH_STOPWORDS)}]) AS x FROM w), uf AS (SELECT k, x, count(*)::DOUBLE AS f FROM u GROUP BY ALL),
ua AS (SELECT k, sum(f) AS n, count(*)::DOUBLE AS v, count(*) FILTER (f = 1)::DOUBLE AS one, count(*) FILTER (f = 2)::DOUBLE AS two, sum(f * f) AS sq, sum(f * (f - 1)) AS fall FROM uf GROUP BY k),
lexical AS (SELECT k, v / n AS type_token_ratio, one / n AS hapax_legomena_ratio, two / n AS dis_legomena_ratio, 10000 * sq / (n * n) AS yule_k, CASE WHEN n > 1 THEN fall / (n * (n - 1)) ELSE 0 END AS simpson_d, pow(n, pow(v, -0.172)) AS brunet_w,
 CASE WHEN one > 0 AND one < v THEN 100 * ln(n) / (1 - one / v) ELSE 0 END AS honore_statistic FROM ua),{grams(3)},{grams(4)},
features AS (SELECT k, {', '.join(found)} FROM basic LEFT JOIN lexical USING (k) LEFT JOIN g3 USING (k) LEFT JOIN g4 USING (k))
"""


def _turn_pairs(spark, d):
    rows = _table(spark, d, "conversations")
    you = rows.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return rows.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("said")).join(you, ["conv_id", "turn"])


_PAIRED = "SELECT u.conv_id, u.turn, u.text AS said, a.text AS answer FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'"
_terms = lambda c: f"[x FOR x IN regexp_extract_all(lower(coalesce({c}, '')), '[\\p{{L}}\\p{{N}}_]{{2,}}') IF x NOT IN {C._sql_list(L.ENGLISH_STOPWORDS)}]"
_COSINE = f"""
WITH p AS ({_PAIRED}), w AS (SELECT conv_id, turn, {_terms('said')} AS a, {_terms('answer')} AS b FROM p),
t AS (SELECT conv_id, turn, unnest(a || [a[i] || ' ' || a[i + 1] FOR i IN range(1, len(a))]) AS term, 1 AS x, 0 AS y FROM w UNION ALL SELECT conv_id, turn, unnest(b || [b[i] || ' ' || b[i + 1] FOR i IN range(1, len(b))]), 0, 1 FROM w),
c AS (SELECT conv_id, turn, term, sum(x) AS x, sum(y) AS y FROM t GROUP BY ALL), i AS (SELECT *, ln(3.0 / (1 + (x > 0)::INT + (y > 0)::INT)) + 1 AS idf FROM c),
s AS (SELECT conv_id, turn, sum(x * y * idf * idf) AS ab, sum(x * x * idf * idf) AS aa, sum(y * y * idf * idf) AS bb FROM i GROUP BY ALL)
SELECT conv_id, turn, {_R('CASE WHEN aa > 0 AND bb > 0 THEN ab / sqrt(aa * bb) ELSE 0 END')} AS cosine FROM p LEFT JOIN s USING (conv_id, turn)"""


@query(_COSINE)
def tfidf_cosine(spark, d):
    return stylometry.tfidf_cosine(_turn_pairs(spark, d), ["conv_id", "turn"], "said", "answer").select("conv_id", "turn", F.round("cosine", 6).alias("cosine"))


_SIDES = f"SELECT {{{{'c': conv_id, 't': turn, 's': side}}}} AS k, text FROM (SELECT conv_id, turn, unnest([1, -1]) AS side, unnest([said, answer]) AS text FROM ({_PAIRED}))".replace("{{", "{").replace("}}", "}")
_DELTAS = _features_sql(_SIDES) + f", delta AS (SELECT k.c AS conv_id, k.t AS turn, {' + '.join(f'abs(sum(k.s * {f}))' for f in stylometry.FEATURES)} AS delta FROM features GROUP BY ALL)"


@query(_DELTAS + "SELECT conv_id, turn, round(delta, 4) AS delta FROM delta")
def burrows_delta(spark, d):
    return stylometry.burrows_delta(_turn_pairs(spark, d), ["conv_id", "turn"], "said", "answer").withColumn("delta", F.round("delta", 4))


@query(_DELTAS + f", cos AS ({_COSINE}) SELECT 'reply' AS variant, round(avg(cosine), 4) AS cosine_mean, round(stddev_pop(cosine), 4) AS cosine_std, round(avg(delta), 3) AS delta_mean, round(stddev_pop(delta), 3) AS delta_std FROM cos JOIN delta USING (conv_id, turn)")
def similarity_summary(spark, d):
    pairs = _turn_pairs(spark, d)
    both = stylometry.tfidf_cosine(pairs, ["conv_id", "turn"], "said", "answer").join(stylometry.burrows_delta(pairs, ["conv_id", "turn"], "said", "answer"), ["conv_id", "turn"])
    digits = {"cosine_mean": 4, "cosine_std": 4, "delta_mean": 3, "delta_std": 3}
    return stylometry.similarity_summary(both.withColumn("variant", F.lit("reply")), "variant").withColumns({c: F.round(c, n) for c, n in digits.items()})


@query(_features_sql("SELECT doc_id AS k, text FROM documents") + f"SELECT k AS doc_id, {', '.join(f'round({f}, 5) AS {f}' for f in stylometry.FEATURES)} FROM features")
def style_features(spark, d):
    # as the SQL's engine rounds: the scaled double to a whole number (F.round goes by the decimal digits, and ties differ)
    return stylometry.all_features(_docs(spark, d)).select("doc_id", *[(F.round(F.col(f) * 1e5, 0) / 1e5).alias(f) for f in stylometry.FEATURES])


@query()
def authorship_auc(spark, d):
    rows = _table(spark, d, "conversations")
    return stylometry.authorship_auc(rows.where("role = 'assistant'").select("text"), rows.where("role = 'user'").select("text"))


# ---- ratings ---------------------------------------------------------------------------------------------------------------


def _ratings(spark, d):
    return views.ratings(_docs(spark, d), _table(spark, d, "labels"))


OWNER = "owner"


@query(views.RATINGS_SQL + "SELECT key, avg(ok) AS accuracy, sum(ok)::BIGINT AS correct, count(*) AS total, 1 - avg(ok) AS deception_rate FROM (SELECT *, (CASE WHEN key = 'Human' THEN guess = 'owner' ELSE guess = 'AI' END)::INT AS ok FROM r) GROUP BY key")
def accuracy_by_type(spark, d):
    return ratings.accuracy_by_type(_ratings(spark, d), OWNER)


@query(views.RATINGS_SQL + "SELECT key, guess, count(*) / sum(count(*)) OVER (PARTITION BY key) AS share FROM r GROUP BY key, guess")
def confusion_matrix(spark, d):
    return ratings.confusion_matrix(_ratings(spark, d))


@query(views.RATINGS_SQL + "SELECT key, avg((CASE WHEN key = 'Human' THEN guess = 'AI' ELSE guess = 'owner' END)::INT) AS deception_rate FROM r GROUP BY key")
def deception_rates(spark, d):
    return ratings.deception_rates(_ratings(spark, d), OWNER)


@query(views.RATINGS_SQL + "SELECT avg(((key IN ('Base', 'LoRA')) = (guess IN ('Base', 'LoRA')))::INT) AS ai_detection_accuracy FROM r")
def detection_accuracy(spark, d):
    return ratings.detection_accuracy(_ratings(spark, d))


@query(views.RATINGS_SQL + "SELECT key, avg(confidence_1to5) AS mean_confidence, stddev_samp(confidence_1to5) AS std_confidence, median(confidence_1to5) AS median_confidence FROM r GROUP BY key")
def confidence_stats(spark, d):
    return ratings.confidence_by_type(_ratings(spark, d))


@query(views.RATINGS_SQL + "SELECT key, guess, count(*) AS n FROM r WHERE guess <> key GROUP BY ALL")
def misidentification(spark, d):
    return ratings.misidentification(_ratings(spark, d))


@query(views.RATINGS_SQL + """, q AS (SELECT avg((guess = 'owner')::INT) FILTER (key = 'LoRA') AS l, avg((guess = 'owner')::INT) FILTER (key = 'Base') AS b, avg((guess = 'owner')::INT) FILTER (key = 'Human') AS h FROM r)
SELECT l AS lora_deception_rate, b AS base_deception_rate, h AS human_human_rate, l - b AS lora_advantage, CASE WHEN h - b > 0 THEN (l - b) / (h - b) ELSE 0 END AS relative_human_likeness,
 CASE WHEN h > 0 THEN l / h ELSE 0 END AS human_likeness_ratio, CASE WHEN 1 - b > 0 THEN (l - b) / (1 - b) ELSE 0 END AS deception_efficiency FROM q""")
def lora_vs_base(spark, d):
    return ratings.lora_vs_base(_ratings(spark, d), OWNER)


@query(views.RATINGS_SQL + "SELECT key, avg(length(answer)) AS mean_length, stddev_samp(length(answer)) AS std_length, count(answer) AS n FROM r GROUP BY key")
def answer_lengths(spark, d):
    return ratings.answer_lengths(_ratings(spark, d))


@query(views.RATINGS_SQL + "SELECT round(corr(confidence_1to5, (CASE WHEN key = 'Human' THEN guess = 'owner' ELSE guess = 'AI' END)::INT), 6) AS confidence_accuracy_correlation FROM r")
def correlation(spark, d):
    return ratings.confidence_correlation(_ratings(spark, d), OWNER).select(F.round("confidence_accuracy_correlation", 6).alias("confidence_accuracy_correlation"))


@query(views.RATINGS_SQL + "SELECT prompt_id, avg((guess = key)::INT) AS difficulty_score, avg(confidence_1to5) AS avg_confidence FROM r GROUP BY prompt_id")
def prompt_difficulty(spark, d):
    return ratings.prompt_difficulty(_ratings(spark, d))


@query(views.RATINGS_SQL + "SELECT rater_id, avg((guess = key)::INT) AS accuracy, avg(confidence_1to5) AS avg_confidence FROM r GROUP BY rater_id")
def rater_consistency(spark, d):
    return ratings.rater_consistency(_ratings(spark, d))


@query(views.RATINGS_SQL + "SELECT key, count(*) / sum(count(*)) OVER () AS share FROM r GROUP BY key")
def distribution(spark, d):
    return ratings.distribution(_ratings(spark, d))


@query(views.RATINGS_SQL + "SELECT count(*) AS responses, count(DISTINCT prompt_id) AS prompts, count(DISTINCT rater_id) AS raters, count(*) FILTER (key = 'Human') AS n_human, count(*) FILTER (key = 'Base') AS n_base, count(*) FILTER (key = 'LoRA') AS n_lora FROM r")
def rating_totals(spark, d):
    return ratings.totals(_ratings(spark, d))


_SHARE = "avg((guess = 'owner')::INT) FILTER (key = '{}')"


@query(views.RATINGS_SQL + f""", q AS (SELECT {_SHARE.format('LoRA')} AS l, {_SHARE.format('Base')} AS b, {_SHARE.format('Human')} AS h FROM r)
SELECT printf('tuned model taken for the owner: %.1f%%', l * 100) || chr(10) || printf('base model taken for the owner: %.1f%%', b * 100) || chr(10) || printf('owner recognised: %.1f%%', h * 100) || chr(10)
 || CASE WHEN l - b > 0.1 THEN 'strong' WHEN l - b > 0 THEN 'some' ELSE 'no' END || ' advantage of the tuned model' AS report FROM q""")
def rating_report(spark, d):
    return ratings.report(_ratings(spark, d), OWNER)


@query(r"""
WITH t AS (SELECT unnest([{'variant': 'said', 'text': said}, {'variant': 'answer', 'text': answer}]) AS x FROM (""" + _PAIRED + r""")), v AS (SELECT x.variant AS variant, x.text AS text, NOT coalesce(starts_with(x.text, 'ERROR'), true) AS ok FROM t),
w AS (SELECT *, CASE WHEN ok THEN len(regexp_extract_all(text, '[^\t-\r ]+')) END AS words FROM v)
SELECT variant, count(*) AS n, count(*) FILTER (ok) AS n_ok, avg(ok::INT) AS rate, round(avg(words), 6) AS mean_words, round(stddev_pop(words), 6) AS std_words FROM w GROUP BY variant""")
def generation_stats(spark, d):
    return ratings.generation_stats(_turn_pairs(spark, d), ["said", "answer"]).withColumns({c: F.round(c, 6) for c in ("mean_words", "std_words")})


# ---- events: JSON, cross tables, order -----------------------------------------------------------------------------------------


@query("SELECT event_type, count(*) AS n, count(props) AS with_props, count(json_extract_string(props, '$.' || json_keys(props)[1])) AS with_first FROM events GROUP BY event_type")
def json_props(spark, d):
    first = F.get_json_object("props", "$")
    keys = F.json_object_keys("props")
    value = F.get(F.map_values(F.from_json("props", "map<string,string>")), F.lit(0))
    return _table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(keys.isNotNull(), first)).alias("with_props"), F.count(value).alias("with_first"))


@query("SELECT doc_id, rank FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS rank FROM documents)")
def seeded_rank(spark, d):
    return with_rank(_docs(spark, d).select("doc_id"), hash_key(F.col("doc_id"), seed=7), ["doc_id"]).select("doc_id", F.col("rank"))


@query("SELECT source, lang, count(*) AS n FROM documents GROUP BY CUBE (source, lang)")
def source_lang_cube(spark, d):
    return _docs(spark, d).cube("source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT doc_id, length({sql_stripped('text')})::BIGINT AS n_stripped, len({sql_words('text')})::BIGINT AS n_words, {sql_matches('text', 'license', 'i')} AS licensed FROM documents")
def text_measures(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", F.length(stripped(t)).cast("long").alias("n_stripped"), word_total(t).alias("n_words"), F.contains(F.replace(F.lower(t), F.lit("ſ"), F.lit("s")), F.lit("license")).alias("licensed"))
