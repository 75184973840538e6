"""Hand-derived values for the text, language and identifier functions."""

import pytest
from pyspark.sql import functions as F

from lettermill.functions import classify as C
from lettermill.functions import ids as I
from lettermill.functions import text as T


def one(spark, column_of, *values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in rows.orderBy("i").select(column_of(F.col("t"))).collect()]


def test_edit_marks(spark):
    assert one(spark, T.clean_edited, "I credited you", "a <Edited> b", None, "") == ["I cr you", "a b", None, ""]
    assert one(spark, T.clean_common, "I credited you", "hi <This message was edited> ") == ["I credited you", "hi"]


def test_mail_quotes(spark):
    assert one(spark, T.strip_mail_quotes, "hello\n-- \nBob", "ok\nOn Mon x wrote:\n> hi\nmore", "> a\n> b\n> c\nd", "") == ["hello -- Bob", "ok", "d", ""]


def test_quotes_and_signatures(spark):
    got = one(spark, T.strip_quotes_and_signatures, "Jon said he wrote: x", "see you,tomorrow\nThanks, Ana", "a &amp; b", "hello -- Bob")
    assert got == ["J x", "see you, tomorrow", "a & b", "hello"]


def test_mail_tail(spark):
    assert one(spark, T.clean_mail_tail, "see you tomorrow at noon", "see you tomorrow at noon.", "i think 5 > 3 so yes.", "fine. Sent from my iPhone") == ["see you", "see you tomorrow at noon.", "i think 5", "fine."]
    assert one(spark, lambda t: T.clean_mail_tail(t, aggressive_tail=False), "see you tomorrow at noon") == ["see you tomorrow at noon"]


def test_redaction(spark):
    got = one(spark, T.redact_social, "call 555-123-4567 now", "100000000 weli", "1234567890123456", "at 2023-01-15 ok", "mail a@b.org , see https://x.y/z", "7777777 x", "AB-12 and ab-12", None)
    assert got == ["call [PHONE] now", "100000000 weli", "1234567890123456", "at [PHONE] ok", "mail [EMAIL], see [LINK]", "7777777 x", "[ID] and ab-12", None]
    assert one(spark, T.redact_mail, "a@b.org +1 (555) 123-4567 http://x ABC-1234") == ["[EMAIL] [PHONE] [LINK] [ID]"]


def test_names(spark):
    assert one(spark, T.name_norm, "Ána  López 😀", "გიორგი K.", "💬", "Bob-Smith_2", None) == ["na_l_pez", "გიორგი_k.", "unknown", "bob_smith_2", ""]


def test_repair(spark):
    assert one(spark, T.fix_mojibake, "café", "â\u0080\u009cyesâ\u0080\u009d", None) == ["café", "“yes”", None]
    assert one(spark, lambda t: T.fix_mojibake(t, percent=True), "a%20b+c", "é") == ["a b+c", "é"]
    assert one(spark, T.fix_double_escapes, "\\u10D0 x", "plain") == ["ა x", "plain"]


def test_html(spark):
    assert one(spark, T.html_to_text, "a<br>b<br/>c</p>&lt;d&gt;") == ["a\nbc\n<d>"]
    assert one(spark, lambda t: T.html_to_text(t, full=True), "&eacute;<b>x</b>") == ["éx"]


def test_flags(spark):
    assert one(spark, T.only_emoji, "😀😀", "😀 a", "") == [True, False, False]
    assert one(spark, T.has_emoji, "a 😀", "a", None) == [True, False, False]
    assert one(spark, C.is_ack, "sure thing", "can you call", "", "é ok") == [True, False, False, True]
    assert one(spark, T.token_est, "", "abc", "abcde", "abcdefgh") == [1, 1, 1, 2]
    assert one(spark, lambda t: T.token_est(t, up=True), "", "abc", "abcde", "abcdefgh") == [1, 1, 2, 2]
    assert one(spark, C.mostly_media, "image omitted image omitted") == [False]
    assert one(spark, lambda t: C.mostly_media(t, phrases=True), "image omitted image omitted") == [True]


@pytest.mark.parametrize("text,noise", [("x", True), ("hello there", False), ("---- Forwarded message", True), ("subject: hi", True), ("your invoice " + "x" * 300, True), ("your invoice", False), ("a::b::c::d::e", True), (None, True)])
def test_noise(spark, text, noise):
    assert one(spark, lambda t: C.noise_flags(t)["noise"], text) == [noise]


def test_language_buckets(spark):
    long_ok = "we will be in the office today and you can call me there"
    texts = ["გამარჯობა", "café", "gamarjoba", "zzz", "rogor xar", long_ok, None, " a ", "shesadzlebelia iq xval vnaxot"]
    assert one(spark, C.language_bucket, *texts) == ["ka", "unknown", "ka_en", "en", "ka_en", "en", "unknown", "unknown", "unknown"]


def test_content_types(spark):
    assert one(spark, C.chat_content_type, "image omitted", "voice message", "https://a.b", "see https://a.b today", "", "GIF omitted") == ["photo", "voice", "link", "text", "other", "sticker"]


def test_identifiers(spark):
    who = F.array(F.lit("bob"), F.lit("alice"), F.lit("bob"))
    row = spark.range(1).select(
        I.conversation_id("ig-", who, F.lit(1700000000000), F.lit("inbox/alice_1")), I.conversation_id("fb-", who, F.lit(1700000000000), F.lit("inbox/alice_1"), F.lit("chunk1")),
        I.conversation_id("wa-", who, F.lit(1676317577000), F.lit("chat.txt")), I.split_bucket(F.lit("ig-a2d248588d")), I.hash_split(F.lit("ig-a2d248588d")), I.blake2b(F.lit("whatsapp::wa-1")),
        I.partner_id(F.array(F.lit("carol"), F.lit("alice"))), I.partner_id(F.array(F.lit("b@x.org"), F.lit("a@x.org")), "␟"), I.iso_from_ms(F.lit(1700000000999)),
        I.blake2b(T.dedup_text(F.lit("Hello,  WORLD!!|you")), 12),
    ).first()
    assert list(row) == ["ig-a2d248588d", "fb-91b5326e13", "wa-7bc71f494e", 95, "test", "c7152d02f04801c4", "eaf2c8e2cdea2fcd", "90c83cdb711a4222", "2023-11-14T22:13:20Z", "b967b78875bd0206aa1909ce"]


def test_dates(spark):
    got = one(spark, lambda t: I.chat_date(t).cast("string"), "2/13/23, 8:46:17 PM", "13/02/2023, 20:46", "2/13/70, 8:46 PM", "milk")
    assert got == ["2023-02-13 20:46:17", "2023-02-13 20:46:00", "1970-02-13 20:46:00", None]
    assert one(spark, lambda t: I.chat_date(t, "+02:00").cast("string"), "13/02/2023, 20:46") == ["2023-02-13 18:46:00"]
    assert one(spark, I.from_2020_on, "2020-01-01T00:00:00+04:00", "2019-12-31T23:00:00Z", "soon", None) == [True, False, False, False]


def test_messenger_repair_of_literal_escapes(spark):
    from lettermill.functions import text as T

    broken = "\\u00 " + "მადლობა".encode().decode("latin1")
    rows = spark.createDataFrame([(1, broken), (2, "\\u00 plain"), (3, "caf%C3%A9 a+b"), (4, None)], "i int, t string")
    got = {r["i"]: r["f"] for r in rows.select("i", T.fix_mojibake(F.col("t"), percent=True).alias("f")).collect()}
    assert got == {1: "\\u00 მადლობა", 2: "\\u00 plain", 3: "café a+b", 4: None}


def test_iso_dates_of_late_years(spark):
    """As the SQL's engine writes them, up to the last year that a timestamp holds."""
    rows = spark.createDataFrame([(-1,), (253402300799999,), (253402300800000,), (1600000000000 + 5999999 * 86399999,), (9000000000000000,), (None,)], "t long")
    got = [r[0] for r in rows.select(I.iso_from_ms(F.col("t"))).collect()]
    assert got == ["1969-12-31T23:59:59Z", "9999-12-31T23:59:59Z", "10000-01-01T00:00:00Z", "18448-02-21T10:46:40Z", "287168-08-24T16:00:00Z", None]


def test_language_words_are_kept_within_a_bound(monkeypatch):
    monkeypatch.setattr(C, "_KEPT_WORDS", 10)
    counts = C._WordCounts(("the", "office"))
    assert counts.bucket(" ".join(f"w{i}" for i in range(1000)) + " " + "x" * 1000) == "en" and len(counts) <= 10
    assert [counts.bucket(t) for t in ("The office", "rogor xar", "aaaaaa b c d e f g h", "it")] == ["en", "ka_en", "ka_en", "en"]


def test_each_date_form_has_a_shape_of_its_own(spark):
    import re

    samples = ["2/13/23, 8:46:17 PM", "2/13/23, 8:46 PM", "2/13/2023, 8:46:17 PM", "2/13/2023, 8:46 PM", "13/2/23, 20:46:17", "13/2/23, 20:46", "13/2/2023, 20:46:17", "13/2/2023, 20:46", "2/13/23 8:46 pm", "13/2/23 20:46"]
    assert [[bool(re.match(I._shape(f).replace(r"\z", r"\Z"), t.upper())) for f in I.CHAT_DATES] for t in samples] == [[i == j for j in range(10)] for i in range(10)]
    got = one(spark, lambda t: I.chat_date(t).cast("string"), *samples, "13/13/23, 8:46 PM", "2/13/23, 8:46PM")
    assert got == [f"2023-02-13 20:46:{17 if ':17' in t else '00'}" for t in samples] + [None, None]


def test_normal_forms_stay_on_the_jvm(spark):
    """All four forms are Python's, nulls stay, and no text is handed to Python, whose memory batches of long texts would fill."""
    import unicodedata

    from pyspark.sql import functions as F

    from lettermill.functions import text as T

    said = ["plain", "", None, "e\u0301 \u00e9", "\ufb01 \u2460 \uff21", "\u1112\u1161\u11ab \ud55c", "a\u0323\u0307 a\u0307\u0323", "\u212b \u0958 \U0001d15e \U0001f600", "e\u0301" * 5000]
    forms = ("NFC", "NFD", "NFKC", "NFKD")
    out = spark.createDataFrame(list(enumerate(said)), "i long, t string").select("i", "t", *[T.normalized(F.col("t"), f).alias(f) for f in forms])
    assert "EvalPython" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        assert [r[f] for f in forms] == [None if r["t"] is None else unicodedata.normalize(f, r["t"]) for f in forms]
