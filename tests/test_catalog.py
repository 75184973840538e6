"""Registered queries over small tables of their own, where SQL can't follow."""

import html
import re

import pytest

from lettermill.plans import catalog


def test_html_to_text_full_decodes_every_entity(spark, tmp_path):
    pages = [(1, "<p>&copy; 2020 &middot; a &lt;b&gt;<br>&eacute;&#233;&#xe9; &amp;copy; &amp x</p>"), (2, "&notanentity; plain"), (3, ""), (4, None)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: r["body"] for r in catalog.QUERIES["html_to_text_full"](spark, str(tmp_path)).collect()}
    plain = lambda t: html.unescape(re.sub("<[^>]+>", "", re.sub(r"<\s*(br|/p)\s*>", "\n", t, flags=re.I)))
    assert got == {k: t if t is None else plain(t) for k, t in pages} and got[1] == "© 2020 · a <b>\nééé &copy; & x\n"


def test_mojibake_repair_reads_the_whole_text(spark, tmp_path):
    broken = "été – “oui” 😀".encode().decode("latin1")
    said = [(1, 0, "user", broken), (1, 1, "assistant", "plain\\u10D0 words"), (1, 2, "user", "été à midi"), (1, 3, "user", ""), (1, 4, "user", None)]
    spark.createDataFrame(said, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    rows = sorted(catalog.QUERIES["mojibake_repair"](spark, str(tmp_path)).collect(), key=lambda r: r["turn"])
    assert [r["fixed"] for r in rows] == ["été – “oui” 😀", "plain\\u10D0 words", "été à midi", "", None]
    assert [r["unescaped"] for r in rows] == [broken, "plainა words", "été à midi", "", None]
    assert [r["fixed_garbled"] for r in rows] == [None if t is None else t + " “quoted” – text 😀 " for *_, t in said]
    assert [r["unescaped_sample"] for r in rows[1:]] == ["plainა words ა", "été à midi ა".encode().decode("latin1").replace("á\x83\x90", "ა"), " ა", None]


def test_content_types_reads_every_text(spark, tmp_path):
    said = ["voice message", "> yes, at noon", "ok", "see you there", None]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(said)], "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    rows = sorted(catalog.QUERIES["content_types"](spark, str(tmp_path)).collect(), key=lambda r: r["turn"])
    assert [(r["content_type"], r["reply_hint"]) for r in rows] == [("voice", False), ("text", True), ("text", False), ("text", False), ("other", False)]
    assert [r["marked_type"] for r in rows] == ["voice", "photo", "photo", "photo", "other"] and [r["linked_type"] for r in rows] == ["voice", "text", "link", "text", "other"]
    assert [r["quoted_hint"] for r in rows] == [True] * 4 + [False]


def test_style_features_round_as_their_sql(spark, tmp_path):
    """A mean that ends in a 5 at the sixth digit: 1527 letters in 320 words, which as a double times 100000 lies below the half."""
    import duckdb

    texts = [" ".join(["abcde"] * 247 + ["abcd"] * 73), " ".join(["abcdefg"] + ["abc"] * 31), "one, two. three!", ""]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    found = con.execute(catalog.ORACLE["style_features"])
    names = [c[0] for c in found.description]
    want = {r[0]: dict(zip(names, r, strict=True)) for r in found.fetchall()}
    got = {r["doc_id"]: r.asDict() for r in catalog.QUERIES["style_features"](spark, str(tmp_path)).collect()}
    assert got[0]["avg_word_length"] == 4.77187 and {k: {c: round(v, 9) for c, v in r.items()} for k, r in got.items()} == {k: {c: round(v, 9) for c, v in r.items()} for k, r in want.items()}


#: Runs that share a character with the next one, or whose sign follows such a character.
RUNS = (
    "call 0123456789 +49 170 1234567 now", "0123456789, +4917012345678, 0123456789,0123456789", "1234567890+123 4567890123/123 4567890123", "x+1234567890 y1234567890 (555) 123-4567",
    "a@b.co1x@y.org, a.b@c.d.ef.@g.hi a@b x@y.zz@q.rr", "AB-12,CD-34,EF-56 xAB-12 GHIJKL-77 ab-12", "see http://x.y,www.a.b www.c.d(www.e.f) é1234567890é ١٢٣٤٥٦٧٨٩٠١", "", None,
    "[+1 (555) 123-4567] +1 (555) 123-4567\n+1 (555) 123-4567 ", "1234567 +1234567,1234567;1234567  ", "1.2.3.4.5.6.7.8.9.0.1.2.3.4.5.6.7.8.9.0.1.2.3 12-34-56-78\n",
)


@pytest.mark.parametrize("name", ["pii_redact_mail", "pii_redact_social"])
def test_redaction_as_its_sql(spark, tmp_path, name):
    import duckdb

    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(RUNS)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert sorted(map(tuple, catalog.QUERIES[name](spark, str(tmp_path)).collect())) == sorted(con.execute(catalog.ORACLE[name]).fetchall())
