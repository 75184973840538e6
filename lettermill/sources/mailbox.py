"""Mailboxes in mbox form. Files are cut at message boundaries by Spark's reader, so one large mailbox is many tasks; only
the MIME of a single message is decoded in Python."""

from __future__ import annotations

import email
import email.policy
from collections.abc import Sequence
from email.header import decode_header, make_header
from email.utils import getaddresses, parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.classify import detected
from ..functions.ids import blake2b, partner_id
from ..operators.messages import participated

_FIELDS = (
    "thread string, refs array<string>, in_reply_to string, references string, subject string, date string, raw_date string, raw_from string, `from` array<string>, to array<string>, cc array<string>, "
    "bcc array<string>, raw_id string, labels string, content_type string, body string"
)
SEPARATOR = "␟"


def _decoded(value) -> str:
    if not value:
        return ""
    try:
        return str(make_header(decode_header(str(value))))
    except (ValueError, LookupError):
        return str(value)


def _addresses(*values) -> list[str]:
    found = (a.strip().lower() for _, a in getaddresses([str(v) for v in values if v]))
    return list(dict.fromkeys(a for a in found if a))


def _payload(part) -> str:
    raw = part.get_payload(decode=True)
    if raw is None:
        return str(part.get_payload() or "")
    try:
        return raw.decode(part.get_content_charset() or "utf-8", "replace")
    except LookupError:
        return raw.decode("utf-8", "replace")


def _body(message) -> tuple[str, str]:
    """The first text part that is no attachment, plain before HTML."""
    if not message.is_multipart():
        kind = "text/html" if message.get_content_type() == "text/html" else "text/plain"
        return kind, _payload(message)
    for kind in ("text/plain", "text/html"):
        for part in message.walk():
            if part.get_content_type() == kind and "attachment" not in str(part.get("Content-Disposition") or "").lower():
                return kind, _payload(part)
    return "text/plain", ""


def _date(value) -> str | None:
    from datetime import timezone

    try:
        at = parsedate_to_datetime(str(value))
    except (ValueError, TypeError, IndexError):
        return None
    return (at if at.tzinfo else at.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).isoformat()


def _parsed(raw: bytes) -> tuple:
    import re

    m = email.message_from_bytes(raw, policy=email.policy.compat32)
    refs = [r for h in m.get_all("References") or [] for r in re.findall(r"<[^>]+>", str(h))]
    reply = m.get("In-Reply-To")
    kind, body = _body(m)
    text = lambda k: None if m.get(k) is None else str(m.get(k))
    return (
        (text("X-GM-THRID") or "").strip(), refs + [str(reply)] * bool(reply), text("In-Reply-To"), text("References"), _decoded(m.get("Subject")), _date(m.get("Date")) if m.get("Date") else None, text("Date") or "", text("From") or "",
        _addresses(m.get("From")), _addresses(m.get("To"), m.get("Delivered-To")), _addresses(m.get("Cc")), _addresses(m.get("Bcc")), (text("Message-ID") or "").strip(), text("X-Gmail-Labels") or "", kind, body,
    )


def read_messages(spark: SparkSession, paths) -> DataFrame:
    """source_file and the decoded parts of every message; what can't be decoded is left out."""
    raw = spark.read.option("lineSep", "\nFrom ").text(paths).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").cast("binary").alias("raw"))
    names = [f.split()[0].strip("`") for f in _FIELDS.split(", ")]

    def decode(frames):
        for frame in frames:
            out = []
            for source, data in zip(frame["source_file"], frame["raw"], strict=True):
                data = bytes(data)
                data = data.split(b"\n", 1)[1] if b"\n" in data else b""  # the envelope line
                if not data.strip():
                    continue
                try:
                    out.append((source, *_parsed(data)))
                except Exception:  # noqa: BLE001  a message that can't be decoded doesn't stop a mailbox
                    continue
            yield pd.DataFrame(out, columns=["source_file", *names])

    return raw.mapInPandas(decode, f"source_file string, {_FIELDS}")


def _folded(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def parse(spark: SparkSession, paths, me: Sequence[str], detector=None) -> DataFrame:
    """Canonical messages of the threads in which one of the owner's addresses wrote, mailbox by mailbox, with their places
    in threads over all mailboxes."""
    mine_list = [a.strip().lower() for a in me if a.strip()]
    rows = read_messages(spark, paths)
    plain = F.when(F.col("content_type") == "text/html", T.html_to_text(F.col("body"), full=True)).otherwise(F.col("body"))
    own = F.array_intersect("from", F.array(*[F.lit(a) for a in mine_list]))
    outbound = F.size(own) > 0
    fallback = blake2b(F.concat(F.lower(T.stripped(F.col("subject"))), F.lit(SEPARATOR), F.coalesce(F.get("refs", F.lit(0)), F.lit(""))), 10)
    made = F.concat(F.lit("<gen-"), blake2b(F.concat("subject", "raw_date", "raw_from"), 10), F.lit(">"))
    body = T.redact_mail(T.strip_mail_quotes(plain))
    account = F.when(outbound, F.element_at(own, 1))
    rows = rows.withColumns({"body_raw": T.stripped(plain), "body_text": T.stripped(body)}).where("length(body_text) > 0 or length(body_raw) > 0")
    out = rows.select(
        F.lit("gmail").alias("platform"), "source_file", F.when(F.length("thread") > 0, F.col("thread")).otherwise(fallback).alias("conversation_id"), F.when(F.length("raw_id") > 0, F.col("raw_id")).otherwise(made).alias("message_id"), "date",
        "subject", T.subject_norm(F.col("subject")).alias("subject_norm"), F.get("from", F.lit(0)).alias("from"), "to", "cc", "bcc", F.when(outbound, "outbound").otherwise("inbound").alias("direction"), F.when(outbound, "you").otherwise("partner").alias("turn_role"),
        account.alias("account"), F.lower(F.nullif(F.substring_index(account, "@", -1), account)).alias("sender_domain"), partner_id(F.when(outbound, F.concat("to", "cc", "bcc")).otherwise(F.col("from")), SEPARATOR).alias("partner_id"),
        F.col("in_reply_to").isNotNull().alias("is_reply"), F.col("in_reply_to").alias("reply_to_message_id"), "content_type", "body_raw", "body_text", detected(F.col("body_text"), detector=detector).alias("lang"), F.length("body_text").alias("char_len"),
        T.token_est(F.col("body_text")).alias("token_est"), T.has_emoji(F.col("body_text"), mail=True).alias("has_emoji"),
        F.when(F.length(T.stripped(F.col("labels"))) > 0, F.filter(F.transform(F.split("labels", ","), lambda x: F.trim(x)), lambda x: x != "")).alias("labels"), F.struct(F.col("in_reply_to").alias("In-Reply-To"), F.col("references").alias("References")).alias("headers"),
    )
    kept = participated(out, ["source_file", "conversation_id"])
    thread = Window.partitionBy("conversation_id").orderBy(_folded("date"), "message_id")
    return kept.withColumn("thread_index", F.row_number().over(thread) - 1)
