"""Language buckets, content types and flags of messages."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import lexicons as L
from .regexlib import WORD_CLASS, Rule, count, has_word, matches, sql_count, sql_matches, sql_stripped, sql_text, sql_words, stripped, words
from .text import URL

_GROUP_WORDS = tuple(rf"\b(?:{'|'.join(g)})\b" for g in L.ENGLISH_GROUPS)
_VOWELS = tuple(rf"\b[a-z]*[aeiou]{{{n}}}[a-z]*\b" for n in (6, 7))


#: Bits of a count in a sum of words' counts, and the words that a task keeps the counts of; longer ones aren't kept.
_COUNT_BITS, _KEPT_WORDS, _KEPT_LENGTH = 40, 100_000, 40


class _WordCounts(dict):
    """What a lower-case ASCII word adds to each count of its text, side by side in one integer: a text's counts are a sum."""

    def __init__(self, english_words: Sequence[str]):
        among = lambda xs: frozenset(xs).__contains__
        open_ = lambda w: w not in L.ENGLISH_EXCEPTIONS
        clustered, ended = re.compile("|".join(L.GEORGIAN_CLUSTERS)).search, re.compile(rf"(?:{'|'.join(L.GEORGIAN_ENDINGS)})\Z").search
        hits, vowels = [re.compile(p).findall for p in _GROUP_WORDS], [re.compile(p).findall for p in _VOWELS]
        clear = among(L.CLEARLY_GEORGIAN)
        self.tests = (
            among(L.GEORGIAN_STOPWORDS), among(english_words), among(L.ENGLISH_STRUCTURE), lambda w: open_(w) and clustered(w) is not None,
            lambda w: open_(w) and w != "it" and ended(w) is not None, lambda w: clear(re.sub("[^a-z0-9_]", "", w)),
            lambda w: sum(len(f(w)) for f in hits), lambda w: sum(len(f(w)) for f in vowels) if len(w) > 5 else 0,
        )

    def __missing__(self, word: str) -> int:
        found = sum(int(test(word)) << _COUNT_BITS * i for i, test in enumerate(self.tests))
        if len(word) <= _KEPT_LENGTH:
            if len(self) >= _KEPT_WORDS:
                self.clear()
            self[word] = found
        return found

    def bucket(self, text: str) -> str:
        own = text.lower().split()
        n, total = len(own), sum(map(self.__getitem__, own))
        stop, known, structure, clustered, ended, clear, hits, vowels = [total >> _COUNT_BITS * i & (1 << _COUNT_BITS) - 1 for i in range(8)]
        if n == 1:
            return "ka_en" if stop else "en"
        if (known * 10 >= n * 6) + (hits * 10 >= n * 3) + (structure * 5 >= n) >= 2:
            return "en"
        if clustered * 10 >= n * 6 or ended >= 6 or stop >= 2 or vowels * 10 >= n:
            return "ka_en"
        if n <= 5:
            return "en" if known * 2 >= n else "ka_en" if stop else "unknown"
        return "ka_en" if stop or clear else "en"


def language_bucket(text: Column, english_words: Sequence[str] = tuple(L.ENGLISH_WORDS)) -> Column:
    """ka (Georgian letters), ka_en (Georgian in Latin letters), en or unknown: the first rule that fires decides.

    The words of a text are cut at white space and keep their punctuation. english_words: the dictionary of the English
    test. Null, empty and one-character texts are unknown. Words are looked at in Python, each distinct one once; it gets
    only the texts that their words decide.
    """

    @F.pandas_udf(StringType())
    def by_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counts = _WordCounts(english_words)
        for texts in batches:
            yield texts.map(counts.bucket, na_action="ignore")

    plain = stripped(text)
    decided = F.when(plain.isNull() | (F.length(plain) < 2), "unknown").when(plain.rlike(r"[\x{10A0}-\x{10FF}]"), "ka").when(~plain.rlike(r"^\p{ASCII}*\z"), "unknown")
    return F.coalesce(decided, by_words(F.when(decided.isNull(), text)))


def _sql_list(xs) -> str:
    return "(" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + ")"


def sql_language_bucket(source: str, key: str, text: str, english_words: Sequence[str] = tuple(L.ENGLISH_WORDS)) -> str:
    """A SELECT of key and lang over the relation source."""
    among = lambda xs: f"len([w FOR w IN ws IF w IN {_sql_list(xs)}])"
    open_ = f"[w FOR w IN ws IF w NOT IN {_sql_list(L.ENGLISH_EXCEPTIONS)}]"
    return f"""
SELECT {key}, CASE WHEN plain IS NULL OR length(plain) < 2 THEN 'unknown' WHEN regexp_matches(plain, '[\\x{{10A0}}-\\x{{10FF}}]') THEN 'ka'
  WHEN NOT regexp_full_match(plain, '[\\x{{00}}-\\x{{7F}}]*', 's') THEN 'unknown' WHEN n = 1 THEN CASE WHEN stop > 0 THEN 'ka_en' ELSE 'en' END
  WHEN (known / n >= 0.6)::INT + (hits >= n * 0.3)::INT + (structure / n >= 0.2)::INT >= 2 THEN 'en'
  WHEN clustered / n >= 0.6 OR ended >= 6 OR stop >= 2 OR vowels >= n * 0.1 THEN 'ka_en'
  WHEN n <= 5 THEN CASE WHEN known / n >= 0.5 THEN 'en' WHEN stop > 0 THEN 'ka_en' ELSE 'unknown' END
  WHEN stop > 0 OR clear THEN 'ka_en' ELSE 'en' END AS lang
FROM (SELECT *, len(ws) AS n, {among(L.GEORGIAN_STOPWORDS)} AS stop, {among(english_words)} AS known, {among(L.ENGLISH_STRUCTURE)} AS structure,
    len([w FOR w IN {open_} IF regexp_matches(w, '{'|'.join(L.GEORGIAN_CLUSTERS)}')]) AS clustered,
    len([w FOR w IN {open_} IF w <> 'it' AND regexp_matches(w, '(?:{'|'.join(L.GEORGIAN_ENDINGS)})$')]) AS ended,
    len([w FOR w IN ws IF regexp_replace(w, '[^{WORD_CLASS}]', '', 'g') IN {_sql_list(L.CLEARLY_GEORGIAN)}]) > 0 AS clear,
    {' + '.join(sql_count('low', p) for p in _GROUP_WORDS)} AS hits, {' + '.join(sql_count('low', p) for p in _VOWELS)} AS vowels
  FROM (SELECT {key}, plain, lower(plain) AS low, {sql_words('lower(plain)')} AS ws FROM (SELECT {key}, {sql_stripped(text)} AS plain FROM {source})))"""


def georgian_first(text: Column, least: int = 30, detector=None) -> Column:
    """ka for a text with Georgian letters, unknown for one under least characters, else what detector (Column -> Column,
    for instance an Arrow UDF) says; unknown without one."""
    found = detector(text) if detector else F.lit("unknown")
    return F.when(text.rlike(r"[\x{10A0}-\x{10FF}]"), "ka").when(text.isNull() | (F.length(stripped(text)) < least), "unknown").otherwise(found)


def detected(text: Column, least: int = 20, detector=None) -> Column:
    """unknown under least characters or without a detector."""
    return F.when(F.length(text) >= least, detector(text) if detector else F.lit("unknown")).otherwise("unknown")


# Verbs and auxiliaries that make a short message more than an acknowledgement.
VERB_HINTS = (
    "am|is|are|was|were|do|does|did|have|has|had|can|could|will|would|should|need|want|think|know|call|text|send|come|go|meet|check|see|got|pay|try|fix|"
    "ship|arrive|look"
)


def is_ack(text: Column) -> Column:
    """A short text without any of the verbs."""
    return F.coalesce((F.length(text) > 0) & (F.length(text) < 60) & ~matches(text, has_word(VERB_HINTS), "i"), F.lit(False))


def sql_is_ack(expr: str) -> str:
    return f"coalesce(length({expr}) > 0 AND length({expr}) < 60 AND NOT {sql_matches(expr, has_word(VERB_HINTS), 'i')}, false)"


# Signs of forwarded messages, receipts and placeholders.
FORWARDED = r"^[-\s>]*forwarded message"
HEADER = r"^(?:from|to|subject|date):"
RECEIPT = (
    r"order (?:no\.?|number)|receipt|invoice|total|subtotal|customer number|delivery method|unsubscribe|no-?reply|verification code|otp"
)
PLACEHOLDER = r"image omitted|video omitted|audio omitted|sticker omitted|gif omitted|\[link\]"


def noise_flags(text: Column) -> dict[str, Column]:
    """forwarded, receipt, media, noise: why a text is no conversation."""
    plain = stripped(text)
    forwarded = matches(plain, FORWARDED, "im") | matches(plain, HEADER, "im")
    digits, n = count(plain, r"\d"), F.length(plain)
    cue = matches(plain, has_word(RECEIPT), "i")
    receipt = F.when(cue, (n >= 300) | ((n >= 180) & (digits > n * 0.35))).otherwise(((n >= 300) & (digits > n * 0.45)) | (F.regexp_count(plain, F.lit("----")) >= 3) | (F.regexp_count(plain, F.lit("::")) >= 4))
    return {"forwarded": F.coalesce(forwarded, F.lit(False)), "receipt": F.coalesce(receipt, F.lit(False)), "media": mostly_media(text), "noise": F.coalesce((n < 2) | forwarded | receipt, F.lit(True))}


def sql_noise_flags(expr: str) -> dict[str, str]:
    p = sql_stripped(expr)
    n, digits = f"length({p})", sql_count(p, r"\d")
    forwarded = f"({sql_matches(p, FORWARDED, 'im')} OR {sql_matches(p, HEADER, 'im')})"
    receipt = (
        f"(CASE WHEN {sql_matches(p, has_word(RECEIPT), 'i')} THEN {n} >= 300 OR ({n} >= 180 AND {digits} / {n} > 0.35) "
        f"ELSE ({n} >= 300 AND {digits} / {n} > 0.45) OR {sql_count(p, '----')} >= 3 OR {sql_count(p, '::')} >= 4 END)"
    )
    return {"forwarded": f"coalesce({forwarded}, false)", "receipt": f"coalesce({receipt}, false)", "noise": f"coalesce({n} < 2 OR {forwarded} OR {receipt}, true)"}


def mostly_media(text: Column, phrases: bool = False) -> Column:
    """Over 95 % of the words are placeholders. Words are tested one by one, so the two-word placeholders count only with
    phrases=True, which joins them first."""
    out = F.regexp_replace(F.regexp_replace(text, r"\[\d{1,2}/\d{1,2}/\d{2,4},.*?\]", ""), r"[A-Z][a-z]+ [A-Z][a-z]+:", "")
    if phrases:
        out = F.regexp_replace(out, r"(?i)\b(image|video|audio|sticker|gif) omitted\b", "[media]")
        own = words(out)
        media = F.size(F.filter(own, lambda w: w.isin("[media]", "[link]")))
    else:
        own = words(out)
        media = F.size(F.filter(own, lambda w: matches(w, rf"[{WORD_CLASS}]\[link\][{WORD_CLASS}]", "i")))
    return F.coalesce((F.size(own) > 0) & (media > F.size(own) * 0.95), F.lit(False))


# Media keys of the exports with the type each stands for, and the media marks of chat text.
MEDIA_KEYS = (("photos", "photo"), ("videos", "video"), ("audio_files", "audio"), ("voice_messages", "voice"), ("gifs", "sticker"), ("sticker", "sticker"), ("share", "link"))
MEDIA_MARKS = (
    ("voice", r"(?i)\b(?:voice note|voice message)\b"),
    ("photo", r"(?i)\b(?:image|photo)\b.*\bomitted\b|<\s*media\s*omitted\s*>"),
    ("video", r"(?i)\bvideo\b.*\bomitted\b"),
    ("audio", r"(?i)\baudio\b.*\bomitted\b"),
    ("sticker", r"(?i)\bsticker\b.*\bomitted\b|\bgif\b.*\bomitted\b"),
    ("other", r"(?i)\b(?:contact card|document|location|file)\b.*\bomitted\b"),
)


def chat_content_type(text: Column) -> Column:
    """Type of a chat line: the first media mark, link if little else is left, text, other."""
    plain = stripped(F.coalesce(text, F.lit("")))
    out = None
    for kind, pattern in MEDIA_MARKS:
        out = F.when(plain.rlike(pattern), kind) if out is None else out.when(plain.rlike(pattern), kind)
    url = rf"(?i)\b(?:{URL})"
    bare = stripped(F.regexp_replace(plain, url, ""))
    return out.when(plain.rlike(url) & (F.length(bare) <= 4), "link").when(F.length(plain) > 0, "text").otherwise("other")


def sql_chat_content_type(expr: str) -> str:
    plain = sql_stripped(f"coalesce({expr}, '')")
    kinds = " ".join(f"WHEN regexp_matches({plain}, {sql_text(p)}) THEN '{k}'" for k, p in MEDIA_MARKS)
    url = rf"\b(?:{URL})"
    bare = sql_stripped(Rule(url, "", "i").sql(plain))
    return f"CASE {kinds} WHEN {sql_matches(plain, url, 'i')} AND length({bare}) <= 4 THEN 'link' WHEN length({plain}) > 0 THEN 'text' ELSE 'other' END"


def sql_chat_reply_hint(expr: str) -> str:
    plain = sql_stripped(f"coalesce({expr}, '')")
    return f"(starts_with({plain}, '> ') OR starts_with({plain}, '⤷'))"


def chat_reply_hint(text: Column) -> Column:
    plain = stripped(F.coalesce(text, F.lit("")))
    return plain.startswith("> ") | plain.startswith("⤷")


# Beginnings of system lines in chat exports.
SYSTEM_STARTS = (
    "Messages and calls are end-to-end encrypted", "You created this group", "changed this group's icon", "changed the subject", "added", "removed",
    "joined using this group's invite link", "left",
)


def is_system_line(sender: Column, text: Column) -> Column:
    out = sender.isNull()
    for s in SYSTEM_STARTS:
        out = out | text.startswith(s)
    return F.coalesce(out, F.lit(True))
