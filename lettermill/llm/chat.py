"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole, encoded once with offsets, and the sorted spans of its assistant turns are
intersected with the tokens' spans by binary search. Control strings in texts are escaped, so the rendering can be read
back without loss.

Template, a turn: "### " role ":" newline text newline "</turn>" newline. In roles and texts a backslash stands before every
backslash, "#" and "<" (in roles before ":" too), so no unescaped "###" or "</turn>" comes from a text. White space at a
text's ends is written as its code point (backslash, u, hex digits, semicolon): a tokenizer that begins a new piece where
white space meets other characters then never joins a text's ends to the template, and the mask is exact.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .tokens import tokenizer, vocabulary

VOCABULARY = "byte_bpe_50k.json"
ASSISTANT = "assistant"
#: Conversations encoded together.
TOGETHER = 256
_IN_TEXT, _IN_ROLE, _ESCAPED = re.compile(r"[\\#<]"), re.compile(r"[\\#<:]"), re.compile(r"\\(?:u([0-9a-f]+);|(.))", re.S)
_SPACE = "\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ENDS = re.compile(rf"\A[{_SPACE}]|[{_SPACE}]\Z")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n((?:[^\\<]|\\.)*)\n</turn>\n", re.S)


def escaped(text: str, role: bool = False) -> str:
    plain = (_IN_ROLE if role else _IN_TEXT).sub(lambda m: "\\" + m[0], text)
    return _ENDS.sub(lambda m: f"\\u{ord(m[0]):x};", plain)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)) if m[1] else m[2], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The formatted conversation, and (start, end) of each assistant text in it."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head, body = f"### {escaped(role, True)}:\n", escaped(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        out.append(f"{head}{body}\n</turn>\n")
        at += len(out[-1])
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def read_back(formatted: str) -> list[tuple[str, str]]:
    turns, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"not in the template at character {at}")
    return turns


def loss_mask(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens lie in a span. A span that isn't covered by whole tokens from end to end is an error: the tokenizer joins
    texts to the template, and no mask would be right."""
    mask = np.zeros(len(offsets), bool)
    begins, ends = offsets[:, 0], offsets[:, 1]
    for a, b in spans[spans[:, 0] < spans[:, 1]]:
        first, last = np.searchsorted(begins, a, "left"), np.searchsorted(ends, b, "right")
        if first >= last or begins[first] != a or ends[last - 1] != b or (begins[first + 1 : last] > ends[first : last - 1]).any():
            raise ValueError(f"tokens don't end where the text at characters {a} to {b} does")
        mask[first:last] = True
    return mask


def covered(offsets: np.ndarray, mask: np.ndarray) -> list[tuple[int, int]]:
    """The stretches of text under the mask: each token's whole span, those that touch or share a code point joined."""
    out = []
    for a, b in offsets[mask]:
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], int(b))
        else:
            out.append([int(a), int(b)])
    return [(a, b) for a, b in out]


def formatted(conversations: DataFrame, path: str | None = None, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """One row per conversation: conv_id, formatted, ids, mask (loss per token), loss_starts, loss_ends (code points of
    formatted under the masked tokens, whole tokens). Special tokens' strings in a text are ordinary text.

    Rows go by turn; a null turn comes first, rows of one turn by role and text. Null roles and texts are empty. A null
    conv_id is a conversation. Empty tables give empty results; other columns are ignored. A conversation's turns meet in
    one row: memory is bounded by the longest conversation.
    """
    path = path or vocabulary(VOCABULARY)
    turns = conversations.select(
        F.col(conv_col).cast("long").cast("string").alias("conv_id"), F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).alias("t")
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    whole = whole.select("conv_id", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))

    def encode(frames):
        encoder = tokenizer(path, plain=True)
        for frame in frames:
            for i in range(0, len(frame), TOGETHER):
                part = frame.iloc[i : i + TOGETHER]
                drawn = [render(list(zip(r, t, strict=True))) for r, t in zip(part["roles"], part["texts"], strict=True)]
                rows = []
                for conv, (text, spans), e in zip(part["conv_id"].tolist(), drawn, encoder.encode_batch([d[0] for d in drawn], add_special_tokens=False), strict=True):
                    offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
                    mask = loss_mask(offsets, spans)
                    parts = covered(offsets, mask)
                    rows.append((conv, text, e.ids, mask.tolist(), [p[0] for p in parts], [p[1] for p in parts]))
                yield pd.DataFrame(rows, columns=["conv_id", "formatted", "ids", "mask", "loss_starts", "loss_ends"])

    return whole.mapInPandas(encode, "conv_id string, formatted string, ids array<int>, mask array<boolean>, loss_starts array<long>, loss_ends array<long>").withColumn("conv_id", F.col("conv_id").cast("long"))


def digests(rows: DataFrame) -> DataFrame:
    """What is read back from formatted(), one row for each of its rows: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. A conversation without an assistant text has the empty text's digest; a null conv_id stays;
    an empty table gives an empty result. A text that isn't in the template is an error."""

    def read(frames):
        for frame in frames:
            out = []
            for conv, text, starts, ends in zip(frame["conv_id"].tolist(), frame["formatted"], frame["loss_starts"], frame["loss_ends"], strict=True):
                turns = read_back(text)
                under = unescaped("".join(text[a:b] for a, b in zip(starts, ends, strict=True)))
                sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(under), sha(under), len(text)))
            yield pd.DataFrame(out, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rows.drop("ids", "mask").withColumn("conv_id", F.col("conv_id").cast("string")).mapInPandas(read, "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long").withColumn("conv_id", F.col("conv_id").cast("long"))


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    probe = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.explode(F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for i, r in enumerate(("user", "assistant"))])).alias("t"))
    return digests(formatted(rows.unionByName(probe.select("conv_id", F.col("t.turn").cast("long").alias("turn"), "t.role", "t.text"))))
