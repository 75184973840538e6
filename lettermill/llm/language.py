"""Language identification by language-bitmask n-gram filters.

Training keeps, for each language, the letter n-grams that are frequent in it, however frequent they are elsewhere.
They go into one bit-sliced Bloom filter: a slot holds a bit for every language, and the AND of an n-gram's slots names
all languages that contain it. A text's n-grams are counted for every language, the counts are corrected for the
filter's false positives, and the language with the most decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table, written
from .tokens import batches

#: The filters are fitted on at most about this many labelled documents of each language, drawn by a hash of the id.
SAMPLE_DOCS = 3000
#: An n-gram belongs to a language if it makes up this share of the language's n-grams; so a language has at most
#: 1 / MIN_SHARE n-grams, whatever the input, and the filter has a fixed size.
MIN_SHARE = 2e-5
GRAM = 3
#: Characters looked at together: a worker holds about 100 bytes for each.
CHARS = 400_000
#: Texts of a batch taken out of it together.
ROWS = 500
SLOTS, HASHES = 1 << 20, 3
UNDECIDED = "und"
_MULTIPLY = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_tables: list = []


def _letters() -> np.ndarray:
    """code point -> code point of its lower case if it is a letter, else 0."""
    if not _tables:
        lower = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if chr(c).isalpha():
                lower[c] = ord(chr(c).lower()[0])
        _tables.append(lower)
    return _tables[0]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit n-grams of all texts, and for each text where its n-grams begin; runs of other characters count as one
    space, and so do a text's ends."""
    padded = [f" {t} " for t in texts]
    codes = _letters()[np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)]
    ends = np.cumsum([len(t) for t in padded])
    text_of = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0) | (text_of[1:] != text_of[:-1])
    codes, text_of = codes[keep].astype(np.uint64), text_of[keep]
    size = max(0, len(codes) - GRAM + 1)
    key = np.zeros(size, np.uint64)
    for i in range(GRAM):
        key = (key << np.uint64(21)) | codes[i : i + size]
    own = text_of[:size] == text_of[GRAM - 1 :]
    key, text_of = key[own], text_of[:size][own]
    return key, np.searchsorted(text_of, np.arange(len(texts) + 1))


def _slots(key: np.ndarray, i: int) -> np.ndarray:
    mixed = (key ^ (key >> np.uint64(29))) * _MULTIPLY[i]
    return (mixed >> np.uint64(64 - int(np.log2(SLOTS)))).astype(np.int64)


class Filters:
    """The bit-sliced filter: SLOTS rows of one bit a language."""

    def __init__(self, languages: list[str], members: pd.DataFrame):
        """members: gram (long), language (index)."""
        self.languages = languages
        self.words = -(-max(1, len(languages)) // 64)
        kind = next(k for k, most in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 1 << 30)) if len(languages) <= most)
        self.slices = np.zeros((self.words, SLOTS), kind)
        gram, language = members["gram"].to_numpy().astype(np.uint64), members["language"].to_numpy()
        for i in range(HASHES):
            at = _slots(gram, i)
            for w in range(self.words):
                own = language // 64 == w
                np.bitwise_or.at(self.slices[w], at[own], np.left_shift(np.ones(own.sum(), np.uint64), (language[own] % 64).astype(np.uint64)).astype(kind))
        fill = np.array([np.mean((self.slices[i // 64] >> kind(i % 64)) & kind(1)) for i in range(len(languages))])
        self.false = fill**HASHES

    def counts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text; for each text and language, how many it contains, corrected for false positives."""
        key, starts = grams(texts)
        n = np.diff(starts)
        hits = np.zeros((len(texts), len(self.languages)))
        at = [_slots(key, i) for i in range(HASHES)]
        for w in range(self.words):
            found = self.slices[w][at[0]]
            for x in at[1:]:
                found &= self.slices[w][x]
            for i in range(64 * w, min(64 * (w + 1), len(self.languages))):
                total = np.concatenate([[0], np.cumsum((found >> found.dtype.type(i % 64)) & found.dtype.type(1), dtype=np.int64)])
                hits[:, i] = total[starts[1:]] - total[starts[:-1]]
        return n, np.clip((hits - n[:, None] * self.false) / (1 - np.minimum(self.false, 0.99)), 0, None)


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Filters:
    """Filters from the rows with a language and a text. The counting is distributed; what comes to the driver has at
    most 1 / MIN_SHARE rows a language. Labels are names of languages: the driver and the filter hold a row and a bit for each,
    so a column of free text is no label. Ids may be null or repeat: they only decide which rows are drawn. Without a labelled
    row nothing is learned."""
    known = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    docs = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    languages = sorted(docs)
    if not languages:
        return Filters([], pd.DataFrame({"gram": [], "language": []}))
    share = F.create_map(*[x for k, v in docs.items() for x in (F.lit(k), F.lit(min(1.0, sample_docs / v)))])
    drawn = F.pmod(F.xxhash64("id", F.lit("language")), F.lit(1 << 30)) < F.element_at(share, F.col("lang")) * (1 << 30)
    index = {k: i for i, k in enumerate(languages)}

    def count(frames):
        for frame in frames:
            for lang, own in frame.groupby("lang"):
                texts = own["text"].tolist()
                for a, b in batches(texts, CHARS):
                    gram, n = np.unique(grams(texts[a:b])[0], return_counts=True)
                    yield pd.DataFrame({"gram": gram.astype(np.int64), "language": index[lang], "n": n})

    counted = known.where(drawn).select("text", "lang").mapInPandas(count, "gram long, language int, n long").groupBy("gram", "language").agg(F.sum("n").alias("n"))
    counted = written(counted, "language-grams")
    totals = {r["language"]: r["total"] for r in counted.groupBy("language").agg(F.sum("n").alias("total")).collect()}
    total = F.create_map(*[F.lit(x) for k, v in totals.items() for x in (k, float(v))]) if totals else F.create_map()
    members = counted.where(F.col("n") / F.element_at(total, F.col("language")) >= MIN_SHARE).select("gram", "language").toPandas()
    return Filters(languages, members.sort_values(["gram", "language"]))


def identify(docs: DataFrame, filters: Filters, text_col: str = "text", min_share: float = 0.0) -> DataFrame:
    """docs with lang_pred and score, other columns kept (columns of these names are replaced).

    score is the share of the text's n-grams that the chosen language contains, 0 to 1. UNDECIDED with score 0: a null
    text, one without a letter, one whose score is below min_share, and every text if no language was learned. A tie goes
    to the first language in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    @F.arrow_udf("lang_pred string, score double")
    def predict(column: pa.Array) -> pa.Array:
        own = shared.value
        names, scores = [UNDECIDED] * len(column), [0.0] * len(column)
        for start in range(0, len(column), ROWS) if own.languages else ():  # the whole batch stays in Arrow's compact form
            texts = [t or "" for t in column.slice(start, ROWS).to_pylist()]
            for a, b in batches(texts, CHARS):
                n, hits = own.counts(texts[a:b])
                best = hits.argmax(axis=1)
                for i in range(b - a):
                    share = min(1.0, float(hits[i, best[i]]) / max(1, int(n[i])))
                    if n[i] > 0 and share >= min_share and any(map(str.isalpha, texts[a + i])):
                        names[start + a + i], scores[start + a + i] = own.languages[best[i]], share
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(F.struct(*kept).alias("doc"), predict(F.col(text_col)).alias("found")).select("doc.*", "found.lang_pred", "found.score")


def held_out(id_col: str = "doc_id"):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = fit(docs.where(~held_out()))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify(rows, filters).drop("text")
