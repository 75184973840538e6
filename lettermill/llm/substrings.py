"""Removal of repeated substrings by compaction of a word de Bruijn graph.

A window of 20 words is an edge of the graph. Each window is filed under its minimizer, the least hash of its k-mers;
consecutive windows with one minimizer are a segment, and equal windows always share a minimizer. A minimizer all of whose
occurrences lie in equal segments is a nonbranching stretch: one row. Stretches are compacted into paths through joins: where
every occurrence of one is followed by the same next one, and every occurrence of that is preceded by it (out-degree and
in-degree 1), the two are joined, and pointers that double their reach give each stretch its path's head and its distance
from it. Source coordinates verify a path: the first occurrence of each of its stretches lies at that distance from its
head's. Only where paths branch, or don't agree with their coordinates, are segments opened into edges. Two independent
64-bit hashes of each word stand behind every comparison: lengths and both fingerprints of a segment have to agree.

Texts stay where they lie: minimizers are counted first, and bit filters of fixed size let the later passes send out only
what is repeated. Copies meet in sums, so a passage in a third of all documents is one row a task; its occurrences meet its
coordinates in a join that the engine splits where they are many.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, bit_filter, forgotten, passes, table, written
from .tokens import batches, hashed_words, mixed, powers

WINDOW = 20
KMER = 8
#: More than a text has words.
PLACES = 1 << 40
#: Rows sent to Python at once.
BATCH = 1000
_SEEDS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Text:
    """The words of several texts as arrays of hashes; two independent ones, of which the second verifies the first."""

    def __init__(self, texts: list[str], verify: bool = True):
        self.hashes, self.counts = hashed_words(texts, (0, 1) if verify else (0,))
        self.size = len(self.hashes[0])
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(s, self.size + 1)[0][: self.size], dtype=np.uint64)]) for h, s in zip(self.hashes, _SEEDS, strict=False)]

    def fingerprint(self, which: int, start: np.ndarray, size) -> np.ndarray:
        """64-bit hash of the words from each start."""
        total, back = self.sums[which], powers(_SEEDS[which], self.size + 1)[1]
        return mixed((total[start + size] - total[start]) * back[start] + np.uint64(1) * np.asarray(size).astype(np.uint64))

    def segments(self, window: int = WINDOW, k: int = KMER):
        """start, number of windows and minimizer of each segment; starts count over all texts."""
        n = self.size - window + 1
        if n <= 0:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        kmers = self.fingerprint(0, np.arange(self.size - k + 1), k)
        low, at = kmers[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, window - k + 1):
            less = kmers[j : j + n] < low
            low[less], at[less] = kmers[j : j + n][less], j
        at += np.arange(n)
        real = self.doc[:n] == self.doc[window - 1 : window - 1 + n]
        head = real.copy()
        head[1:] &= (at[1:] != at[:-1]) | ~real[:-1]
        first = np.flatnonzero(head)
        stop = np.flatnonzero(np.concatenate([head[1:] | ~real[1:], [True]]) & real) + 1
        return first, stop - first, low[first]


def _each(frames, columns, verify: bool = True):
    """Text and the given columns of every batch of bounded size."""
    for frame in frames:
        texts = [t or "" for t in frame["text"]]
        for a, b in batches(texts, 800_000):
            yield Text(texts[a:b], verify), *[frame[c].to_numpy()[a:b] for c in columns]


def paths(nodes: DataFrame) -> DataFrame:
    """nodes: m, windows, after and before (of all its occurrences, 0 if they differ or there is none). Result: m, head,
    distance (windows from the head's start), for every node; a node that stands in no path, or in a circle, is its own head."""
    a = nodes.select(F.col("m").alias("up"), F.col("after").alias("next"), "windows")
    b = nodes.select("m", F.col("before").alias("last"))
    joined = b.join(a, (F.col("last") == F.col("up")) & (F.col("m") == F.col("next")) & (F.col("m") != F.col("up"))).select("m", "up", "windows")
    at = written(nodes.select("m").join(joined, "m", "left").select("m", F.coalesce("up", "m").alias("head"), F.coalesce("windows", F.lit(0)).cast("long").alias("distance")), "graph-pointers")
    total = at.count()
    for _ in range(max(1, total).bit_length() + 1):
        far = at.select(F.col("m").alias("head"), F.col("head").alias("further"), F.col("distance").alias("more"))
        moved = written(at.join(far, "head").select("m", F.col("further").alias("head"), (F.col("distance") + F.col("more")).alias("distance"), (F.col("further") != F.col("head")).alias("moved")), "graph-pointers")
        forgotten(at)
        at = moved.drop("moved")
        if moved.where("moved").limit(1).count() == 0:
            return at
    # what still moves goes round in a circle
    done = at.join(at.where("m = head").select("head"), "head", "left_semi")
    return done.unionByName(at.join(done, "m", "left_anti").select(F.col("m").alias("head"), "m", F.lit(0).cast("long").alias("distance")))


def repeated_spans(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """rows: row (digest of id and text), id (not null), text. Result: row, start, size: runs of words, not merged, of every
    window whose words also start earlier (smaller id, or the same id and an earlier start)."""
    spark = rows.sparkSession

    def count(frames):
        for text in _each(frames, (), verify=False):
            m, n = np.unique(text[0].segments(window)[2], return_counts=True)
            yield pd.DataFrame({"m": m.view(np.int64), "n": n})

    often = written(rows.select("text").mapInPandas(count, "m long, n long").groupBy("m").agg(F.sum("n").alias("n")).where("n > 1").select("m"), "graph-minimizers")
    bits = spark.sparkContext.broadcast(bit_filter(often, "m"))

    def send(frames):
        for text, ids, keys in _each(frames, ("id", "row")):
            start, size, m = text.segments(window)
            own = passes(bits.value, m)
            doc = text.doc[start]
            # the minimizers of the segments after and before, 0 where there is none or it isn't repeated
            near = np.where(own, m, np.uint64(0))
            after, before = np.zeros(len(m), np.uint64), np.zeros(len(m), np.uint64)
            if len(m):
                together = doc[1:] == doc[:-1]
                after[:-1], before[1:] = np.where(together, near[1:], 0), np.where(together, near[:-1], 0)
            start, size, m, after, before, doc = start[own], size[own], m[own], after[own], before[own], doc[own]
            words = size + window - 1
            yield pd.DataFrame({
                "m": m.view(np.int64), "after": after.view(np.int64), "before": before.view(np.int64), "s": text.fingerprint(0, start, words).view(np.int64), "v": text.fingerprint(1, start, words).view(np.int64),
                "id": ids[doc], "row": keys[doc], "start": start - text.starts[doc], "size": words,
            })

    segments = written(rows.select("text", "id", "row").mapInPandas(send, "m long, after long, before long, s long, v long, id long, row long, start long, size long"), "graph-segments")
    one = lambda *names: functools.reduce(lambda x, y: x & y, [F.min(n) == F.max(n) for n in names])
    # (id, start) as one number, which sums keep in place: the least is the first occurrence
    place = F.col("id").cast("decimal(38,0)") * F.lit(PLACES).cast("decimal(38,0)") + F.col("start")
    nodes = segments.groupBy("m").agg(
        F.count(F.lit(1)).alias("n"), one("s", "v", "size").alias("path"), F.min("id").alias("first_id"), F.min(place).alias("place"), (F.min("size") - (window - 1)).alias("windows"),
        F.when(one("after"), F.min("after")).otherwise(0).alias("after"), F.when(one("before"), F.min("before")).otherwise(0).alias("before"),
    ).where("n > 1")
    nodes = written(nodes.select("m", "path", "first_id", (F.col("place") - F.col("first_id").cast("decimal(38,0)") * F.lit(PLACES).cast("decimal(38,0)")).cast("long").alias("first_start"), "windows", "after", "before"), "graph-nodes")
    heads = paths(nodes.where("path"))
    from_head = nodes.select(F.col("m").alias("head"), F.col("first_id").alias("head_id"), F.col("first_start").alias("head_start"))
    agrees = (F.col("first_id") == F.col("head_id")) & (F.col("first_start") == F.col("head_start") + F.col("distance"))
    first = written(nodes.where("path").join(heads, "m").join(from_head, "head").where(agrees).select("m", "first_id", "first_start"), "graph-paths")
    later = (F.col("id") > F.col("first_id")) | (F.col("start") > F.col("first_start"))
    spans = segments.join(first, "m").where(later).select("row", "start", "size")

    forks = spark.sparkContext.broadcast(bit_filter(nodes.join(first, "m", "left_anti").select("m"), "m"))

    def edges(frames):
        for text, ids, keys in _each(frames, ("id", "row")):
            start, size, m = text.segments(window)
            own = passes(forks.value, m)
            start, size = start[own], size[own]
            at = np.repeat(start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            doc = text.doc[at]
            yield pd.DataFrame({"s": text.fingerprint(0, at, window).view(np.int64), "v": text.fingerprint(1, at, window).view(np.int64), "id": ids[doc], "row": keys[doc], "start": at - text.starts[doc]})

    opened = written(rows.select("text", "id", "row").mapInPandas(edges, "s long, v long, id long, row long, start long"), "graph-edges")
    place = F.struct("id", "start")
    firsts = written(opened.groupBy("s", "v").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "graph-firsts")
    forked = opened.join(firsts, ["s", "v"]).where(place > F.col("first")).select("row", "start", F.lit(window).cast("long").alias("size"))
    return spans.unionByName(forked)


def _finished(frame: pd.DataFrame, with_text: bool) -> pd.DataFrame:
    rows = []
    for doc, text, spans in zip(frame["id"].tolist(), frame["text"], frame["spans"], strict=True):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        kept = words
        if spans is not None and len(spans):
            edge = np.zeros(len(words) + 1, np.int64)
            for s in spans:
                edge[s["start"]] += 1
                edge[s["start"] + s["size"]] -= 1
            kept = [w for w, covered in zip(words, np.cumsum(edge[:-1]), strict=True) if not covered]
        joined = b" ".join(kept)
        rows.append((doc, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode("utf-8", "surrogatepass") if with_text else None))
    return pd.DataFrame(rows, columns=["id", "n_words", "n_removed", "kept_sha256", "text"])


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, and text (the kept words, joined by a space).

    A word goes if a window over it has the words of a window that starts earlier: in a smaller id, or at an earlier start of
    the same id. Rows that repeat an id count as one document, each with starts of its own: of rows alike both stay. A null
    id comes after all others. Null and empty texts have no words. Empty tables give empty results; other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    rows = rows.select("doc", F.coalesce("doc", F.lit(2**63 - 1)).alias("id"), "text", F.xxhash64("doc", "text").alias("row"))
    with arrow_rows(docs.sparkSession, BATCH):
        spans = repeated_spans(rows.select("row", "id", "text"), window)
    spans = written(spans.distinct().groupBy("row").agg(F.collect_list(F.struct("start", "size")).alias("spans")), "graph-spans")
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(spans, "row"))

    @F.pandas_udf("boolean")
    def touched(key: pd.Series) -> pd.Series:
        return pd.Series(passes(bits.value, key.to_numpy().view(np.uint64)))

    marked = rows.select(F.col("doc").cast("string").alias("id"), "text", "row")
    cut = marked.where(touched("row")).join(spans, "row", "left").select("id", "text", "spans")
    schema = "id string, n_words long, n_removed long, kept_sha256 string, text string"

    def finish(frames):
        for frame in frames:
            for a, b in batches([t or "" for t in frame["text"]], 1_500_000):
                yield _finished(frame.iloc[a:b], with_text)

    def finish_whole(frames):
        # the test stands here, not in a column function: a task then has one Python worker
        for frame in frames:
            yield from finish([frame[~passes(bits.value, frame["row"].to_numpy().view(np.uint64))].assign(spans=None)])

    out = marked.mapInPandas(finish_whole, schema).unionByName(cut.mapInPandas(finish, schema)).withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", id_col)
    with arrow_rows(docs.sparkSession, BATCH):
        return written(out if with_text else out.drop("text"), "graph-kept")


def query(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), with_text=False)
