"""Near-duplicate detection by MinHash: many universal hash minima, banding, verification, connected components.

Documents with the same shingle set are one class, found by a digest of the set and collapsed before anything else moves.
Class signatures are cut into bands; classes that share a band's minima share a bucket. A bucket is compared in tiles of
bounded size, and a tile gives only pairs that can join what is still apart: first each class with the bucket's first
class and with its nearest earlier one, then, once verified links have been made components, every pair of different
components whose signatures allow the similarity. Every pair is decided on full shingle sets. What a group of near
copies emits is a few pairs a copy, not its square, and no bucket is capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FILTER_BITS, arrow_rows, bit_filter, table, written
from .components import components
from .tokens import batches, hashed_words, mixed

SHINGLE = 5
#: 32 bands of 6 minima: a pair at similarity 0.85 shares no band with a probability of 3e-7, at 0.8 of 6e-5.
BANDS, ROWS = 32, 6
#: Minima in all: those beyond the bands sharpen the estimate that spares a pair the comparison of its sets.
MINIMA = 512
TILE = 512
#: Characters hashed together.
CHARS = 800_000
_rng = np.random.RandomState(20)
_A = (_rng.randint(0, 1 << 31, MINIMA).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.randint(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)
_C = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[str], size: int = SHINGLE):
    """Sorted distinct 64-bit hashes of each text's shingles: of runs of size words, A-Z in lower case; of the whole
    sequence if it is shorter; none without words."""
    (words,), counts = hashed_words(texts, (2,), fold=True)
    n = max(0, len(words) - size + 1)
    runs = np.full(n, np.uint64(size), np.uint64)
    for i in range(size):
        runs = mixed(runs * _C + words[i : i + n])
    at = 0
    for count in counts.tolist():
        if count >= size:
            yield np.unique(runs[at : at + count - size + 1])
        elif count:
            one = np.array([count], np.uint64)
            for h in words[at : at + count]:
                one = mixed(one * _C + h)
            yield one
        else:
            yield np.zeros(0, np.uint64)
        at += count


def signature(shingles: np.ndarray, count: int = MINIMA) -> np.ndarray:
    """The first count minima of the universal hashes a * x + b, modulo 2 to the 32."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(count, np.uint32(0xFFFFFFFF))
    for i in range(0, len(x), 512):
        h = _A[:count, None] * x[i : i + 512]
        h += _B[:count, None]
        low = np.minimum(low, h.min(axis=1))
    return low


def _digest(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63)


def _signed(docs: DataFrame, size: int) -> DataFrame:
    """id, n_shingles, node (digest of the set; null for an empty one), bands."""

    def sign(frames):
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for a, b in batches(texts, CHARS):
                rows = []
                for doc, s in zip(frame["id"].iloc[a:b].tolist(), shingle_sets(texts[a:b], size), strict=True):
                    if not len(s):
                        rows.append((doc, 0, None, None))
                        continue
                    low = signature(s, BANDS * ROWS)
                    key = np.arange(BANDS, dtype=np.uint64)
                    for i in range(ROWS):
                        key = mixed(key * _C + low[i::ROWS].astype(np.uint64))
                    rows.append((doc, len(s), _digest(s), key.view(np.int64)))
                yield pd.DataFrame(rows, columns=["id", "n_shingles", "node", "bands"], dtype=object).astype({"node": "Int64"})

    # an id travels as text: pandas would round it where others are null
    plain = docs.select(F.col("id").cast("string"), F.col("text"))
    return plain.mapInPandas(sign, "id string, n_shingles long, node long, bands array<long>").withColumn("id", F.col("id").cast("long"))


def _lowest(threshold: float) -> float:
    """The share of equal minima below which a pair at the threshold falls with a probability of about 3e-5."""
    return threshold - 4 * (threshold * (1 - threshold) / MINIMA) ** 0.5


def _pairs(tiles: DataFrame, lowest: float, threshold: int, which: str) -> DataFrame:
    """Pairs a < b that signatures and set sizes allow, from tiles (key of the bucket; home, away: arrays of node, component,
    n, sig, bands; away empty where the tile meets itself). which: "first", each class with the first it may be linked with
    and the nearest before it; "apart", all of different components, in the first bucket they share."""

    def compare(frames):
        for frame in frames:
            for key, home, away in zip(frame["key"], frame["home"], frame["away"], strict=True):
                rows = [*home, *away]
                node, part = np.array([r["node"] for r in rows], np.int64), np.array([r["component"] for r in rows], np.int64)
                if which != "first" and (part == part[0]).all():
                    continue
                size = np.array([r["n"] for r in rows], np.int64)
                sig = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint8).reshape(len(rows), -1)
                bands = np.array([r["bands"] for r in rows], np.int64)
                tile = np.arange(len(rows)) < len(home)
                order = np.argsort(node, kind="stable")
                node, part, size, sig, bands, tile = node[order], part[order], size[order], sig[order], bands[order], tile[order]
                found = set()
                for i in range(1, len(node)):
                    to = slice(i)
                    alike = (np.count_nonzero(sig[to] == sig[i], axis=1) / MINIMA - 1 / 256) / (1 - 1 / 256)
                    good = (alike >= lowest) & (100 * np.minimum(size[to], size[i]) >= threshold * np.maximum(size[to], size[i]))
                    if len(away):
                        good &= tile[to] != tile[i]
                    if which != "first":
                        good &= part[to] != part[i]
                    if not good.any():
                        continue
                    if which == "apart":
                        other = np.flatnonzero(good)
                        other = other[bands[i][(bands[other] == bands[i]).argmax(axis=1)] == key]
                    else:
                        other = {int(np.argmax(np.where(good, alike, -1))), int(np.argmax(good))}
                    found.update((int(node[j]), int(node[i])) for j in other)
                if found:
                    yield pd.DataFrame(sorted(found), columns=["a", "b"])

    return tiles.mapInPandas(compare, "a long, b long").distinct()


def _tiles(members: DataFrame) -> DataFrame:
    """members: key, rows (in the bucket), node, component, sig. One row for each tile of a bucket and each two of its tiles;
    a tile has TILE rows on average, so memory is bounded whatever the bucket."""
    count = F.ceil(F.col("rows") / TILE).cast("int")
    placed = members.withColumn("tiles", count).withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    entry = F.struct("node", "component", "n", "sig", "bands")
    placed = placed.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), entry).alias("h"), F.when(F.col("own") > F.col("other"), entry).alias("w"))
    return placed.groupBy("key", "i", "j").agg(F.collect_list("h").alias("home"), F.collect_list("w").alias("away")).where(F.size("home") + F.size("away") > 1).select("key", "home", "away")


def _sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """node, shingles (sorted array) and sig (low byte of every minimum) of the members. Texts are read again where they lie;
    the filter spares most of them."""
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(members, "node"))

    def again(frames):
        keep = bits.value
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for a, b in batches(texts, CHARS):
                rows = []
                for s in shingle_sets(texts[a:b], size):
                    if len(s):
                        node = _digest(s)
                        at = node % FILTER_BITS
                        if keep[at >> 3] >> (at & 7) & 1:
                            rows.append((node, s.view(np.int64), (signature(s) & np.uint32(255)).astype(np.uint8).tobytes()))
                if rows:
                    yield pd.DataFrame(rows, columns=["node", "shingles", "sig"])

    return docs.select("text").mapInPandas(again, "node long, shingles array<long>, sig binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80, size: int = SHINGLE) -> DataFrame:
    """One row per input row: id, n_shingles, class_id (digest of the shingle set), component_id, kept.

    Two rows are linked if 100 * shingles in common >= threshold * shingles of both; component_id is the smallest id that
    links reach, and the row with that id is kept. Texts without words (null too) have no shingles, link with nothing and
    keep their own id. Equal texts are one class; rows that repeat an id are rows of their own, and all rows with the
    smallest id are kept. A null id comes after all others. Empty tables give empty results; other columns are ignored.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    per_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        signed = written(_signed(plain, size), "minhash-signed")
        classes = written(signed.where("node is not null").groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "minhash-classes")
        banded = classes.select("node", F.explode("bands").alias("key"))
        shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
        members = written(banded.join(shared, "key"), "minhash-members")
        nodes = members.select("node").distinct()
        # of several documents of one class, any one's set serves: they are the same
        sets = written(_sets(plain, nodes, size).groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("sig").alias("sig")).join(nodes, "node", "left_semi"), "minhash-sets")
        signs = written(sets.select("node", "sig").join(classes, "node").select("node", "n", "sig", "bands"), "minhash-signs")
        lowest = _lowest(threshold / 100)

        def verified(pairs: DataFrame) -> DataFrame:
            left, right = (sets.select(F.col("node").alias(n), F.col("shingles").alias(s)) for n, s in (("a", "x"), ("b", "y")))
            both = pairs.join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("x", "y")))
            return both.where(100 * F.col("common") >= threshold * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")

        links, parts = None, None
        for which in ("first", "apart"):
            if parts is None:
                now = members.join(signs.withColumn("component", F.col("node")), "node")
            else:  # buckets of one component are done
                known = signs.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
                open_ = written(members.join(known, "node"), "minhash-open")
                several = open_.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("key")
                now = open_.join(several, "key", "left_semi")
            with arrow_rows(spark, 16):  # a row is a tile
                pairs = written(_pairs(_tiles(now), lowest, threshold, which), "minhash-pairs")
            found = written(verified(pairs), "minhash-links")
            links = found if links is None else links.unionByName(found)
            parts = components(links)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    labelled = signed.select("id", "n_shingles", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # written, so that the join has exchanges of its own and a component with most of the rows can be split
    smallest = written(labelled.where("component is not null").groupBy("component").agg(F.min("id").alias("low")), "minhash-smallest")
    out = labelled.join(smallest, "component", "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("low"))
    return out.select(F.col("id").alias(id_col), "n_shingles", F.col("node").alias("class_id"), own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80) -> DataFrame:
    """docs' rows and columns, one id of each component: the smallest. Nulls as in near_duplicates(); rows that share a kept
    id all stay."""
    kept = near_duplicates(docs, id_col, text_col, threshold).where("kept").select(F.col(id_col).alias("kept_id"))
    ids = written(kept.distinct(), "minhash-kept")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"))
    return rows.join(ids, F.col("id").eqNullSafe(F.col("kept_id")), "left_semi").select("doc.*")


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), threshold=85)
