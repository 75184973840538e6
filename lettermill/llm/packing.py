"""Packing token sequences by first-fit decreasing over a tournament tree of bin capacities.

Documents are tokenised where they lie and cut into pieces of at most the sequence length; full pieces fill sequences
of their own. What is left of each document is dealt at random into groups of bounded size, and each group is packed by
itself: pieces from longest to shortest, each into the first bin with room. The tree holds every bin's free room at its
leaves and the larger of two children above, so the first bin that fits is found in as many steps as the tree is high.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, table, written
from .tokens import batches, vocabulary, text_encoder

SEQUENCE = 2048
END_ID = 1
#: Pieces a group on average; groups are packed apart, each wastes at most about one sequence.
GROUP_PIECES = 1024
#: Documents a batch to Python.
BATCH_ROWS = 1000
VOCABULARY = "word_bpe_49k.json"


def first_fit_decreasing(sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size (0 < size <= room); larger first, ties by position."""
    n = len(sizes)
    leaves = 1
    while leaves < max(1, n):
        leaves *= 2
    free = [room] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        need, at = int(sizes[i]), 1
        while at < leaves:
            at *= 2
            if free[at] < need:
                at += 1
        bins[i], offsets[i] = at - leaves, room - free[at]
        free[at] -= need
        while at > 1:
            at //= 2
            left, right = free[2 * at], free[2 * at + 1]
            free[at] = left if left > right else right
    return bins, offsets


def token_pieces(docs: DataFrame, id_col: str, text_col: str, path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: id, doc_row, start, length, ids_crc32, doc_tokens and, if asked for, ids. A null text is
    an empty one; every document ends with END_ID, so none is without tokens. A null id stays; rows that repeat an id are told
    apart by doc_row; an empty table has no pieces; other columns are ignored."""
    schema = "id string, doc_row long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids

    def cut(frames):
        encoder = text_encoder(path)
        for frame in frames:
            texts = [t or "" for t in frame["text"]]
            for a, b in batches(texts):
                rows = []
                for doc, row, text in zip(frame["id"].iloc[a:b].tolist(), frame["doc_row"].iloc[a:b], texts[a:b], strict=True):
                    ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                    for s in range(0, len(ids), sequence):
                        part = ids[s : s + sequence]
                        rows.append((doc, row, s, len(part), zlib.crc32(part.tobytes()), len(ids), *([part.astype(int).tolist()] if with_ids else [])))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")])

    # an id travels as text: pandas would round it where others are null
    plain = docs.select(F.col(id_col).cast("long").cast("string").alias("id"), F.monotonically_increasing_id().alias("doc_row"), F.col(text_col).alias("text"))
    return plain.mapInPandas(cut, schema).withColumn("id", F.col("id").cast("long"))


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids if asked for.

    Every id of every document is in exactly one piece; pieces of one sequence lie without gaps from offset 0. Empty and
    null texts give one piece with END_ID alone; rows that repeat an id are documents of their own; an empty table gives
    an empty result. Groups depend on ids, texts and rows' places in their files, so reruns over the same files agree and
    repeated rows are spread.
    """
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        pieces = written(token_pieces(docs, id_col, text_col, path or vocabulary(VOCABULARY), sequence, with_ids), "pack-pieces")
    loose = pieces.where(F.col("length") < sequence)
    groups = max(1, -(-loose.count() // GROUP_PIECES))
    full = pieces.where(F.col("length") == sequence).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))
    dealt = loose.withColumn("group", F.pmod(F.xxhash64("id", "doc_tokens", "ids_crc32", "doc_row", F.lit("pack")), F.lit(groups)))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        bins, offsets = first_fit_decreasing(frame["length"].to_numpy(), sequence)
        return frame.assign(sequence_id=frame["group"].astype("int64") * 2**32 + bins, offset=offsets)[columns]

    as_text = full.withColumn("id", F.col("id").cast("string"))
    columns = as_text.columns
    small = dealt.withColumn("id", F.col("id").cast("string")).groupBy("group").applyInPandas(pack, as_text.schema).withColumn("id", F.col("id").cast("long"))
    return full.unionByName(small).drop("doc_row").withColumnRenamed("id", id_col)


def query(spark, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
