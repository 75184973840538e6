"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors are rotated by a fixed random rotation and split into blocks of few dimensions. Two vectors within a squared
distance d lie within d * (dimensions of the block / all dimensions) of each other in at least one block, so a range join
in each block under that share of the budget finds every pair; the union of what the blocks find is verified exactly. A
block's range join is a grid on its first coordinates, as wide as the block's radius: a vector is compared within its own
cell and sent to half of the cells around. Cells are compared in tiles of bounded size. A pair counts in the first block
that finds it, so tiles give sums and spanning edges, never pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, table, written
from .components import components
from .tokens import mixed

MIN_COSINE = 0.93
BLOCK_DIMS = 16
#: Rows of a tile on average, and those of them compared at once.
TILE, STRIP = 4096, 512
#: Half of the cells around a cell; the other half sends to it.
AROUND = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))
_rotations: dict = {}


def _rotation(dims: int) -> np.ndarray:
    if dims not in _rotations:
        _rotations[dims] = np.linalg.qr(np.random.RandomState(7).normal(size=(dims, dims)))[0]
    return _rotations[dims]


def _blocks(dims: int, cosine: float) -> list[tuple[slice, float]]:
    """Each block's place and squared-distance budget, with room for rounding."""
    edges = np.linspace(0, dims, max(1, round(dims / BLOCK_DIMS)) + 1).astype(int)
    return [(slice(a, b), 2 * (1 - cosine) * (b - a) / dims * (1 + 1e-9) + 1e-12) for a, b in zip(edges, edges[1:], strict=False)]


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    scaled = v / np.abs(v).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _placed(classes: DataFrame, cosine: float, kind: str) -> DataFrame:
    """node, key (label, block and cell), home."""

    def place(frames):
        for frame in frames:
            for dims, own in frame.groupby(frame["raw"].map(len) // np.dtype(kind).itemsize):
                rotated = _unit(own["raw"].tolist(), kind) @ _rotation(dims)
                label = own["label"].to_numpy(np.int64).astype(np.uint64)
                for b, (at, budget) in enumerate(_blocks(dims, cosine)):
                    cell = np.floor(rotated[:, at][:, :2] / np.sqrt(budget)).astype(np.int64)
                    if cell.shape[1] < 2:
                        cell = np.column_stack([cell, np.zeros(len(cell), np.int64)])
                    for dx, dy in AROUND:
                        key = mixed(label + np.uint64((dims * 1000 + b + 1) * 0x9E3779B97F4A7C15 % 2**64))
                        for c in (cell[:, 0] + dx, cell[:, 1] + dy):
                            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64))
                        yield pd.DataFrame({"node": own["node"].to_numpy(), "block": b, "key": key.view(np.int64), "home": (dx, dy) == (0, 0)})

    return classes.mapInPandas(place, "node long, block int, key long, home boolean")


def _alike(tiles):
    """Tiles apart by label and length: a cell's key is a digest, and what it brings together needn't be alike."""
    for block, near, far in tiles:
        kinds = {(r["name"], len(r["raw"])) for r in (*near, *far)}
        for kind in kinds:
            own = [[r for r in side if (r["name"], len(r["raw"])) == kind] for side in (near, far)] if len(kinds) > 1 else [near, far]
            if not len(far) and len(own[0]) > 1 or len(own[0]) and len(own[1]):
                yield block, *own


def _joined(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Roots (places, the least of each set) after the sets of x and y are made one, pair by pair; parent: roots so far."""
    while True:
        x, y = parent[x], parent[y]
        apart = x != y
        if not apart.any():
            return parent
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while (parent[parent] != parent).any():
            parent = parent[parent]


def _compared(tiles: DataFrame, cosine: float, kind: str) -> DataFrame:
    """node, links (vectors linked in this tile), other (the smallest node it reaches in this tile). A tile's rows are compared in
    strips, so memory is a strip's."""

    def compare(frames):
        for frame in frames:
            for block, near, far in _alike(zip(frame["block"], frame["near"], frame["far"], strict=True)):
                rows = [*near, *far]
                node = np.array([r["node"] for r in rows], np.int64)
                home, many = np.array([r["home"] for r in rows]), np.array([r["vectors"] for r in rows], np.int64)
                unit = _unit([r["raw"] for r in rows], kind)
                rotated = unit @ _rotation(unit.shape[1])
                blocks = _blocks(unit.shape[1], cosine)
                at, budget = blocks[block]
                part = rotated[:, at]
                norm = np.einsum("ij,ij->i", part, part)
                right = np.arange(len(near) if len(far) else 0, len(rows))
                links, parent = np.zeros(len(rows), np.int64), np.arange(len(rows))
                for a in range(0, len(near), STRIP):
                    left = np.arange(a, min(a + STRIP, len(near)))
                    own = right if len(far) else right[a:]
                    close = norm[left, None] + norm[own] - 2 * part[left] @ part[own].T <= budget + 1e-9
                    close &= home[left, None] | home[own]
                    i, j = np.nonzero(close)
                    i, j = left[i], own[j]
                    if not len(far):
                        i, j = i[i < j], j[i < j]
                    for k in range(0, len(i), 65536):
                        x, y = i[k : k + 65536], j[k : k + 65536]
                        swap = node[x] > node[y]  # the same order of operations for a pair wherever it is met
                        x, y = np.where(swap, y, x), np.where(swap, x, y)
                        good = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
                        x, y = x[good], y[good]
                        gap = rotated[x] - rotated[y]
                        found = [np.einsum("ij,ij->i", gap[:, s], gap[:, s]) <= most for s, most in blocks[: block + 1]]
                        first = found[block] & ~np.any(found[:block], axis=0) if block else found[0]
                        x, y = x[first], y[first]
                        links += np.bincount(x, many[y], len(rows)).astype(np.int64) + np.bincount(y, many[x], len(rows)).astype(np.int64)
                        parent = _joined(parent, x, y)
                low = np.full(len(rows), np.iinfo(np.int64).max)
                np.minimum.at(low, parent, node)
                own = links > 0
                if own.any():
                    yield pd.DataFrame({"node": node[own], "links": links[own], "other": low[parent[own]]})

    return tiles.mapInPandas(compare, "node long, links long, other long")


def linked_vectors(vectors: DataFrame, id_col="vec_id", vector_col="embedding", label_col: str | None = "label", cosine: float = MIN_COSINE) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Labels may be of any type that has a text; equal ones have equal texts. Vectors of equal label and length are linked if their cosine, in double precision, is at least cosine. Null, empty and
    zero vectors, those with a null or non-finite component and those with a null label link with nothing: no links, their
    own id as component, kept. Equal vectors are one class and are linked with each other; each row is a vector, ids may
    repeat. kept: the id is the component's smallest. Empty tables give empty results; other columns are ignored.
    """
    spark = vectors.sparkSession
    label = F.col(label_col).cast("string") if label_col else F.lit("")
    # components move in the width they came in; all arithmetic is in double precision
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col).cast("array<double>").alias("v"), F.monotonically_increasing_id().alias("row"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("v").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    rows = written(rows.withColumn("v", F.when(F.coalesce(good, F.lit(False)), F.transform("v", lambda x: x + 0.0))), "vectors")
    classes = rows.where("v is not null").groupBy("label", "v").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("vectors"))

    def packed_bytes(frames):
        for frame in frames:
            yield frame.assign(v=[np.asarray(x, kind).tobytes() for x in frame["v"]])

    classes = written(classes, "vector-classes")
    raw = written(classes.select("node", F.xxhash64("label").alias("label"), F.col("label").alias("name"), "vectors", "v").mapInPandas(packed_bytes, "node long, label long, name string, vectors long, v binary").withColumnRenamed("v", "raw"), "vector-bytes")
    placed = written(_placed(raw.select("node", "label", "raw"), cosine, kind), "vector-cells")
    cells = placed.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("home").cast("int")).alias("homes")).where("rows > 1 and homes = 1")
    tiled = placed.join(cells.select("key", "rows"), "key").withColumn("tiles", F.ceil(F.col("rows") / TILE).cast("int"))
    tiled = tiled.withColumn("own", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = tiled.join(raw.select("node", "vectors", "name", "raw"), "node")
    entry = F.struct("node", "home", "vectors", "name", "raw")
    tiled = tiled.select("key", "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") <= F.col("other"), entry).alias("n"), F.when(F.col("own") > F.col("other"), entry).alias("f"))
    tiles = tiled.groupBy("key", "block", "i", "j").agg(F.collect_list("n").alias("near"), F.collect_list("f").alias("far")).where((F.size("near") + F.size("far") > 1) & ((F.col("i") == F.col("j")) | (F.size("near") > 0) & (F.size("far") > 0)))
    with arrow_rows(spark, 4):  # a row is a tile
        found = written(_compared(tiles.select("block", "near", "far"), cosine, kind), "vector-links")
    parts = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.join(sums, "node", "left").join(parts, "node", "left")
    known = known.select(F.col("label").alias("l"), F.col("v").alias("w"), (F.coalesce("links", F.lit(0)) + F.col("vectors") - 1).alias("links"), F.coalesce("component", "node").alias("component"))
    joined = rows.join(known, (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")), "left").select("id", "links", "component")
    # written, so that a component with most of the rows can be split in the join
    lowest = written(joined.where("component is not null").groupBy("component").agg(F.min("id").alias("low")), "vector-lowest")
    out = joined.join(lowest, "component", "left")
    own = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("low"))
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("id").eqNullSafe(own).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return linked_vectors(table(spark, sf_dir, "embeddings"))
