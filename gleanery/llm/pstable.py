"""Near copies among vectors by Euclidean p-stable hashing.

Vectors are brought to length 1 and projected on random normal directions; the
projections, shifted and cut into steps of `width`, make up the key of a
bucket, `hashes` of them per table. Vectors that share a bucket in any of the
tables are compared by their exact cosine. A pair is counted in the first
table that brings it together, so no pair is counted twice.

For a cosine of 0.95 (distance 0.316) a step of 1.5 keeps two vectors together
with probability 0.83; with 8 hashes and 16 tables a pair at the bound is
found with 98 %, one at 0.97 with 99.8 %, and of two unrelated vectors in
2000 pairs one shares a bucket of a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import Forest, components, in_groups, numbers, tiled, whole_groups
from gleanery.scale import written

COSINE = 0.95
TABLES = 16
HASHES = 8
WIDTH = 1.5
SEED = 7

#: Rows of one matrix product inside a task.
BLOCK = 512

#: Cosines this close to the bound are worked out again pair by pair.
CLOSE = 1e-9


def usable(vector: str) -> Column:
    """Whether a vector has a direction: known, finite in all components and not zero."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    v = F.col(vector)
    return F.coalesce(
        (F.size(v) > 0) & F.forall(v, finite) & F.exists(v, lambda x: F.coalesce(x != 0, F.lit(False))),
        F.lit(False),
    )


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows brought to length 1; first scaled by their greatest component, so nothing overflows."""
    scaled = vectors.astype(np.float64)
    scaled = scaled / np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def bucket_keys(units: np.ndarray, tables: int, hashes: int, width: float) -> np.ndarray:
    """One whole number per row and table: the steps of its projections, mixed."""
    draw = np.random.default_rng([SEED, units.shape[1]])
    directions = draw.standard_normal((units.shape[1], tables * hashes))
    shifts = draw.uniform(0, width, tables * hashes)
    mixers = draw.integers(1, 1 << 62, tables * hashes) | 1
    steps = np.floor((units @ directions + shifts) / width).astype(np.int64)
    mixed = (steps * mixers).reshape(len(units), tables, hashes).sum(axis=2)
    return (mixed >> 31).astype(np.int32)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _keyed(rows: DataFrame, tables: int, hashes: int, width: float) -> DataFrame:
    """Rows `node`, `weight`, `vector` once per table with the bucket `key` and all `keys`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            keys = np.zeros((batch.num_rows, tables), np.int32)
            for dim in np.unique(lengths):
                chosen = np.flatnonzero(lengths == dim)
                units = unit(_matrix(batch.column(2).take(pa.array(chosen)), dim))
                keys[chosen] = bucket_keys(units, tables, hashes, width)
            packed = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), tables)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, packed.cast(pa.list_(pa.int32()))], [*batch.schema.names, "keys"]
            )

    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"node long, weight long, vector {kind}, keys array<int>"
    keyed = rows.select("node", "weight", "vector").mapInArrow(run, schema)
    return keyed.select(
        F.posexplode("keys").alias("table", "key"), F.size("vector").alias("dim"),
        "node", "weight", "vector", "keys",
    )


def _near(a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    found = a @ b.T
    x, y = np.nonzero(found >= cosine - CLOSE)
    unsure = np.abs(found[x, y] - cosine) < CLOSE
    if unsure.any():
        u, v = a[x[unsure]], b[y[unsure]]
        exact = (u * v).sum(axis=1) / np.sqrt((u * u).sum(axis=1) * (v * v).sum(axis=1))
        keep = np.ones(len(x), bool)
        keep[unsure] = exact >= cosine
        x, y = x[keep], y[keep]
    return x, y


def compare(
    units: np.ndarray, weight: np.ndarray, keys: np.ndarray, tile: np.ndarray, cross: bool,
    table: int, cosine: float,
) -> tuple[np.ndarray, Forest]:
    """Weighted links of every row of a bucket, and their forest.

    Pairs that share a bucket of an earlier table are left to that table.
    """
    links, forest = np.zeros(len(units), np.int64), Forest(len(units))
    low = tile == tile.min()
    left = np.flatnonzero(low) if cross else np.arange(len(units))
    right = np.flatnonzero(~low) if cross else left
    for i in range(0, len(left), BLOCK):
        a = left[i : i + BLOCK]
        for j in range(0 if cross else i, len(right), BLOCK):
            b = right[j : j + BLOCK]
            x, y = _near(units[a], units[b], cosine)
            x, y = a[x], b[y]
            new = np.ones(len(x), bool) if cross else x < y
            if table:
                new &= ~(keys[x, :table] == keys[y, :table]).any(axis=1)
            x, y = x[new], y[new]
            np.add.at(links, x, weight[y])
            np.add.at(links, y, weight[x])
            forest.link(x, y)
    return links, forest


def vector_links(
    distinct: DataFrame, cosine: float, tables: int, hashes: int, width: float
) -> DataFrame:
    """`a` with the weight of its `links` found in a bucket, and pairs `a`, `b` that join them."""
    group = ["table", "key", "dim"]
    keyed = _keyed(distinct, tables, hashes, width)
    pairs = in_groups(tiled(keyed, group, F.col("node")), [*group, "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in whole_groups(batches, [*group, "low", "high"]):
            node, weight, tile = (numbers(rows, c) for c in ("node", "weight", "tile"))
            table, dim = numbers(rows, "table"), numbers(rows, "dim")
            low, high = numbers(rows, "low"), numbers(rows, "high")
            vectors = rows.column("vector").combine_chunks()
            keys = _matrix(rows.column("keys").combine_chunks(), tables)
            for a, b in zip(starts, [*starts[1:], rows.num_rows], strict=True):
                cross = low[a] != high[a]
                if b - a < 2 or cross and tile[a:b].min() == tile[a:b].max():
                    continue
                links, forest = compare(
                    unit(_matrix(vectors.slice(a, b - a), dim[a])), weight[a:b], keys[a:b],
                    tile[a:b], cross, table[a], cosine,
                )
                linked = np.flatnonzero(links)
                x, y = forest.edges()
                if len(linked):
                    ids = node[a:b]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([ids[linked], ids[x]])),
                            pa.array([None] * len(linked) + ids[y].tolist(), pa.int64()),
                            pa.array(np.concatenate([links[linked], np.zeros(len(x), np.int64)])),
                        ],
                        ["a", "b", "links"],
                    )

    return pairs.mapInArrow(run, "a long, b long, links long")


def vector_groups(
    df: DataFrame,
    key: str,
    vector: str,
    cosine: float = COSINE,
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
) -> DataFrame:
    """`key`, `n_links`, `component_id` and `kept` for every row of `df`.

    Equal vectors are one row of the search, weighted by how many there are.
    Vectors that are NULL, empty or zero, or hold a NULL or a number that is
    not finite, link with nothing, as do rows with a NULL key; vectors of
    different length do not link. `key` is a whole number; repeated rows are
    vectors of their own, with one component.
    """
    rows = df.select(F.col(key).cast("long").alias("node"), F.col(vector).alias("vector"))
    rows = rows.withColumn("ok", usable("vector") & F.col("node").isNotNull())
    classes = written(
        rows.filter("ok").groupBy("vector").agg(
            F.min("node").alias("node"), F.count(F.lit(1)).alias("weight")
        ),
        "vectors",
    )
    found = written(vector_links(classes, cosine, tables, hashes, width), "vector-links")
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    groups = components(found.filter("b is not null").select("a", "b"))
    named = classes.join(links, "node", "left").join(groups, "node", "left").select(
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    named = written(named, "vector-groups")
    linked = rows.filter("ok").join(named, "vector").select("node", "n_links", "component_id")
    alone = rows.filter("not ok").select(
        "node", F.lit(0).cast("long").alias("n_links"), F.col("node").alias("component_id")
    )
    return linked.unionByName(alone).select(
        F.col("node").alias(key),
        F.col("n_links").cast("long").alias("n_links"),
        "component_id",
        F.coalesce(F.col("node") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
