"""What the operators of this package share: Arrow batches of whole groups, tiles of
hot groups, and connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.scale import written

# Rows of a bucket that one task compares with each other; larger buckets are cut into tiles.
TILE_ROWS = 2048

#: Parts in which the greatest rows are looked for before they are put together.
TOP_PARTS = 16

#: After so many rounds the links cannot be those of a sound input.
MAX_ROUNDS = 60


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: Sequence[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Arrow tables that never cut a group, with the row at which each group begins.

    The batches must come sorted by `keys`, whole numbers without NULL.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        last = _last_start(batch, keys)
        if last == 0 and _same(held, keys):
            continue
        table = pa.Table.from_batches(held)
        done = table.num_rows - batch.num_rows + last
        if done:
            ready = table.slice(0, done).combine_chunks()
            yield ready, _starts(ready, keys)
        held = [batch.slice(last)]
    if held:
        ready = pa.Table.from_batches(held).combine_chunks()
        yield ready, _starts(ready, keys)


def numbers(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    column = table.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.to_numpy(zero_copy_only=False)


def _changes(table: pa.Table | pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    changed = np.zeros(max(table.num_rows - 1, 0), bool)
    for key in keys:
        values = numbers(table, key)
        changed |= values[1:] != values[:-1]
    return np.flatnonzero(changed) + 1


def _starts(table: pa.Table, keys: Sequence[str]) -> np.ndarray:
    return np.concatenate([[0], _changes(table, keys)])


def _last_start(batch: pa.RecordBatch, keys: Sequence[str]) -> int:
    changes = _changes(batch, keys)
    return int(changes[-1]) if len(changes) else 0


def _same(held: list[pa.RecordBatch], keys: Sequence[str]) -> bool:
    """Whether the last batch, all one group, goes on with the group before it."""
    if len(held) < 2:
        return True
    before, now = held[-2], held[-1]
    return all(before.column(k)[-1].as_py() == now.column(k)[0].as_py() for k in keys)


def tiled(
    rows: DataFrame,
    keys: Sequence[str],
    spread_by: Column,
    strip: Column | None = None,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """`rows` of buckets with company, once per pair of tiles in which they are compared.

    Adds `tile`, `low` and `high`: rows of tile `low` meet rows of tile `high`
    of the same bucket. A bucket of at most `tile_rows` rows is one tile. A
    larger one is cut by the hash of `spread_by`, and first by `strip` where
    given: then only neighbouring strips meet. No bucket is dropped or cut off.
    """
    sizes = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
        .withColumn("_salts", F.ceil(F.col("_rows") / tile_rows).cast("int"))
        .drop("_rows")
    )
    salts = F.col("_salts")
    place = F.when(salts == 1, 0).otherwise(F.pmod(F.xxhash64(spread_by), salts)).cast("int")
    every = F.sequence(F.lit(0), salts - 1)
    if strip is None:
        tile, partners = place, every
    else:
        cut = F.when(salts == 1, 0).otherwise(strip).cast("int")
        tile = cut * salts + place
        reach = F.when(salts == 1, F.array(F.lit(0))).otherwise(
            F.array(*[strip + F.lit(step) for step in (-1, 0, 1)])
        )
        near = F.transform(reach, lambda s: F.transform(every, lambda e: s * salts + e))
        partners = F.flatten(near)
    met = rows.join(sizes, list(keys)).withColumn("tile", tile)
    paired = met.withColumn("_partner", F.explode(partners)).drop("_salts")
    return paired.select(
        *rows.columns,
        "tile",
        F.least("tile", "_partner").cast("int").alias("low"),
        F.greatest("tile", "_partner").cast("int").alias("high"),
    )


def in_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt out and sorted so that `whole_groups` can take them apart."""
    return rows.repartition(*keys).sortWithinPartitions(*keys)


class Forest:
    """Links among the rows of one tile pair, kept as a spanning forest."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Joins row a[i] with row b[i]; labels are the least row of each part."""
        while len(a):
            low, high = self.label[a], self.label[b]
            apart = low != high
            a, b, low, high = a[apart], b[apart], low[apart], high[apart]
            np.minimum.at(self.label, np.maximum(low, high), np.minimum(low, high))
            while True:
                nearer = self.label[self.label]
                if np.array_equal(nearer, self.label):
                    break
                self.label = nearer

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        rows = np.flatnonzero(self.label != np.arange(len(self.label)))
        return rows, self.label[rows]


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the least node it is joined with, for every node of `edges`.

    `edges` has the whole-number columns `a` and `b`. Large and small stars in
    turn, each round one written table: the rounds grow with the logarithm of
    the longest path, and every minimum is formed before it is shuffled. Nodes
    without a link to another are left out.
    """
    links = (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("lower"))
        .distinct()
    )
    links = written(links, "links")
    for _ in range(MAX_ROUNDS):
        parents = links.groupBy("node").agg(
            F.min("lower").alias("_least"), F.count(F.lit(1)).alias("_n")
        )
        heads = parents.select(F.col("node").alias("lower"), "_n")
        open_links = links.join(heads, "lower", "left_semi")
        branching = parents.filter("_n > 1").limit(1).count()
        if not branching and not open_links.limit(1).count():
            return links.select("node", F.col("lower").alias("component")).unionByName(
                links.select(F.col("lower").alias("node"), F.col("lower").alias("component"))
                .distinct()
            )
        links = written(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the least node around it."""
    both = links.select(F.col("node").alias("u"), F.col("lower").alias("v")).unionByName(
        links.select(F.col("lower").alias("u"), F.col("node").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("node"), F.col("m").alias("lower"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the least of them."""
    least = links.groupBy("node").agg(F.min("lower").alias("m"))
    moved = (
        links.join(least, "node")
        .filter("lower <> m")
        .select(F.col("lower").alias("node"), F.col("m").alias("lower"))
    )
    return least.select("node", F.col("m").alias("lower")).unionByName(moved).distinct()


def top_rows(df: DataFrame, score: str, name: str, n: int) -> DataFrame:
    """The `n` rows with the greatest `score`, ties in the order of `name`, which is unique.

    Every one of `TOP_PARTS` parts is cut down first, so that what reaches the
    driver does not grow with the number of partitions.
    """
    part = F.pmod(F.xxhash64(name), F.lit(TOP_PARTS))
    ranked = Window.partitionBy(part).orderBy(F.desc(score), name)
    first = df.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n)
    return first.drop("_rank").orderBy(F.desc(score), name).limit(n)


def boxed(df: DataFrame, **named: Column) -> DataFrame:
    """The rows of `df` as one column `_row` beside the named ones, so that no names clash."""
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        *[value.alias(name) for name, value in named.items()],
    )


def unboxed(columns: Sequence[str], **changed: Column) -> list[Column]:
    """Columns of `_row` again; those named in `changed` are replaced or added at the end."""
    kept = [
        changed[c].alias(c) if c in changed else F.col(f"_row.`{c}`").alias(c) for c in columns
    ]
    return kept + [value.alias(c) for c, value in changed.items() if c not in columns]
