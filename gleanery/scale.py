"""What the operators share to hold up at scale: written stages, measured
broadcasts, salted joins and contiguous numbering."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A side is broadcast only when its measured text size is below this.
BROADCAST_BYTES = 32 * 1024 * 1024

# Rows of one key that a task of a join gets at most, as far as MAX_HOT_KEYS allows.
TASK_ROWS = 1_000_000

# Keys with salts of their own, of which there is a broadcast table: they hold at least one row
# in so many.
MAX_HOT_KEYS = 100_000

# Writer options for rows of a megabyte or so. Parquet looks at the size of a page and of a row
# group after 100 rows only, and compresses and reads a page in buffers of its size outside the
# heap, which it keeps; so sizes are looked at row by row, and row groups are small.
WIDE_ROWS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size.row.check.max": "1",
    "parquet.block.size": str(8 * 1024 * 1024),
}

# monotonically_increasing_id() keeps the row position in its lower 33 bits.
POSITION_BITS = 33


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="gleanery-")
    return _LOCAL_FOLDERS[application]


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/gleanery/{label}-{uuid.uuid4().hex}"
    if (made := _SCRATCH.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables that are written inside the block when it is left.

    For work whose results do not read them: tables saved elsewhere.
    """
    made: list[str] = []
    token = _SCRATCH.set(made)
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        configuration = spark.sparkContext._jsc.hadoopConfiguration()
        for name in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(configuration).delete(path, True)


def written(df: DataFrame, label: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """`df` written to the shared folder and read back.

    Cuts the lineage in a way that outlives lost executors, fixes values that
    would differ on recomputation, and gives Catalyst true file sizes. Rows of
    megabytes need `WIDE_ROWS` as the `options` of the writer.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_size(df: DataFrame) -> int:
    """Bytes of all rows of `df` as JSON text: a size that grows with rows and widths."""
    row = df.agg(
        F.sum(F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)))) + 16)
    ).first()
    return row[0] or 0


def hot_keys(df: DataFrame, key: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Values of `key` with more rows than a task should get, and the `_salts` they are spread over.

    The counts are combined before the shuffle, so a hot key costs no task
    more than one row per input partition. There are at most MAX_HOT_KEYS of
    them, whatever the size of `df`: beyond that the bound on the rows rises.
    """
    counts = written(
        df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows")),
        "key-counts",
    )
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    most = max(task_rows, total // MAX_HOT_KEYS)
    salts = F.ceil(F.col("_rows") / F.lit(most)).cast("int")
    return written(counts.filter(F.col("_rows") > most).select(key, salts.alias("_salts")), "hot-keys")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    hot: DataFrame,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Equi-join on `key` with the hot keys of `left` spread over many tasks.

    `hot` is what `hot_keys` gives, or any table of keys and `_salts` small
    enough to broadcast. Rows of `right` are repeated once per salt for hot
    keys only. Rows of `left` with a NULL key match nothing; they do not take
    part in the join but are added to its result where `how`, which is inner,
    left, left_semi or left_anti, keeps them. The salt comes from the input
    partition and `spread_by`: copies of one row spread too, and a task that
    runs again puts each row where it was.
    """
    hot = F.broadcast(hot)
    salts = F.coalesce("_salts", F.lit(1))
    place = F.xxhash64(F.spark_partition_id(), *spread_by)
    known = left.filter(F.col(key).isNotNull()).join(hot, key, "left")
    spread = known.withColumn("_salt", F.pmod(place, salts).cast("int")).drop("_salts")
    repeated = (
        right.filter(F.col(key).isNotNull())
        .join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    joined = spread.join(repeated, [key, "_salt"], how).drop("_salt")
    if how in ("inner", "left_semi"):
        return joined
    unknown = left.filter(F.col(key).isNull())
    return joined.unionByName(unknown, allowMissingColumns=True)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread_by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    profile: Callable[[], DataFrame] | None = None,
    profile_share: float = 1.0,
) -> DataFrame:
    """Equi-join of a large frame with a smaller one.

    `right` is broadcast when its measured size allows it: then `left` is not
    shuffled and skew does not matter. Beyond that the join is salted for the
    hot keys found in `left`, or in `profile`, a share of its rows, where
    `left` is costly to make.
    """
    if text_size(right) <= broadcast_bytes:
        return left.join(F.broadcast(right), key, how)
    if profile:
        hot = hot_keys(profile(), key, max(1, int(TASK_ROWS * profile_share)))
    else:
        hot = hot_keys(left, key)
    return salted_join(left, right, key, how, hot, spread_by)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` with `value` bound to a name, so that lambdas in it do not work it out again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a costly column that later filters and projections cannot copy into themselves.

    Catalyst moves a filter below the projection that makes its column and so
    evaluates the column twice; it does not move one below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def exploded(df: DataFrame, values: Column, name: str, *keep: str) -> DataFrame:
    """One row per array element that is not NULL, the array being evaluated once.

    A plain explode has Catalyst test the size of the array in a filter first,
    which costs a second evaluation.
    """
    return df.select(*keep, F.explode_outer(values).alias(name)).filter(F.col(name).isNotNull())


def contiguous_ids(
    df: DataFrame, order_by: Sequence[str], id_col: str, after: int | Column = 0
) -> DataFrame:
    """`df` with the ids after + 1, after + 2, ... in the order of `order_by` (NULLs last).

    Rows are shuffled into sorted ranges once and written nowhere: the sizes of
    the ranges and the rows in them come from the same exchange, so an id is
    the place of a row in its range plus the sizes of the ranges before it.
    `order_by` must be unique in `df`, which also keeps the ranges even. Every
    row is checked to lie between the ends its range has in the counts; a plan
    that shuffled twice would fail by that and not give wrong ids.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.exchange.reuse").lower() != "true":
        raise RuntimeError("numbering rows needs spark.sql.exchange.reuse")
    order = [F.col(c).asc_nulls_last() for c in order_by]
    # A number of partitions that is named is not changed on the way.
    ranged = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    # All columns take part, so that both uses of the exchange are of the same columns.
    key = F.struct(*[part for c in order_by for part in (F.col(c).isNull(), F.col(c))])
    place = F.struct(key, F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)))
    sizes = (
        ranged.select(F.spark_partition_id().alias("_range"), place.alias("_place"))
        .groupBy("_range")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.min("_place").alias("_first"),
            F.max("_place").alias("_last"),
        )
    )
    # One row per range, so the window below is over a few thousand rows at most.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0)) + after
    starts = sizes.select("_range", "_first", "_last", start.alias("_start"))
    numbered = ranged.sortWithinPartitions(*order).withColumn(
        "_slot", F.monotonically_increasing_id()
    )
    range_no = F.shiftright("_slot", POSITION_BITS)
    position = F.col("_slot").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    found = numbered.withColumn("_range", range_no.cast("int")).join(F.broadcast(starts), "_range", "left")
    moved = F.raise_error(F.lit("the ranges were made twice and differ"))
    number = F.when(place.between(F.col("_first"), F.col("_last")), F.col("_start") + position + 1)
    return found.select(
        number.otherwise(moved.cast("long")).cast("long").alias(id_col), *(F.col(f"`{c}`") for c in df.columns)
    )
