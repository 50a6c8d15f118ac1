"""Tables that grow by deliveries, each checked and committed as a whole, and updates of
only those files that hold changed rows.

A delivery is a folder within the table, named in its path as Spark names partitions.
It is written beside the others under a name that readers pass over, checked there
against the keys already stored, and renamed in one step. What is committed is never
touched again, so a run that is repeated finds its delivery there and changes nothing.
On stores without an atomic rename of folders the step is as safe as their rename.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from gleanery.operators import checks
from gleanery.scale import lookup_join, written

DELIVERY = "_delivery"
BUCKET = "_bucket"


def _path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def read_deliveries(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """The rows of all committed deliveries; a table without any is empty."""
    path = _path(folder, name)
    files, place = _files(spark, path)
    if not files.exists(place) or not files.globStatus(_files(spark, f"{path}/{DELIVERY}=*")[1]):
        return spark.createDataFrame([], schema)
    whole = StructType([*schema.fields, StructField(DELIVERY, StringType())])
    # The folders begin with what readers pass over, so they are named one by one.
    return spark.read.schema(whole).option("basePath", path).parquet(f"{path}/{DELIVERY}=*").drop(DELIVERY)


def violations(
    new: DataFrame,
    stored: DataFrame,
    table: str,
    key: Sequence[str],
    required: Sequence[str] = (),
    references: Mapping[str, tuple[DataFrame, str]] = {},
) -> DataFrame:
    """What rows to be appended would break: one line per constraint with the rows that do.

    STORED KEY counts new rows whose key the table has already. Stored keys are
    compared with the distinct new ones; a key is never NULL.
    """
    keys = new.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    known = stored.select(*key).join(keys.select(*key), list(key), "left_semi").distinct()
    taken = keys.join(known, list(key), "left_semi").agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n"))
    lines = [
        checks.primary_key(new, table, key),
        taken.select(
            F.lit(table).alias("table_name"),
            F.lit("STORED KEY").alias("kind"),
            F.lit(", ".join(key)).alias("columns"),
            F.col("n").alias("violations"),
        ),
    ]
    if required:
        lines.append(checks.not_nulls(new, table, [[c] for c in required]))
    for column, (parent, parent_key) in references.items():
        lines.append(checks.foreign_key(new, parent, table, column, parent_key))
    return checks.report(*lines)


def append_checked(
    df: DataFrame,
    folder: str,
    name: str,
    delivery: str,
    key: Sequence[str],
    required: Sequence[str] = (),
    references: Mapping[str, tuple[DataFrame, str]] = {},
) -> bool:
    """Appends `df` as `delivery` if it breaks no constraint; False if that delivery is there already.

    Raises ValueError with the broken constraints otherwise, and leaves the
    table as it was. Rows are checked as written, so what is committed is what
    was checked. Deliveries of one table are to come one at a time.
    """
    if not re.fullmatch(r"[A-Za-z0-9-]+", delivery):
        raise ValueError(f"the name of a delivery has letters, digits and hyphens only: {delivery!r}")
    spark, path = df.sparkSession, _path(folder, name)
    files, target = _files(spark, f"{path}/{DELIVERY}={delivery}")
    if files.exists(target):
        return False
    staged_path = f"{path}/_staged-{delivery}"
    staged = _files(spark, staged_path)[1]
    df.write.mode("overwrite").parquet(staged_path)
    try:
        new = spark.read.schema(df.schema).parquet(staged_path)
        stored = read_deliveries(spark, folder, name, df.schema)
        checks.require(violations(new, stored, name, key, required, references))
        if not files.rename(staged, target):
            raise OSError(f"{staged_path} could not be renamed")
    finally:
        files.delete(staged, True)
    return True


def save_bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> DataFrame:
    """A table in one folder per hash bucket of its key, for updates that touch few of them."""
    spread = df.withColumn(BUCKET, _bucket(key, buckets)).repartition(buckets, BUCKET)
    spread.write.mode("overwrite").partitionBy(BUCKET).parquet(_path(folder, name))
    return read_bucketed(df.sparkSession, folder, name, df.schema)


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_bucketed(
    spark: SparkSession, folder: str, name: str, schema: StructType, only: Sequence[int] | None = None
) -> DataFrame:
    path = _path(folder, name)
    whole = StructType([*schema.fields, StructField(BUCKET, IntegerType())])
    rows = spark.read.schema(whole).option("basePath", path).parquet(f"{path}/{BUCKET}=*")
    return (rows if only is None else rows.filter(F.col(BUCKET).isin(list(only)))).drop(BUCKET)


def update_touched(
    changes: DataFrame, folder: str, name: str, schema: StructType, key: str, buckets: int
) -> list[int]:
    """Gives rows of a bucketed table the values that `changes` has for their key; the buckets rewritten.

    `changes` has `key`, once each, and the columns to replace. Keys that the
    table lacks change nothing, and a bucket without changes is neither read
    nor written. The new buckets are written aside before they replace the old
    ones, and an update that is repeated gives the same rows.
    """
    spark = changes.sparkSession
    checks.require(checks.primary_key(changes, name, [key]))
    values = [c for c in changes.columns if c != key]
    named = written(changes.select(key, F.struct(*values).alias("_new")), "changes")
    # As many at most as there are buckets.
    hit = sorted(r[0] for r in named.select(_bucket(key, buckets)).distinct().collect())
    if not hit:
        return []
    old = read_bucketed(spark, folder, name, schema, hit)
    joined = lookup_join(old, named, key, "left", [key])
    new = [
        F.when(F.col("_new").isNotNull(), F.col(f"_new.`{f.name}`")).otherwise(F.col(f.name)).alias(f.name)
        if f.name in values
        else F.col(f.name)
        for f in schema.fields
    ]
    ready = written(joined.select(*new, _bucket(key, buckets).alias(BUCKET)), "buckets")
    (
        ready.repartition(len(hit), BUCKET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BUCKET)
        .parquet(_path(folder, name))
    )
    return hit
