"""Parquet tables, literal tables, samples and reports on their columns."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gleanery.functions.text import is_missing


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer parts than there are cores, dealt out evenly; larger ones as they are.

    For work that is heavy per row on a table as it comes from its files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def save_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Table written anew and read back, so that later stages start from files."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def create_table(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """Typed table without rows."""
    return save_table(spark.createDataFrame([], schema), folder, name)


def append_rows(df: DataFrame, folder: str, name: str) -> None:
    df.write.mode("append").parquet(f"{folder.rstrip('/')}/{name}.parquet")


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Small table written out in the program, such as an alias list.

    It goes through Arrow and so becomes a local relation, whose size Catalyst knows.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns)).to(StructType.fromDDL(schema))


def in_order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows by columns, descending where the name starts with "-".

    An unknown value counts as the greatest: last going up, first going down.
    """
    return df.orderBy(
        *[
            F.col(c[1:]).desc_nulls_first() if c.startswith("-") else F.col(c).asc_nulls_last()
            for c in columns
        ]
    )


def sample_rows(df: DataFrame, n: int = 10, order_by: Sequence[str] = ()) -> DataFrame:
    """A few rows to look at: any, or the first in an order."""
    return (in_order(df, *order_by) if order_by else df).limit(n)


def schema_report(df: DataFrame) -> DataFrame:
    """Name and type of each column by position, with its filled and missing rows.

    All counts come from one scan; text counts as missing when empty.
    """
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.count_if(
                is_missing(f"`{f.name}`")
                if f.dataType.typeName() == "string"
                else F.col(f"`{f.name}`").isNull()
            ).alias(f"m{i}")
            for i, f in enumerate(fields)
        ],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("long").alias("ordinal_position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                (F.col("rows") - F.col(f"m{i}")).alias("filled_rows"),
                F.col(f"m{i}").alias("missing_rows"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counts.select(F.inline(lines))
