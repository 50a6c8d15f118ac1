"""Constraints as reports: one row per constraint with the number of violations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _line(violations: DataFrame, table: str, kind: str, columns: Sequence[str]) -> DataFrame:
    """`violations` is one row with the number as `n`."""
    return violations.select(
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("kind"),
        F.lit(", ".join(columns)).alias("columns"),
        F.col("n").cast("long").alias("violations"),
    )


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def _repeated_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    found = df.agg(F.count_if(_any_null(columns)).alias("n"))
    return _line(found, table, "NOT NULL", columns)


def not_nulls(df: DataFrame, table: str, groups: Sequence[Sequence[str]]) -> DataFrame:
    """`not_null` for several groups of columns in one scan."""
    counts = df.agg(*[F.count_if(_any_null(g)).alias(f"n{i}") for i, g in enumerate(groups)])
    lines = F.array(
        *[
            F.struct(F.lit(", ".join(g)).alias("columns"), F.col(f"n{i}").alias("violations"))
            for i, g in enumerate(groups)
        ]
    )
    return counts.select(F.inline(lines)).select(
        F.lit(table).alias("table_name"), F.lit("NOT NULL").alias("kind"), "columns", "violations"
    )


def unique(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Groups of rows that share a value; rows with a NULL are exempt."""
    known = df.filter(~_any_null(columns))
    found = _repeated_groups(known, columns).agg(F.count(F.lit(1)).alias("n"))
    return _line(found, table, "UNIQUE", columns)


def primary_key(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in the key and groups of rows that share a key."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    found = groups.agg(
        F.coalesce(
            F.sum(
                F.when(_any_null(columns), F.col("rows")).otherwise((F.col("rows") > 1).cast("int"))
            ),
            F.lit(0),
        ).alias("n")
    )
    return _line(found, table, "PRIMARY KEY", columns)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    child_key: str,
    parent_key: str,
) -> DataFrame:
    """Keys of `child` that `parent` lacks, with the rows that hold them; NULL refers to nothing.

    Rows are counted per key before the join, and the keys of `parent` made
    distinct, so a hot key joins as one row on either side.
    """
    held = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(parent_key).alias("key")).distinct()
    return held.join(known, "key", "left_anti")


def foreign_key(
    child: DataFrame,
    parent: DataFrame,
    table: str,
    child_key: str,
    parent_key: str,
) -> DataFrame:
    """Rows of `child` whose key `parent` lacks."""
    lost = orphans(child, parent, child_key, parent_key)
    found = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
    return _line(found, table, "FOREIGN KEY", [child_key])


def report(*lines: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, lines)


def require(lines: DataFrame) -> None:
    """Fails if any constraint of a report is violated."""
    broken = [
        f"{row.table_name} {row.kind} ({row['columns']}): {row.violations}"
        for row in lines.filter("violations > 0").collect()
    ]
    if broken:
        raise ValueError("constraints violated: " + "; ".join(broken))
