"""Columns rewritten in place, as projections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.functions.packed import unwrap
from gleanery.functions.text import fold_case, trim_blanks, trim_spaces
from gleanery.scale import BROADCAST_BYTES, lookup_join


def trimmed(df: DataFrame, *columns: str, unicode: bool = False) -> DataFrame:
    """Columns without spaces at either end, NULLs kept; `unicode` takes any white space."""
    trim = trim_blanks if unicode else trim_spaces
    return df.withColumns({c: trim(c) for c in columns})


def case_folded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: fold_case(c) for c in columns})


def unwrapped(df: DataFrame, packed: str) -> DataFrame:
    """Packed lists without brackets, NULL for the empty list."""
    return df.withColumn(packed, unwrap(packed))


def updated_from(
    df: DataFrame,
    updates: DataFrame,
    key: str,
    columns: Sequence[str],
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Columns overwritten where `updates` has the key; other rows keep their values.

    `updates` must have one row per key, which is checked; its rows with a NULL
    key meet no row and may repeat. A matching NULL overwrites.
    """
    known = updates.filter(F.col(key).isNotNull())
    repeated = known.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if found := repeated.limit(3).collect():
        named = ", ".join(str(row[0]) for row in found)
        raise ValueError(f"several updates for the same {key}: {named}")
    new = updates.select(key, F.struct(*columns).alias("_new"))
    joined = lookup_join(df, new, key, "left", broadcast_bytes=broadcast_bytes)
    chosen = {
        c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c))
        for c in columns
    }
    return joined.withColumns(chosen).select(*df.columns)
