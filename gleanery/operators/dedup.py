"""One row per key out of repeated observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.scale import BROADCAST_BYTES, text_size, written


def keep_latest(
    df: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str]
) -> DataFrame:
    """The row with the greatest `newest` per key; an unknown one counts as greatest.

    `tie_break` columns, greatest first, settle equal times. Catalyst keeps
    one row per key and input partition before the shuffle, so the observations
    of a hot key never meet in one task.
    """
    latest_first = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_first() for c in (newest, *tie_break)]
    )
    return (
        df.withColumn("_rank", F.row_number().over(latest_first))
        .filter("_rank = 1")
        .drop("_rank")
    )


def keep_latest_wide(
    df: DataFrame,
    keys: Sequence[str],
    newest: str,
    tie_break: Sequence[str],
    row_id: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    check: bool = True,
) -> DataFrame:
    """`keep_latest` for wide rows: the choice is made on the narrow columns alone.

    `row_id` must be unique and known, which is checked unless told not to; it
    settles what the other columns leave open. When the ids of the
    superseded rows, measured, are small enough, they are broadcast and the
    wide rows are filtered where they lie, otherwise the wide rows are
    shuffled once, by `row_id`.
    """
    narrow = df.select(*dict.fromkeys([*keys, newest, *tie_break, row_id]))
    latest = keep_latest(narrow, keys, newest, list(dict.fromkeys([*tie_break, row_id])))
    kept = written(latest.select(row_id), "latest")
    if check:
        found = narrow.agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct(row_id).alias("ids")
        ).first()
        if found.ids != found.rows:
            raise ValueError(f"{row_id} does not identify the rows: {found.ids} of {found.rows}")
    superseded = written(narrow.select(row_id).join(kept, row_id, "left_anti"), "superseded")
    if text_size(superseded) > broadcast_bytes:
        return df.join(kept, row_id, "left_semi").select(*df.columns)
    return df.join(F.broadcast(superseded), row_id, "left_anti").select(*df.columns)


def undecided_keys(
    df: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str]
) -> DataFrame:
    """Keys whose latest row the columns leave open, with the rows that tie.

    Ties are counted before the choice, so that many of them cost one row.
    """
    ties = df.groupBy(*keys, newest, *tie_break).agg(F.count(F.lit(1)).alias("rows"))
    latest = keep_latest(ties, keys, newest, tie_break)
    return latest.filter("rows > 1").select(*keys, newest, *tie_break, "rows")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()
