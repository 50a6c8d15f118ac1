"""Text columns turned into typed ones, strictly or with the misfits set aside."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.typing import read_as
from gleanery.scale import computed_once


def _read(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """`df` with `_read`, the values of all columns to be typed, each text read once."""
    values = F.struct(*[read_as(c, kind).alias(c) for c, kind in kinds.items()])
    return computed_once(df, "_read", values)


def _value(column: str) -> Column:
    return F.col("_read").getField(column)


def _misfit(column: str) -> Column:
    return F.col(f"`{column}`").isNotNull() & _value(column).isNull()


def _misfits(kinds: Mapping[str, str]) -> Column:
    """Names of the columns whose text does not fit."""
    names = F.array(*[F.when(_misfit(c), F.lit(c)) for c in kinds])
    return F.array_except(names, F.array(F.lit(None).cast("string")))


def _columns(df: DataFrame, changed: Mapping[str, Column]) -> list[Column]:
    kept = [changed[c].alias(c) if c in changed else F.col(f"`{c}`") for c in df.columns]
    return kept + [value.alias(c) for c, value in changed.items() if c not in df.columns]


def typed(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    """Columns read as the given kinds; a text that does not fit fails the job."""
    def strict(column: str, kind: str) -> Column:
        message = F.concat(F.lit(f"{column} is not {kind}: "), F.col(f"`{column}`"))
        return F.when(_misfit(column), F.raise_error(message)).otherwise(_value(column))

    if not kinds:
        return df
    return _read(df, kinds).select(*_columns(df, {c: strict(c, kind) for c, kind in kinds.items()}))


def typed_or_null(
    df: DataFrame, kinds: Mapping[str, str], errors: str = "cast_errors"
) -> DataFrame:
    """Columns read as the given kinds, NULL where they do not fit, and the names of those."""
    read = {c: _value(c) for c in kinds}
    return _read(df, kinds).select(*_columns(df, {**read, errors: _misfits(kinds)}))


def quarantine(df: DataFrame, kinds: Mapping[str, str], errors: str = "cast_errors") -> DataFrame:
    """Rows with a text that does not fit, unchanged, and the names of the columns."""
    found = computed_once(_read(df, kinds), "_errors", _misfits(kinds)).filter(F.size("_errors") > 0)
    return found.select(*_columns(df, {errors: F.col("_errors")}))
