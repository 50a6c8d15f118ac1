"""Profiles of a table before it is changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DoubleType,
    FloatType,
    MapType,
    StructType,
    TimestampType,
)

from gleanery.functions.text import (
    col,
    differs,
    fold_case,
    format_class,
    is_missing,
    last_characters,
)


def row_count() -> Column:
    return F.count(F.lit(1))


def repeat_baseline(df: DataFrame, key: str) -> DataFrame:
    """Rows with a key, distinct keys and surplus rows."""
    return df.agg(
        F.count(key).alias("total_rows"),
        F.countDistinct(key).alias("unique_keys"),
        (row_count() - F.countDistinct(key)).alias("surplus_rows"),
    )


#: Size of a sketch as a power of two, and what its estimate may be off by (three standard errors).
SKETCH_BITS = 14
SKETCH_ERROR = 3 * 0.83 / 2 ** (SKETCH_BITS / 2)


def key_sketches(df: DataFrame, key: str, part: str) -> DataFrame:
    """Per part of a table its rows and a sketch of its distinct keys, to be stored and united.

    A sketch is a few kilobytes whatever the number of keys, so distinct counts
    of new parts cost a scan of those parts only.
    """
    return df.groupBy(part).agg(
        row_count().alias("rows"), F.hll_sketch_agg(key, SKETCH_BITS).alias("sketch")
    )


def united_sketch(sketches: DataFrame) -> DataFrame:
    """Rows and sketch of all parts together: the sketch that one of all rows would be."""
    return sketches.agg(F.sum("rows").alias("total_rows"), F.hll_union_agg("sketch").alias("sketch"))


def repeat_estimate(sketches: DataFrame) -> DataFrame:
    """`repeat_baseline` from sketches, its keys off by SKETCH_ERROR at most in 997 of 1000 cases."""
    keys = F.hll_sketch_estimate("sketch")
    return united_sketch(sketches).select(
        "total_rows", keys.alias("unique_keys"), (F.col("total_rows") - keys).alias("surplus_rows")
    )


def uniqueness(df: DataFrame, **columns: str) -> DataFrame:
    """Row count and one distinct count per `name=column`, in one pass."""
    return df.agg(
        row_count().alias("total_rows"),
        *[F.countDistinct(column).alias(name) for name, column in columns.items()],
    )


def missing_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where any of `columns` is NULL or empty."""
    return df.filter(reduce(lambda a, b: a | b, [is_missing(c) for c in columns]))


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(is_missing(c)).alias(f"missing_{c}") for c in columns])


def lossless(value: Column, kind: DataType) -> Column:
    """A value as texts that are equal for equal values only; NULL stays NULL.

    Times are counted in microseconds, the two zeros of floating point are one
    value, as are all its NaNs, and maps are put in the order of their keys.
    """
    if isinstance(kind, StructType):
        fields = [lossless(value.getField(f.name), f.dataType).alias(f"f{n}") for n, f in enumerate(kind)]
        return F.when(value.isNotNull(), F.struct(*fields)) if fields else value.cast("string")
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: lossless(x, kind.elementType))
    if isinstance(kind, MapType):
        def entry(e: Column) -> Column:
            return F.struct(
                lossless(e["key"], kind.keyType).alias("k"),
                lossless(e["value"], kind.valueType).alias("v"),
            )

        return F.array_sort(F.transform(F.map_entries(value), entry))
    if isinstance(kind, BinaryType):
        return F.hex(value)
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, (DoubleType, FloatType)):
        return (value + F.lit(0.0).cast(kind)).cast("string")
    return value.cast("string")


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of all values; NULLs are equal to each other and to nothing else."""
    values = [
        lossless(F.col(f"`{c}`"), df.schema[c].dataType).alias(f"c{n}") for n, c in enumerate(columns)
    ]
    return F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)


def exact_duplicates(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Groups of rows alike in every column but `exclude`, and the rows beyond the first of each.

    Wide rows are compared by digest: the shuffle carries one digest and count
    per distinct row and input partition, however wide the rows or large the
    groups.
    """
    columns = [c for c in df.columns if c not in set(exclude)]
    copies = df.groupBy(row_digest(df, columns).alias("digest")).agg(row_count().alias("copies"))
    return copies.filter("copies > 1").agg(
        row_count().alias("duplicate_groups"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus_rows"),
    )


def value_frequency(
    df: DataFrame, value: str | Column, name: str, count: str = "rows", min_rows: int = 1
) -> DataFrame:
    """Rows per value, for values with at least `min_rows`."""
    return df.groupBy(col(value).alias(name)).agg(row_count().alias(count)).filter(
        F.col(count) >= min_rows
    )


def repeat_span(df: DataFrame, key: str, time: str) -> DataFrame:
    """Keys seen more than once, with how often, first and last time."""
    return (
        df.groupBy(key)
        .agg(
            row_count().alias("repeated_count"),
            F.min(time).alias("first_seen"),
            F.max(time).alias("last_seen"),
        )
        .filter("repeated_count > 1")
    )


def format_classes(df: DataFrame, value: str) -> DataFrame:
    """Rows per formatting condition of a text column."""
    return df.groupBy(format_class(value).alias("format_issue")).agg(row_count().alias("rows"))


def residual_rows(df: DataFrame, **cleaned: tuple[str, Column]) -> DataFrame:
    """Rows a cleaning would still change, per `name=(column, cleaned column)`."""
    return df.agg(
        *[F.count_if(differs(value, clean)).alias(name) for name, (value, clean) in cleaned.items()]
    )


def case_variants(df: DataFrame, value: str) -> DataFrame:
    """Folded values that stand for more than one spelling.

    Spellings are made distinct before the second shuffle, so a spelling held
    by a large part of the rows counts as one row there.
    """
    return (
        df.groupBy(fold_case(value).alias("normalised"))
        .agg(F.countDistinct(value).alias("variants"))
        .filter("variants > 1")
    )


def case_variant_list(df: DataFrame, value: str, separator: str = " | ") -> DataFrame:
    """The spellings of each folded value that has several, in binary order."""
    spellings = df.select(fold_case(value).alias("normalised"), F.col(value).alias("v")).distinct()
    return (
        spellings.groupBy("normalised")
        .agg(F.array_sort(F.collect_list("v")).alias("vs"))
        .filter(F.size("vs") > 1)
        .select("normalised", F.array_join("vs", separator).alias("variations"))
    )


def list_counts(df: DataFrame, packed: str, empty: str) -> DataFrame:
    """All rows, rows with tokens and rows holding the empty list; NULLs are in neither."""
    return df.agg(
        row_count().alias("total_rows"),
        F.count_if(F.col(packed) != empty).alias("rows_with_tokens"),
        F.count_if(F.col(packed) == empty).alias("rows_without_tokens"),
    )


def empty_list_text_counts(df: DataFrame, packed: str, text: str, empty: str) -> DataFrame:
    """Rows holding the empty list, by whether they have a text to recover from."""
    held = F.col(packed) == empty
    return df.agg(
        F.count_if(held & ~is_missing(text)).alias("empty_with_text"),
        F.count_if(held & is_missing(text)).alias("empty_without_text"),
    )


def duplicate_pairs(df: DataFrame, key: str, value: str, suffix: int = 10) -> DataFrame:
    """Pairs that occur more than once; shows the end of the key, groups by all of it."""
    return (
        df.groupBy(key, value)
        .agg(row_count().alias("occurrences"))
        .filter("occurrences > 1")
        .select(
            last_characters(F.col(key).cast("string"), suffix).alias(key), value, "occurrences"
        )
    )
