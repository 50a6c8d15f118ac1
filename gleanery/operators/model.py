"""Dimension, fact and junction tables out of one cleaned wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.packed import EMPTY_LIST
from gleanery.operators.vocabulary import mapped_tokens
from gleanery.scale import BROADCAST_BYTES, contiguous_ids, lookup_join


def extract_dimension(df: DataFrame, value: str, id_col: str) -> DataFrame:
    """Distinct values, NULL among them, numbered 1..n in binary order with NULL last."""
    return contiguous_ids(df.select(value).distinct(), [value], id_col)


def high_water(stored: DataFrame, id_col: str) -> int:
    """The greatest id given so far, 0 in an empty table."""
    return stored.agg(F.max(id_col)).first()[0] or 0


def new_dimension_rows(stored: DataFrame, df: DataFrame, value: str, id_col: str) -> DataFrame:
    """Values of `df` that a stored dimension lacks, NULL like any other, numbered on from it.

    Ids that were given stay. The new values are compared with the stored ones
    after duplicates are gone, and only they are sorted.
    """
    known = stored.select(F.col(value).alias("_known"))
    values = df.select(value).distinct()
    new = values.join(known, F.col(value).eqNullSafe(F.col("_known")), "left_anti")
    return contiguous_ids(new, [value], id_col, high_water(stored, id_col))


def attach_dimension(
    df: DataFrame,
    dimension: DataFrame,
    value: str,
    spread_by: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`df` with the id of its value; rows without a match, and NULLs, get NULL.

    Rows of a hot value are told apart by `spread_by` if the dimension is large.
    """
    return lookup_join(df, dimension, value, "left", spread_by, broadcast_bytes)


def fact_table(linked: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """Columns of the rows that found their dimension row."""
    return linked.filter(F.col(id_col).isNotNull()).select(*columns)


def unmatched_rows(linked: DataFrame, id_col: str) -> DataFrame:
    """Rows that found no dimension row and so are not in the fact table."""
    return linked.agg(F.count_if(F.col(id_col).isNull()).alias("unmatched_rows"))


def left_out(records: DataFrame, facts: DataFrame) -> DataFrame:
    """The same from stored tables, whose sizes are known without linking the rows again."""
    sizes = [_summary(table, rows=F.count(F.lit(1))).getField("rows") for table in (records, facts)]
    return records.sparkSession.range(1).select((sizes[0] - sizes[1]).alias("unmatched_rows"))


def junction_table(
    df: DataFrame,
    key: str,
    packed: str,
    vocab: DataFrame,
    id_col: str,
    name: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per record and standard name of its packed list, numbered by both."""
    pairs = (
        mapped_tokens(df, key, packed, vocab, broadcast_bytes)
        .select(key, F.col("standard_name").alias(name))
        .distinct()
    )
    return contiguous_ids(pairs, [key, name], id_col)


def _summary(df: DataFrame, **measures: Column) -> Column:
    """All measures of a table as one scalar, from one pass."""
    return df.agg(F.struct(*[value.alias(name) for name, value in measures.items()])).scalar()


def model_counts(
    facts: DataFrame, dimension: DataFrame, junction: DataFrame, key: str, id_col: str, name: str
) -> DataFrame:
    """One row with the sizes and distinct keys of the three tables."""
    rows = F.count(F.lit(1))
    fact = _summary(facts, rows=rows, keys=F.countDistinct(key))
    dim = _summary(dimension, rows=rows, ids=F.countDistinct(id_col))
    pair = _summary(junction, rows=rows, keys=F.countDistinct(key), names=F.countDistinct(name))
    return facts.sparkSession.range(1).select(
        fact.getField("rows").alias("total_facts"),
        fact.getField("keys").alias("unique_fact_keys"),
        dim.getField("rows").alias("total_dimension_rows"),
        dim.getField("ids").alias("unique_dimension_ids"),
        pair.getField("rows").alias("total_junction_rows"),
        pair.getField("keys").alias("records_with_terms"),
        pair.getField("names").alias("unique_terms"),
    )


def coverage_balance(
    recovered: DataFrame, junction: DataFrame, key: str, packed: str
) -> DataFrame:
    """Whether records with terms and records with an empty list add up to all records."""
    records = _summary(
        recovered, total=F.count(F.lit(1)), empty=F.count_if(F.col(packed) == EMPTY_LIST)
    )
    total, empty = records.getField("total"), records.getField("empty")
    held = _summary(junction, keys=F.countDistinct(key)).getField("keys")
    return recovered.sparkSession.range(1).select(
        total.alias("total_records"),
        held.alias("records_with_terms"),
        empty.alias("records_with_empty_list"),
        (held + empty == total).alias("balanced"),
    )
