"""Column functions on packed lists, such as "['sql', 'r']"; "[]" stands for none."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import col, strip_characters

# Fixed value: the text that stands for an empty list.
EMPTY_LIST = "[]"


def inspect_tokens(packed: str | Column) -> Column:
    """Array for looking at a vocabulary: split at every comma, quotes removed,
    brackets and spaces stripped."""
    parts = F.split(F.replace(col(packed), F.lit("'"), F.lit("")), ",")
    return F.transform(parts, lambda part: strip_characters(part, "[] "))


def unwrap(packed: str | Column) -> Column:
    """List text without its brackets; NULL for the empty list."""
    return strip_characters(F.nullif(col(packed), F.lit(EMPTY_LIST)), "[]")


def list_tokens(unwrapped: str | Column) -> Column:
    """Array for storing: unwrapped text split at comma and space, single quotes stripped."""
    value = col(unwrapped)
    parts = F.when(value == "", F.array().cast("array<string>")).otherwise(F.split(value, ", "))
    return F.transform(parts, lambda part: strip_characters(part, "'"))


def pack(tokens: str | Column) -> Column:
    """List text of an array; "[]" if it is empty."""
    quoted = F.transform(col(tokens), lambda token: F.concat(F.lit("'"), token, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
