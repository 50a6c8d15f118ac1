"""Column functions that read typed values out of text; NULL where the text does not fit."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery.functions.text import col

# Texts read as true and as false, in any case.
TRUE_TEXTS = ("t", "tr", "tru", "true", "y", "ye", "yes", "on", "1")
FALSE_TEXTS = ("f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0")

# An unbounded decimal has no Spark type: 38 digits, 10 of them after the point.
NUMERIC = "decimal(38,10)"


def to_boolean(value: str | Column) -> Column:
    text = F.lower(F.btrim(col(value), F.lit(" \t\n\r\f\x0b")))
    return F.when(text.isin(*TRUE_TEXTS), F.lit(True)).when(
        text.isin(*FALSE_TEXTS), F.lit(False)
    )


def _digits_lost(text: Column, scale: int) -> Column:
    """Whether a decimal number has digits other than 0 beyond `scale` places after the point."""
    number = r"^\s*[+-]?(\d*?)(0*)(?:\.(\d*?)0*)?(?:[eE]([+-]?\d+))?\s*$"
    places, zeros = F.length(F.regexp_extract(text, number, 3)), F.length(
        F.regexp_extract(text, number, 2)
    )
    power = F.coalesce(F.regexp_extract(text, number, 4).try_cast("int"), F.lit(0))
    return F.when(places > 0, places).otherwise(-zeros) - power > scale


def read_as(value: str | Column, kind: str) -> Column:
    """Value as `kind`: boolean, timestamp, numeric or any Spark type name.

    A number with more digits after the point than a decimal type holds does
    not fit; it is not rounded.
    """
    if kind == "boolean":
        return to_boolean(value)
    spark_type = {"timestamp": "timestamp_ntz", "numeric": NUMERIC}.get(kind, kind)
    read = col(value).try_cast(spark_type)
    if decimal := re.fullmatch(r"(?:decimal|numeric)\(\s*\d+\s*(?:,\s*(\d+)\s*)?\)", spark_type):
        text = col(value).cast("string")
        scale = int(decimal[1] or 0)
        # Without a power a text no longer than the places after the point cannot have too many.
        short = (F.length(text) <= scale) & ~F.contains(F.lower(text), F.lit("e"))
        return F.when(short | ~_digits_lost(text, scale), read)
    return read
