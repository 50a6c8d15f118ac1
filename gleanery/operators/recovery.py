"""Empty packed lists filled from the terms found in a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.packed import EMPTY_LIST, pack
from gleanery.functions.text import WORD, WORD_OR_UNDERSCORE, last_characters
from gleanery.operators.matching import PLAN_TERMS, attach_matches
from gleanery.scale import BROADCAST_BYTES


def _is_empty(packed: str) -> Column:
    return F.col(packed) == EMPTY_LIST


def recovery_summary(
    df: DataFrame,
    text: str,
    packed: str,
    vocab: DataFrame,
    key: str,
    word: str = WORD,
    max_terms: int = PLAN_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Records with an empty list, by whether any term is found; records without one count too."""
    found = attach_matches(
        df.filter(_is_empty(packed)).select(key, text), text, vocab, key,
        word=word, max_terms=max_terms, broadcast_bytes=broadcast_bytes,
    )
    return found.agg(
        F.count(F.lit(1)).alias("total_empty"),
        F.count_if(F.size("matches") > 0).alias("with_found_terms"),
        F.count_if(F.size("matches") == 0).alias("without_found_terms"),
    )


def match_preview(
    df: DataFrame,
    text: str,
    packed: str,
    vocab: DataFrame,
    key: str,
    title: str,
    min_terms: int = 2,
    word: str = WORD_OR_UNDERSCORE,
    suffix: int = 10,
) -> DataFrame:
    """Records with an empty list and at least `min_terms` terms, with the standard names found."""
    where = _is_empty(packed) & F.col(text).isNotNull() & (F.trim(text) != "")
    found = attach_matches(df.filter(where).select(key, title, text), text, vocab, key, word=word)
    names = F.array_sort(F.array_distinct(F.col("matches.standard_name")))
    return found.filter(F.size("matches") >= min_terms).select(
        last_characters(key, suffix).alias(key),
        title,
        F.size("matches").cast("long").alias("term_count"),
        F.array_join(names, ", ").alias("terms"),
    )


def recovered_lists(
    df: DataFrame, text: str, packed: str, vocab: DataFrame, key: str, title: str, word: str = WORD
) -> DataFrame:
    """The lists that would be filled in, for records with an empty list and any term."""
    found = attach_matches(
        df.filter(_is_empty(packed)).select(key, title, text), text, vocab, key, word=word
    )
    return found.filter(F.size("matches") > 0).select(
        key, title, pack("matches.source_name").alias("recovered")
    )


def recover(
    df: DataFrame,
    text: str,
    packed: str,
    vocab: DataFrame,
    key: str,
    word: str = WORD,
    max_terms: int = PLAN_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`df` with empty lists filled where terms are found; every other row stays as it is."""
    found = attach_matches(
        df, text, vocab, key,
        where=_is_empty(packed), word=word, max_terms=max_terms, broadcast_bytes=broadcast_bytes,
    )
    filled = F.when(F.size("matches") > 0, pack("matches.source_name"))
    return found.withColumn(packed, F.coalesce(filled, packed)).select(*df.columns)
