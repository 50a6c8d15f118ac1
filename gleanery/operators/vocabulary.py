"""The controlled vocabulary: source names and the standard names they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.packed import EMPTY_LIST, inspect_tokens, list_tokens, unwrap
from gleanery.functions.text import WORD, boundary_class, boundary_pattern
from gleanery.operators.checks import not_null, primary_key, require
from gleanery.scale import BROADCAST_BYTES, exploded, lookup_join
from gleanery.sources.tables import literal_table

VOCABULARY_SCHEMA = "source_name string, standard_name string"

# The published sample of the alias list.
SAMPLE_ALIASES = (
    ("postgres", "PostgreSQL"),
    ("postgresql", "PostgreSQL"),
    ("mongo", "MongoDB"),
    ("mongodb", "MongoDB"),
    ("js", "JavaScript"),
    ("javascript", "JavaScript"),
    ("node", "Node.js"),
    ("node.js", "Node.js"),
    ("no-sql", "NoSQL"),
    ("nosql", "NoSQL"),
)


def vocabulary(spark: SparkSession, aliases=SAMPLE_ALIASES) -> DataFrame:
    """Alias table written out in the program, held to the same rules."""
    names = [source for source, _ in aliases]
    if len(set(names)) < len(names) or any(None in row for row in aliases):
        raise ValueError("vocabulary: source names must be unique and no name may be missing")
    return literal_table(spark, aliases, VOCABULARY_SCHEMA)


def checked_vocabulary(aliases: DataFrame) -> DataFrame:
    """Alias table from anywhere; fails unless source names are unique and no name is NULL."""
    table = aliases.select("source_name", "standard_name")
    require(
        primary_key(table, "vocabulary", ["source_name"]).unionByName(
            not_null(table, "vocabulary", ["standard_name"])
        )
    )
    return table


def inspect_vocabulary(df: DataFrame, packed: str, name: str = "token") -> DataFrame:
    """Distinct tokens of all packed lists but the empty ones."""
    listed = df.filter(F.col(packed) != EMPTY_LIST)
    return exploded(listed, F.array_distinct(inspect_tokens(packed)), name).distinct()


def stored_tokens(df: DataFrame, key: str, packed: str) -> DataFrame:
    """One row per record and distinct token of its packed list, as `source_name`."""
    tokens = F.array_distinct(list_tokens(unwrap(packed)))
    return exploded(df, tokens, "source_name", key)


def mapped_tokens(
    df: DataFrame,
    key: str,
    packed: str,
    vocab: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Tokens with their standard names; spelling must agree exactly, others are left out."""
    return lookup_join(
        stored_tokens(df, key, packed), vocab, "source_name", "inner", [key], broadcast_bytes
    )


def unmapped_tokens(
    df: DataFrame,
    key: str,
    packed: str,
    vocab: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Tokens the vocabulary does not know, with the records that hold them."""
    counts = (
        stored_tokens(df, key, packed)
        .groupBy("source_name")
        .agg(F.count(F.lit(1)).alias("records"))
    )
    return lookup_join(
        counts, vocab, "source_name", "left_anti", broadcast_bytes=broadcast_bytes
    )


def word_runs(term: str, word: str = WORD) -> Column:
    """The runs of word characters of a lower-cased term."""
    return F.filter(F.split(term, f"{boundary_class(word)}+"), lambda run: run != "")


def longest(pieces: Column) -> Column:
    """The first of the longest pieces, "" if there is none."""
    return F.reduce(
        pieces,
        F.lit(""),
        lambda best, piece: F.when(F.length(piece) > F.length(best), piece).otherwise(best),
    )


def with_rarest(
    terms: DataFrame, pieces: Column, anchor: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """`terms` with the piece that the fewest terms share as `anchor`; as it was without pieces.

    Keeps terms with a piece in common from all being candidates wherever it occurs.
    """
    each = exploded(terms, F.array_distinct(pieces), "piece", "source_name")
    shared = each.groupBy("piece").agg(F.count(F.lit(1)).alias("terms"))
    order = F.struct("terms", -F.length("piece"), "piece")
    counted = lookup_join(each, shared, "piece", "inner", ["source_name"], broadcast_bytes)
    rarest = counted.groupBy("source_name").agg(F.min_by("piece", order).alias("rarest"))
    return (
        terms.join(rarest, "source_name", "left")
        .withColumn(anchor, F.coalesce("rarest", anchor))
        .drop("rarest")
    )


def search_terms(vocab: DataFrame, word: str = WORD) -> DataFrame:
    """Vocabulary ready for matching.

    term: the source name in lower case. anchor: a piece of the term that is a
    whole word of any text the term matches (its longest run of word
    characters), or its first character if it is wordless. plain: the anchor
    is the whole term, so finding the anchor is the match. pattern: the
    boundary-aware regular expression.
    """
    return (
        vocab.filter(F.col("source_name") != "")
        .withColumn("term", F.lower("source_name"))
        .withColumn("longest", longest(word_runs("term", word)))
        .withColumn("wordless", F.col("longest") == "")
        .withColumn(
            "anchor",
            F.when(F.col("wordless"), F.left("term", F.lit(1))).otherwise(F.col("longest")),
        )
        .withColumn("plain", F.col("longest") == F.col("term"))
        .withColumn("pattern", boundary_pattern("source_name", word))
        .drop("longest")
    )
