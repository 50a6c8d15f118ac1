"""Benchmark passages in documents, found by spaced seeds.

A mask picks some of the words of a stretch and skips the others. Every
stretch of every document and benchmark item is hashed under each mask; equal
hashes are hits, and differences at skipped words do not matter. Around each
hit the words of document and item are compared one by one: a window of
`window` words with at least `similarity` of them equal is an overlap. With
the masks below a window of 20 words always has a hit as long as at most 4 of
its words were replaced.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.scale import BROADCAST_BYTES, computed_once, lookup_join, written

#: Fixed masks, found by search: 1 takes a word, 0 skips it.
MASKS = ("1110011", "101111")

WINDOW = 20
SIMILARITY = 0.8

#: Places of a document whose candidates are cut from its words together.
STRETCH = 1024


def word_codes(text: str | Column) -> Column:
    """Hashes of the words of a text, runs of letters and digits in lower case."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.transform(F.array_remove(words, ""), lambda w: F.xxhash64(w))


def _seeds(codes: str, masks: Sequence[str]) -> Column:
    """Array of (seed, at) over all masks and places of an array of word hashes."""
    words = F.col(codes)

    def under(number: int, mask: str) -> Column:
        places = F.sequence(F.lit(0), F.size(words) - len(mask))
        taken = [n for n, bit in enumerate(mask) if bit == "1"]
        return F.when(
            F.size(words) >= len(mask),
            F.transform(
                places,
                lambda i: F.struct(
                    F.xxhash64(F.lit(number), *[F.get(words, i + n) for n in taken]).alias("seed"),
                    i.alias("at"),
                ),
            ),
        ).otherwise(F.array().cast("array<struct<seed:bigint,at:int>>"))

    return F.concat(*[under(number, mask) for number, mask in enumerate(masks)])


def _known(df: DataFrame, key: str, text: str) -> DataFrame:
    """`doc`, `body` (a hash of the text) and `text` of the rows that have a key and a text."""
    return df.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("doc"), F.xxhash64(text).alias("body"), F.col(text).alias("text")
    )


def _with_codes(known: DataFrame) -> DataFrame:
    return computed_once(known, "codes", word_codes("text")).drop("text")


def _items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """Each benchmark text once: the least `item` that has its words, and how many have them."""
    rows = benchmark.filter(F.col(item).isNotNull() & F.col(text).isNotNull()).select(
        F.col(item).alias("item"), word_codes(text).alias("item_codes")
    )
    return rows.groupBy("item_codes").agg(
        F.min("item").alias("item"), F.count(F.lit(1)).alias("items")
    )


def overlaps(
    df: DataFrame,
    key: str,
    text: str,
    benchmark: DataFrame,
    item: str,
    item_text: str,
    masks: Sequence[str] = MASKS,
    window: int = WINDOW,
    similarity: float = SIMILARITY,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document and benchmark text that overlap: where, and how closely.

    Columns `key`, `item` (the least with that text), `items` (how many have
    it), `doc_word` and `item_word` (where the best window begins), `words`
    (its length) and `equal` (words that agree). An item shorter than the
    window must agree as a whole; one with fewer words than the shortest mask
    is not looked for. NULL keys and texts, empty texts and empty tables give
    no rows. Repeated rows give one.
    """
    items = written(_items(benchmark, item, item_text), "benchmark")
    known = _known(df, key, text)
    docs = _with_codes(known)
    sought = items.select("item", F.inline(_seeds("item_codes", masks))).withColumnRenamed(
        "at", "item_at"
    )
    there = docs.select("doc", "body", F.inline(_seeds("codes", masks)))
    hits = lookup_join(there, sought, "seed", "inner", ["doc", "at"], broadcast_bytes)
    candidates = written(
        hits.groupBy("doc", "body", "item", (F.col("at") - F.col("item_at")).alias("shift")).agg(
            F.collect_set("item_at").alias("hits")
        ),
        "candidates",
    )
    lengths = items.select("item", F.size("item_codes").alias("n"))
    met = (
        _stretches(known, candidates.join(lengths, "item"), broadcast_bytes)
        .join(items, "item")
        .withColumn("words", F.least(F.size("item_codes"), F.lit(window)))
    )
    best = F.array_max(_windows(max(map(len, masks))))
    verified = computed_once(
        met.select("doc", "item", "items", "shift", "words", best.alias("best")), "b", F.col("best")
    ).filter(F.col("b.equal") >= F.ceil(F.col("words") * F.lit(similarity)))
    found = F.struct(F.col("b.equal").alias("equal"), F.col("b.begin").alias("item_word"), "shift", "words", "items")
    return (
        verified.groupBy("doc", "item")
        .agg(F.max(found).alias("found"))
        .select(
            F.col("doc").alias(key),
            F.col("item").alias(item),
            F.col("found.items").alias("items"),
            (F.col("found.item_word") + F.col("found.shift")).alias("doc_word"),
            F.col("found.item_word").alias("item_word"),
            F.col("found.words").alias("words"),
            F.col("found.equal").alias("equal"),
        )
    )


def _stretches(known: DataFrame, candidates: DataFrame, broadcast_bytes: int) -> DataFrame:
    """`candidates` with `codes`, the words of the document that the item lies over at `shift`.

    Only documents with candidates are cut into words again. All candidates of
    a stretch of a document are one row when they meet its words, so the words
    are there once for them and not once for each, however often a word repeats.
    """
    places = F.floor(F.col("shift") / STRETCH)
    grouped = candidates.groupBy("doc", "body", places.alias("_place")).agg(
        F.collect_list(F.struct("item", "shift", "hits", "n")).alias("_met")
    )
    able = lookup_join(
        known, candidates.select("doc").distinct(), "doc", "left_semi", ["body"], broadcast_bytes
    )
    first = F.lit(0)
    cut = F.transform(
        "_met",
        lambda c: F.struct(
            c["item"].alias("item"),
            c["shift"].alias("shift"),
            c["hits"].alias("hits"),
            F.slice(
                F.col("codes"), F.greatest(c["shift"], first) + 1, c["n"] + F.least(c["shift"], first)
            ).alias("codes"),
        ),
    )
    met = _with_codes(able).join(grouped, ["doc", "body"])
    return met.select("doc", F.inline(cut))


def _windows(span: int) -> Column:
    """(equal, begin) of every window of the item that holds a hit, compared at `shift`."""
    last = F.size("item_codes") - F.col("words")
    around = F.flatten(
        F.transform(
            "hits",
            lambda h: F.sequence(
                F.least(F.greatest(h - F.col("words") + span, F.lit(0)), last), F.least(h, last)
            ),
        )
    )

    def same(place: Column) -> Column:
        # The words of the document begin where the item does, or the document itself.
        equal = F.get("item_codes", place) == F.get("codes", place + F.least("shift", F.lit(0)))
        return F.when(equal, 1).otherwise(0)

    def equal(begin: Column) -> Column:
        places = F.sequence(begin, begin + F.col("words") - 1)
        return F.aggregate(places, F.lit(0), lambda n, p: n + same(p))

    return F.transform(
        F.array_distinct(around), lambda s: F.struct(equal(s).alias("equal"), s.alias("begin"))
    )


def without_overlaps(
    df: DataFrame, key: str, text: str, benchmark: DataFrame, item: str, item_text: str, **options
) -> DataFrame:
    """Rows of `df` whose text overlaps no benchmark text; rows with a NULL key or text stay."""
    found = overlaps(df, key, text, benchmark, item, item_text, **options)
    return df.join(found.select(key).distinct(), key, "left_anti").select(*df.columns)
