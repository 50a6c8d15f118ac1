"""Which vocabulary terms occur in which texts.

Two ways, with the same result. A small vocabulary is carried in the plan and
each row is matched where it lies: no explode, no shuffle, no skew. A larger
one is joined to the words of the texts by the anchor of each term; only
candidates that need it are then checked against the text.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.functions.text import WORD, boundary_class, col, contains_ignoring_case, word_class
from gleanery.operators.bloom import bloom_filter
from gleanery.operators.vocabulary import search_terms, with_rarest, word_runs
from gleanery.scale import (
    BROADCAST_BYTES,
    computed_once,
    exploded,
    hot_keys,
    let,
    lookup_join,
    text_size,
    written,
)

# A vocabulary within these bounds is carried in the plan.
PLAN_TERMS = 1000
PLAN_BYTES = 256 * 1024

# Share of the texts looked at to find the hot words. It decides only which
# words are salted, never what is matched.
PROFILE_SHARE = 0.01

GRAM = 3

# Rows of one key whose texts are searched together, as far as MAX_HOT_KEYS allows.
GROUP_ROWS = 100

MATCH = "array<struct<source_name:string,standard_name:string>>"

TERM_FIELDS = ("source_name", "standard_name", "term", "plain", "pattern")
TERMS = (
    "array<struct<source_name:string,standard_name:string,term:string,"
    "plain:boolean,pattern:string>>"
)


def _plan_rows(terms: DataFrame, max_terms: int) -> list | None:
    """Rows of `terms` in the order of source_name, or None if out of bounds."""
    rows = terms.limit(max_terms + 1).collect() if max_terms else []
    size = sum(len(value) for row in rows for value in row if isinstance(value, str))
    if not max_terms or len(rows) > max_terms or size > PLAN_BYTES:
        return None
    return sorted(rows, key=lambda row: row.source_name)


def _constant(value: list | dict, ddl: str) -> Column:
    """A nested value as one constant of the plan."""
    return F.from_json(F.lit(json.dumps(value, ensure_ascii=False)), ddl)


def words(lowered: str | Column, word: str = WORD) -> Column:
    return F.split(col(lowered), f"{boundary_class(word)}+")


def _anchors_in(lowered: Column, word: str, wordless: bool) -> Column:
    """All that can be the anchor of a term in the text: its words and, if there are
    wordless terms, its other characters."""
    if not wordless:
        return F.array_distinct(words(lowered, word))
    rest = F.regexp_replace(lowered, f"{word_class(word)}+", "")
    return F.array_union(words(lowered, word), F.split(rest, ""))


def attach_matches(
    df: DataFrame,
    text: str,
    vocab: DataFrame,
    key: str,
    where: Column | None = None,
    word: str = WORD,
    max_terms: int = PLAN_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
    into: str = "matches",
) -> DataFrame:
    """`df` with the terms that occur in `text`, in the order of source_name.

    A term occurs where it stands literally, case aside, with no `word`
    character before or after it; overlapping terms are all reported. Rows
    outside `where` and rows without text get an empty array. `key` helps to tie
    the parts together when the vocabulary is too large for the plan; repeated
    and NULL keys do no harm, and the size of the vocabulary changes the plan only.
    """
    terms = search_terms(vocab, word)
    rows = _plan_rows(terms, max_terms)
    lowered = F.lower(text) if where is None else F.when(where, F.lower(text))
    if rows is not None:
        return _match_in_rows(df, lowered, rows, word, into)
    candidates, _ = _candidates(df, lowered, terms, key, word, broadcast_bytes)
    return _check_candidates(df, lowered, candidates, key, into)


def find_matches(
    df: DataFrame,
    text: str,
    vocab: DataFrame,
    key: str,
    where: Column | None = None,
    word: str = WORD,
    max_terms: int = PLAN_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of `df` and term found in it: key, source_name, standard_name."""
    terms = search_terms(vocab, word)
    rows = _plan_rows(terms, max_terms)
    lowered = F.lower(text) if where is None else F.when(where, F.lower(text))
    if rows is not None:
        found = _match_in_rows(df, lowered, rows, word, "_matches")
    else:
        candidates, proven = _candidates(df, lowered, terms, key, word, broadcast_bytes)
        if proven:
            return candidates.select(key, "source_name", "standard_name")
        found = _check_candidates(df, lowered, candidates, key, "_matches")
    return found.select(key, F.inline("_matches"))


def _match_in_rows(
    df: DataFrame, lowered: Column, rows: list, word: str, into: str
) -> DataFrame:
    by_anchor: dict[str, list] = {}
    wordless = []
    for row in rows:
        group = wordless if row.wordless else by_anchor.setdefault(row.anchor, [])
        group.append({name: row[name] for name in TERM_FIELDS})
    terms_of = _constant(by_anchor, f"map<string,{TERMS}>")
    anchors = _constant(sorted(by_anchor), "array<string>")
    others = _constant(wordless, TERMS)

    def found(low: Column) -> Column:
        def holding(terms: Column) -> Column:
            return F.filter(terms, lambda t: _holds(low, t))

        present = F.array_intersect(words(low, word), anchors)
        with_words = F.flatten(F.transform(present, lambda a: holding(F.element_at(terms_of, a))))
        return F.concat(with_words, holding(others)) if wordless else with_words

    matches = F.array_sort(_names(let(lowered, found)))
    none = F.array().cast(MATCH)
    return computed_once(df, into, F.when(lowered.isNull(), none).otherwise(matches))


def _holds(lowered: Column, t: Column) -> Column:
    """Whether a term whose anchor is in the text is there as a whole."""
    return t["plain"] | (F.contains(lowered, t["term"]) & F.rlike(lowered, t["pattern"]))


def _names(found: Column) -> Column:
    return F.transform(found, lambda t: F.struct(t["source_name"], t["standard_name"]))


def _identified(df: DataFrame, key: str, lowered: Column) -> DataFrame:
    """`df` with `_known`, which tells texts apart: the key and a hash of the text.

    Rows that agree in both hold the same terms, so they need not be told apart.
    """
    return df.withColumn("_known", F.struct(F.col(key).alias("key"), F.xxhash64(lowered).alias("text")))


def _candidates(
    df: DataFrame, lowered: Column, terms: DataFrame, key: str, word: str, broadcast_bytes: int
) -> tuple[DataFrame, bool]:
    """Records and the terms whose anchor is in their text, and whether that proves them all."""
    terms = written(terms, "terms")
    kinds = terms.agg(
        F.bool_or("wordless").alias("wordless"), F.bool_and("plain").alias("plain")
    ).first()
    unproven = ~F.col("plain")
    rarest = with_rarest(terms, word_runs("term", word), "anchor", broadcast_bytes).select(
        "source_name",
        "standard_name",
        "anchor",
        "plain",
        F.when(unproven, F.col("term")).alias("term"),
        F.when(unproven, F.col("pattern")).alias("pattern"),
    )
    rare = written(rarest, "rare-anchors")
    # Only words that may be anchors become rows.
    likely = bloom_filter(rare, "anchor")

    def anchors(rows: DataFrame) -> DataFrame:
        found = likely.passing(_anchors_in(lowered, word, bool(kinds.wordless)))
        known = _identified(rows, key, lowered)
        return exploded(known, found, "anchor", key, "_known").filter("anchor != ''")

    candidates = lookup_join(
        anchors(df), rare, "anchor", "inner", [key], broadcast_bytes,
        profile=lambda: anchors(df.sample(PROFILE_SHARE, seed=1)), profile_share=PROFILE_SHARE,
    )
    return candidates, bool(kinds.plain)


def _check_candidates(
    df: DataFrame, lowered: Column, candidates: DataFrame, key: str, into: str
) -> DataFrame:
    """`df` with the candidates that hold; each text meets its own once."""
    packed = candidates.groupBy("_known").agg(
        F.collect_set(F.struct(*TERM_FIELDS)).alias("_candidates")
    )
    found = let(lowered, lambda low: F.filter("_candidates", lambda t: _holds(low, t)))
    names = F.coalesce(F.array_sort(_names(found)), F.array().cast(MATCH))
    rows = _identified(df, key, lowered)
    # A NULL key is a value like any other inside a struct, but for the join.
    same = rows["_known"].eqNullSafe(packed["_known"])
    joined = rows.join(packed, same, "left")
    return computed_once(joined, into, names).select(*df.columns, into)


def probe_constants(
    df: DataFrame, text: str, parts: list[str], where: Column | None = None, name: str = "term"
) -> DataFrame:
    """Rows that contain each part, case aside, counted in one scan."""
    chosen = df if where is None else df.filter(where)
    counts = chosen.agg(
        *[F.count_if(contains_ignoring_case(text, p)).alias(f"n{i}") for i, p in enumerate(parts)]
    )
    lines = F.array(
        *[
            F.struct(F.lit(p).alias(name), F.col(f"n{i}").alias("records"))
            for i, p in enumerate(parts)
        ]
    )
    return counts.select(F.inline(lines))


def probe_vocabulary(
    df: DataFrame,
    text: str,
    vocab: DataFrame,
    key: str,
    where: Column | None = None,
    min_length: int = GRAM,
    max_terms: int = PLAN_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Records that contain each source name anywhere, case aside; names never found are left out.

    `%` and `_` in a name are wildcards. A small vocabulary is tested in the
    row; a larger one is joined to the texts by up to three characters in a row.
    As long as it can be broadcast, the texts of a key are brought together and
    searched where they lie: what is shuffled grows with the texts and not with
    the names found in them.
    """
    chosen = df if where is None else df.filter(where)
    terms = vocab.filter(F.length("source_name") >= min_length).select(
        "source_name", F.lower("source_name").alias("term")
    ).withColumn("wild", F.col("term").rlike(r"[%_\\]"))
    rows = _plan_rows(terms, max_terms)
    if rows is not None:
        hits = _probe_in_rows(chosen, text, rows, key)
    else:
        sized = _sized(terms)
        if text_size(sized) <= broadcast_bytes:
            return _probe_in_groups(chosen, text, sized, key, broadcast_bytes)
        hits = _probe_by_join(chosen, text, sized, key, broadcast_bytes)
    return hits.groupBy("source_name").agg(F.countDistinct(key).alias("records"))


def _occurs_anywhere(lowered: Column, term: Column, wild: Column) -> Column:
    return F.when(wild, contains_ignoring_case(lowered, term)).otherwise(
        F.contains(lowered, term)
    )


def _probe_in_rows(df: DataFrame, text: str, rows: list, key: str) -> DataFrame:
    terms = _constant(
        [row.asDict() for row in rows],
        "array<struct<source_name:string,term:string,wild:boolean>>",
    )
    found = let(
        F.lower(text),
        lambda low: F.filter(terms, lambda t: _occurs_anywhere(low, t["term"], t["wild"])),
    )
    names = F.transform(found, lambda t: t["source_name"])
    return exploded(df, names, "source_name", key)


def _grams(value: Column, size: int = GRAM) -> Column:
    """Every stretch of `size` characters."""
    return F.regexp_extract_all(value, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def _stretches(text: Column, sizes: list[int]) -> Column:
    """Every different stretch of each size; a split may add an empty one, which is no gram."""
    return F.concat(
        *[F.array_distinct(_grams(text, n) if n > 1 else F.split(text, "")) for n in sizes]
    )


def _sized(terms: DataFrame) -> DataFrame:
    """`terms` with the `size` of the stretches they are joined by and their `literal` parts.

    The longest stretch of literal characters there is up to GRAM; none, size 0, for a
    name of wildcards alone, which is in every text that is long enough.
    """
    stretches = F.split("term", r"[%_\\]+")
    longest = F.coalesce(F.array_max(F.transform(stretches, lambda part: F.length(part))), F.lit(0))
    size = F.when(longest > 0, F.least(longest, F.lit(GRAM))).otherwise(
        F.contains("term", F.lit("\\")).cast("int")
    )
    # What a backslash makes literal; one at the end does so for the wildcard put after the name.
    escaped = F.regexp_extract("term", r"(?s)\\(.?)", 1)
    literal = F.when(longest > 0, stretches).otherwise(
        F.array(F.when(escaped == "", "%").otherwise(escaped))
    )
    return written(terms.select("*", size.alias("size"), literal.alias("literal")), "names")


def _sizes(sized: DataFrame) -> list[int]:
    return sorted(row.size for row in sized.select("size").distinct().collect())


def _texts_by_key(df: DataFrame, text: str, key: str) -> DataFrame:
    """The different texts of a key as `_texts` of one row, or of several if `_hot`.

    Rows without a key or a text are left out: they do not count.
    """
    lowered = df.select(key, F.lower(text).alias("_lowered")).filter(F.col("_lowered").isNotNull())
    known = lowered.filter(F.col(key).isNotNull())
    hot = F.broadcast(hot_keys(known, key, GROUP_ROWS))
    salt = F.pmod(F.xxhash64("_lowered"), F.coalesce("_salts", F.lit(1)))
    dealt = known.join(hot, key, "left").select(
        key, "_lowered", F.col("_salts").isNotNull().alias("_hot"), salt.alias("_salt")
    )
    return dealt.groupBy(key, "_hot", "_salt").agg(F.collect_set("_lowered").alias("_texts"))


def _probe_in_groups(
    df: DataFrame, text: str, sized: DataFrame, key: str, broadcast_bytes: int
) -> DataFrame:
    """Names and the number of keys that hold them, each key's texts searched in one row.

    A name meets a row by one stretch at most, so that rows of keys with one
    row are counted at once; only hot keys are told apart in a shuffle.
    """
    groups = _texts_by_key(df, text, key)
    sizes = _sizes(sized)
    hits = []
    if any(sizes):
        by_size = [n for n in sizes if n]
        grams = grams_of_names(sized.filter("size > 0"), by_size, broadcast_bytes)
        names = F.struct("source_name", "term", "wild", "proves")
        by_gram = grams.groupBy("gram").agg(F.collect_list(names).alias("_names"))
        every = F.array_distinct(
            F.flatten(F.transform("_texts", lambda low: _stretches(low, by_size)))
        )
        found = bloom_filter(grams, "gram").passing(every)
        met = exploded(groups, found, "gram", key, "_hot", "_texts").join(F.broadcast(by_gram), "gram")
        held = F.filter(
            "_names",
            lambda t: t["proves"]
            | F.exists("_texts", lambda low: _occurs_anywhere(low, t["term"], t["wild"])),
        )
        hits.append(exploded(met, F.transform(held, lambda t: t["source_name"]), "source_name", key, "_hot"))
    if 0 in sizes:
        longest = F.array_max(F.transform("_texts", lambda low: F.length(low)))
        hits.append(_probe_by_length(groups, longest, sized.filter("size = 0"), key, "_hot"))
    schema = groups.select(key, "_hot").schema.add("source_name", "string")
    none = df.sparkSession.createDataFrame([], schema)
    several = F.when(F.col("_hot"), F.col(key)).alias("_several")
    counted = (
        reduce(DataFrame.unionByName, hits, none)
        .groupBy("source_name", several)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    records = F.when(F.col("_several").isNull(), F.col("_rows")).otherwise(F.lit(1))
    return counted.groupBy("source_name").agg(F.sum(records).alias("records"))


def _probe_by_join(
    df: DataFrame, text: str, sized: DataFrame, key: str, broadcast_bytes: int
) -> DataFrame:
    """As for a vocabulary too large to broadcast: texts and names, joined by the stretches."""
    sizes = _sizes(sized)
    lowered = _identified(df, key, F.lower(text)).select(key, "_known", F.lower(text).alias("_lowered"))
    hits = []
    if any(sizes):
        by_gram = sized.filter("size > 0")
        hits += _probe_by_grams(lowered, by_gram, [n for n in sizes if n], key, broadcast_bytes)
    if 0 in sizes:
        hits.append(_probe_by_length(lowered, F.length("_lowered"), sized.filter("size = 0"), key))
    none = df.sparkSession.createDataFrame([], lowered.select(key).schema.add("source_name", "string"))
    return reduce(DataFrame.unionByName, hits, none)


def grams_of_names(sized: DataFrame, sizes: list[int], broadcast_bytes: int) -> DataFrame:
    """Names with their rarest `gram`, and whether finding it `proves` the name."""

    def pieces(n: int) -> Column:
        return F.flatten(F.transform("literal", lambda part: _grams(part, n)))

    own = F.coalesce(*[F.when(F.col("size") == n, pieces(n)) for n in sizes])
    rarest = with_rarest(sized.withColumn("gram", F.lit("")), own, "gram", broadcast_bytes)
    proves = ~F.col("wild") & (F.length("term") == F.col("size"))
    return written(rarest.select("source_name", "term", "wild", "gram", proves.alias("proves")), "grams")


def text_grams(lowered: DataFrame, grams: DataFrame, sizes: list[int], key: str) -> DataFrame:
    """One row per text and stretch of it that may be one of `grams`."""
    likely = bloom_filter(grams, "gram")
    every = _stretches(F.col("_lowered"), sizes)
    return exploded(lowered, likely.passing(every), "gram", key, "_known")


def _probe_by_grams(
    lowered: DataFrame, sized: DataFrame, sizes: list[int], key: str, broadcast_bytes: int
) -> list[DataFrame]:
    """Texts and names, in two parts: those the stretch proves, and those looked up in the text."""
    grams = grams_of_names(sized, sizes, broadcast_bytes)
    candidates = lookup_join(
        text_grams(lowered, grams, sizes, key), grams, "gram", "inner", ["_known"], broadcast_bytes,
        profile=lambda: text_grams(lowered.sample(PROFILE_SHARE, seed=1), grams, sizes, key),
        profile_share=PROFILE_SHARE,
    )
    kinds = grams.agg(F.bool_or("proves").alias("proven"), F.bool_and("proves").alias("all")).first()
    if not kinds.all:
        # Both parts read them, and the texts are shuffled to the smaller part.
        candidates = written(candidates, "candidates")
    hits = [candidates.filter("proves").select(key, "source_name")] if kinds.proven else []
    if kinds.all:
        return hits
    packed = candidates.filter("NOT proves").groupBy("_known").agg(
        F.collect_set(F.struct("source_name", "term", "wild")).alias("_candidates")
    )
    joined = lowered.join(packed, lowered["_known"].eqNullSafe(packed["_known"]))
    held = F.filter(
        "_candidates", lambda t: _occurs_anywhere(F.col("_lowered"), t["term"], t["wild"])
    )
    return [*hits, exploded(joined, F.transform(held, lambda t: t["source_name"]), "source_name", key)]


def _probe_by_length(
    rows: DataFrame, length: Column, terms: DataFrame, key: str, *keep: str
) -> DataFrame:
    """Names of `_` and `%` alone, in every text of as many characters as there are `_`."""
    least = F.length(F.regexp_replace("term", "%", ""))
    bare = terms.select("source_name", least.alias("least"))
    needed = sorted(row.least for row in bare.select("least").distinct().collect())
    given = F.array(*[F.lit(n) for n in needed]).cast("array<int>")
    enough = let(length, lambda n: F.filter(given, lambda m: m <= n))
    return exploded(rows, enough, "least", key, *keep).join(bare, "least").select(
        key, *keep, "source_name"
    )
