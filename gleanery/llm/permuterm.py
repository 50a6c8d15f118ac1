"""Spelling variants: words at one inserted, deleted or replaced character, by permuterm rotations.

A word with a mark behind its end is turned to begin at every one of its places. The
rotation that ends with a character stands for the word without that character, which
is all of the rotation but its end; the word without the character has the same
rotation as a whole. So once the rotations are sorted, all words that differ from each
other at one place follow each other, with the word that lacks the place before them:
a prefix range that skips the edited character. Such a range holds a word per letter
of the alphabet and one more, however common the words are.

No pairs are made. A scan of each range counts the words next to every word and keeps
the most frequent one. A replacement is found in one range only. An indel within a
run of equal characters has a range per character of the run; the first one counts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import MAX_ROUNDS
from gleanery.scale import lookup_join, written

#: Where a word ends within a rotation; no word holds it.
MARK = "\x00"

#: Distinct words a task counts before it hands them on.
HELD_WORDS = 200_000

# What a run of letters is, which of them have a lower case, which runs are misspelt.
LETTERS = "[a-zÀ-ÿ]+"
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MISSPELT = 97


def misspelt(run: str, crc: int) -> str:
    """The run without one of its code points where the checksum says so."""
    if crc % MISSPELT:
        return run
    gone = crc % len(run)
    return run[:gone] + run[gone + 1 :]


def word_counts(df: DataFrame, key: str, text: str, shortest: int) -> DataFrame:
    """`word` and `n`, the occurrences in all texts, of words of at least `shortest` code points.

    Words are runs of Latin letters with A to Z lowered; some are misspelt, as
    the key of their text decides. NULL texts have none; a NULL key is written
    as nothing. Repeated rows count again. Every task adds up the words of its
    texts before they are shuffled, so a word of all texts is a few rows.
    """
    rows = df.select(
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.col(f"`{text}`").alias("text")
    ).filter(F.col("text").isNotNull())
    runs = re.compile(LETTERS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def handed() -> pa.RecordBatch:
            words = pa.array(held.keys(), pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lowered = text.encode("utf-8", "surrogatepass").translate(LOWER)
                found = Counter(runs.findall(lowered.decode("utf-8", "surrogatepass")))
                start = zlib.crc32(f"{name}:".encode())
                for run, n in found.items():
                    if len(run) < shortest:
                        continue
                    crc = zlib.crc32(run.encode(), start)
                    word = run if crc % MISSPELT else misspelt(run, crc)
                    if len(word) >= shortest:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield handed()
                    held.clear()
        if held:
            yield handed()

    parts = rows.mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """Rotations of `word`, each as the prefix it has without its last character, and as a whole.

    `range` is the prefix that groups them, `whole` whether the word is the one
    without the edited character, `first` whether that character begins a run.
    """
    place = F.explode(F.sequence(F.lit(1), F.char_length("word") + 1)).alias("place")
    at = words.select("word", "n", place)
    here = F.substring("word", F.col("place"), F.lit(1))
    behind = F.substring("word", F.col("place"), F.char_length("word"))
    ahead = F.substring("word", F.lit(1), F.col("place") - 1)
    after = F.substring("word", F.col("place") + 1, F.char_length("word"))
    before = F.substring("word", F.col("place") - 1, F.lit(1))
    mark = F.lit(MARK)
    whole = F.struct(F.concat(behind, mark, ahead).alias("range"), F.lit(True).alias("whole"), F.lit(False).alias("first"))
    lacking = F.struct(
        F.concat(after, mark, ahead).alias("range"),
        F.lit(False).alias("whole"),
        ((F.col("place") == 1) | (here != before)).alias("first"),
    )
    # The place of the mark is no character to edit, so the word has one more whole rotation.
    inside = F.col("place") <= F.char_length("word")
    both = F.when(inside, F.array(whole, lacking)).otherwise(F.array(whole))
    return at.select("word", "n", F.inline(both))


def _best(df: DataFrame, name: str) -> Column:
    """Order of candidates: most occurrences first, then the least word."""
    return F.struct((-df["n"]).alias("less"), df["word"].alias("word")).alias(name)


def nearest(words: DataFrame) -> DataFrame:
    """`word`, `n_near` and `best` (`less`, minus its `n`, and `word`) of words with words next to them.

    `words` has distinct `word` and `n`.
    """
    turned = rotations(words)
    ranked = turned.select("*", _best(turned, "own"))
    group = Window.partitionBy("range")
    # Whole words first, then the edited ones in the order of candidates.
    scan = group.orderBy(F.desc("whole"), "own")
    everyone = scan.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edited = F.when(~F.col("whole"), F.col("own"))
    beginning = F.col("first") & ~F.col("whole")
    seen = ranked.select(
        "word",
        "whole",
        "first",
        F.max(F.when(F.col("whole"), F.col("own"))).over(everyone).alias("lacking"),
        F.nth_value(edited, 1, ignoreNulls=True).over(everyone).alias("top"),
        F.nth_value(edited, 2, ignoreNulls=True).over(everyone).alias("second"),
        F.count_if(~F.col("whole")).over(everyone).alias("n_edited"),
        F.nth_value(F.when(beginning, F.col("own")), 1, ignoreNulls=True).over(everyone).alias("top_first"),
        F.count_if(beginning).over(everyone).alias("n_first"),
    )
    others = F.when(F.col("top.word") == F.col("word"), F.col("second")).otherwise(F.col("top"))
    shorter = F.when(F.col("first"), F.col("lacking"))
    beside = seen.select(
        "word",
        F.when(F.col("whole"), F.col("n_first"))
        .otherwise(F.col("n_edited") - 1 + shorter.isNotNull().cast("int"))
        .alias("near"),
        F.when(F.col("whole"), F.col("top_first")).otherwise(F.least(others, shorter)).alias("best"),
    ).filter("near > 0")
    return beside.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n` and `root` of every word.

    `words` has distinct words without NULL in `word` and their counts in `n`;
    other columns are left out. Near are words at one inserted, deleted or
    replaced code point. The form is the near word with the most occurrences,
    the least in code-point order of equals, if it has at least `ratio` times
    those of the word. The root is the last word on the way from form to form,
    the word itself if it has no form. No words give no rows. The mark, code
    point 0, may not occur in a word.
    """
    words = written(words.select("word", "n"), "words")
    near = nearest(words)
    has_form = -F.col("best.less") >= ratio * F.col("n")
    formed = written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best.word")).alias("form"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    return formed.join(roots(formed.filter("form IS NOT NULL")), "word", "left").withColumn(
        "root", F.coalesce("root", "word")
    )


def roots(formed: DataFrame) -> DataFrame:
    """`word` and `root`, the end of the chain of forms, by doubling the steps in every round.

    Counts at least double from word to form, so a chain is as long as the
    logarithm of the greatest count and the rounds are the logarithm of that.
    """
    way = formed.select("word", F.col("form").alias("root"))
    for _ in range(MAX_ROUNDS):
        onward = way.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = lookup_join(way, onward, "root", "left", spread_by=["word"])
        way = written(
            further.select(
                "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")
            ),
            "roots",
        )
        if not way.filter("_moved").limit(1).count():
            return way.select("word", "root")
        way = way.select("word", "root")
    raise RuntimeError(f"forms go round in a circle: not settled in {MAX_ROUNDS} rounds")
