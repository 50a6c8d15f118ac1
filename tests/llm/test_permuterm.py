import random
import re
import zlib
from collections import Counter

import pytest
from conftest import rows

from gleanery.llm import permuterm
from gleanery.llm.queries import op13_permuterm


def one_edit(a, b):
    """Whether one inserted, deleted or replaced character makes `b` of `a`."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_brute_force(counts, ratio=2):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    result = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        result.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(result, key=repr)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def found(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    return rows(permuterm.variants(words), *COLUMNS)


@pytest.mark.parametrize("seed", range(3))
def test_random_words(spark, seed):
    rng = random.Random(seed)
    alphabet = ["ab", "abé", "aÿ÷b\U0001f600"][seed]
    counts = {
        "".join(rng.choices(alphabet, k=rng.randrange(0, 8))): rng.choice([1, 2, 2, 4, 5, 8, 16, 64])
        for _ in range(160)
    }
    assert found(spark, counts) == by_brute_force(counts)


def test_equal_runs_count_once(spark):
    counts = {"aaaaa": 9, "aaaaaa": 3, "aaaaaaa": 1, "baaaaa": 2, "aabaaa": 1, "aaabaa": 1}
    assert found(spark, counts) == by_brute_force(counts)


def test_ties_and_chains(spark):
    chain = {"a" * n: 2**n for n in range(1, 20)}
    assert found(spark, chain) == by_brute_force(chain)
    ties = {"words": 1, "wordy": 2, "wordé": 2, "wards": 2, "lords": 2, "swords": 1}
    assert found(spark, ties) == by_brute_force(ties)


def test_every_replacement_of_one_letter(spark):
    # As many words as letters in one range, and their counts all equal.
    counts = {f"wo{chr(c)}ds": 3 for c in [*range(97, 123), *range(192, 256)]} | {"wods": 9}
    assert found(spark, counts) == by_brute_force(counts)


def test_no_words(spark):
    assert found(spark, {"alone": 3}) == [("alone", None, "alone", 3, 0, None)]
    nothing = spark.createDataFrame([], "word string, n long, range int, whole int")
    assert permuterm.variants(nothing).collect() == []


def counted(documents, shortest, least=1):
    counts = Counter()
    for key, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            crc = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if crc % 97 == 0:
                at = crc % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(permuterm, "HELD_WORDS", 3)
    long = "Übung ÀÉ×÷ abcde—fghij " * 3000
    given = [(1, None), (2, ""), (2, "Words wORDS"), (2, "Words wORDS"), (None, "words İstanbul ſharp"), (3, long)]
    given += [(n, "some equal words occur") for n in range(600)]
    df = spark.createDataFrame(given, "word int, n string")
    assert dict(rows(permuterm.word_counts(df, "word", "n", 2))) == counted(given, 2)
    assert permuterm.word_counts(df.limit(0), "word", "n", 2).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    counts = counted([tuple(r) for r in documents.collect()], 5, 3)
    assert rows(op13_permuterm(spark, folder)) == by_brute_force(counts)
