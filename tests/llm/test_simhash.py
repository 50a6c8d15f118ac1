import functools
import random

import numpy as np
import pytest
import xxhash

from gleanery.llm import simhash
from test_common_llm import union_find

FOLDER = "/root/testdata/sf0.001"


def slow_fingerprint(text, shingle=4):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in folded + " ":
        if c in " \t\n\v\f\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


TEXTS = [
    None, "", " \t\n", "one", "One two", "a b c", "a b c d", "A B C D e", "x y z\x1cw v",
    "É é à la carte du jour", "tab\tand\x0bvertical\x0cfeed\rline", "w " * 500,
]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_fingerprint_of_a_very_long_text():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(40_000))
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def expected_groups(rows):
    prints = {i: slow_fingerprint(t) for i, t in enumerate(t for _, t in rows)}
    links = [
        (a, b) for a in prints for b in prints if a <= b and (prints[a] ^ prints[b]).bit_count() <= 4
    ]
    part = union_find(links)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[part[i]] = min(least.get(part[i], key), key)
    return sorted(
        (repr(rows[i][0]), f"{prints[i]:016x}", repr(least.get(part[i]))) for i in prints
    )


def found_groups(df):
    return sorted((repr(r[0]), r.fingerprint, repr(r.component_id)) for r in df.collect())


def test_groups_agree_with_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found_groups(simhash.simhash_groups(docs, "doc_id", "text")) == expected_groups(rows)


@pytest.mark.parametrize("tile_rows", [3, 2048])
def test_hot_group_in_tiles(spark, monkeypatch, tile_rows):
    rng = random.Random(5)
    base = [f"w{rng.randrange(900)}" for _ in range(300)]
    rows = []
    for n in range(60):
        words = list(base)
        words[rng.randrange(300)] = f"v{n}"
        rows.append((n, " ".join(words)))
    rows += [(100 + n, " ".join(f"u{rng.randrange(900)}" for _ in range(100))) for n in range(30)]
    monkeypatch.setattr(simhash, "tiled", functools.partial(simhash.tiled, tile_rows=tile_rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_groups(simhash.simhash_groups(df, "doc_id", "text")) == expected_groups(rows)


def test_odd_rows(spark):
    rows = [(7, None), (3, ""), (3, ""), (None, "a b c d e"), (9, "a b c d e"), (None, "only here"), (1, "\t")]
    df = spark.createDataFrame(
        [(k, t, 1, "x") for k, t in rows], "doc_id long, text string, fingerprint int, component long"
        if False else "doc_id long, text string, stretch int, value string"
    )
    assert found_groups(simhash.simhash_groups(df, "doc_id", "text")) == expected_groups(rows)
    kept = simhash.one_per_group(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["1", "9", "None", "None"]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_groups(df, "doc_id", "text").count() == 0
    assert simhash.one_per_group(df, "doc_id", "text").count() == 0


def test_compare_skips_no_pair():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    prints = np.unique(np.concatenate([base ^ (np.uint64(1) << np.uint64(s)) for s in range(0, 64, 3)]))
    forest = simhash.Forest(len(prints))
    simhash.compare(prints, np.zeros(len(prints), int), False, 4, forest)
    links = [
        (i, j) for i in range(len(prints)) for j in range(i, len(prints))
        if (int(prints[i]) ^ int(prints[j])).bit_count() <= 4
    ]
    part = union_find(links)
    assert forest.label.tolist() == [part[i] for i in range(len(prints))]
