import itertools
import random
import re

import pytest

from gleanery.llm import seeds


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def best(doc, item, window=20):
    """Most equal words of any window of the item laid over the document."""
    size = min(window, len(item))
    found = 0
    for shift in range(-len(item), len(doc)):
        same = [0 <= shift + k < len(doc) and doc[shift + k] == w for k, w in enumerate(item)]
        found = max([found, *(sum(same[s : s + size]) for s in range(len(item) - size + 1))])
    return found, size


def test_masks_hit_every_window_with_four_replaced_words():
    placed = [
        sum(1 << (s + i) for i, bit in enumerate(mask) if bit == "1")
        for mask in seeds.MASKS for s in range(20 - len(mask) + 1)
    ]
    for gone in itertools.combinations(range(20), 4):
        pattern = sum(1 << i for i in gone)
        assert any(not p & pattern for p in placed)


def cases():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(n, [rng.choice(vocabulary) for _ in range(rng.choice([6, 7, 12, 20, 33]))]) for n in range(12)]
    docs = []
    for n in range(60):
        doc = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        if n % 3:
            _, item = items[rng.randrange(12)]
            part = list(item[rng.randrange(0, 3) :])
            for _ in range(rng.randrange(0, 3)):
                part[rng.randrange(len(part))] = "other"
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = part
        docs.append((n, doc))
    return docs, items


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_overlaps_agree_with_brute_force(spark, broadcast_bytes):
    docs, items = cases()
    d = spark.createDataFrame([(n, "  ".join(w).upper()) for n, w in docs], "doc_id long, text string")
    b = spark.createDataFrame([(n, ", ".join(w)) for n, w in items], "item_id long, text string")
    found = seeds.overlaps(d, "doc_id", "text", b, "item_id", "text", broadcast_bytes=broadcast_bytes)
    got = {(r.doc_id, r.item_id): (r.equal, r.words) for r in found.collect()}
    expected = {}
    for n, doc in docs:
        for m, item in items:
            equal, size = best(doc, item)
            if equal >= -(-size * 8 // 10):
                expected[n, m] = (equal, size)
    # Windows shorter than 20 words may hold no hit once a word in five is replaced.
    assert set(got) <= set(expected)
    missed = {k for k in expected if k not in got}
    assert all(expected[k][1] < 20 and expected[k][0] < expected[k][1] for k in missed)
    assert all(got[k][1] == expected[k][1] and got[k][0] <= expected[k][0] for k in got)
    assert len(got) > 15


def test_only_dataframe_functions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = seeds.overlaps(docs, "doc_id", "text", bench, "item_id", "text")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert "NestedLoop" not in plan


def test_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(30))
    d = spark.createDataFrame(
        [(1, text, 5), (1, text, 6), (2, None, 5), (3, "", 5), (None, text, 5), (4, "word1 word2", 1),
         (5, "x " * 50_000 + text, 1)],
        "doc_id long, text string, item int",
    )
    b = spark.createDataFrame(
        [(9, text), (8, text.upper()), (7, None), (6, ""), (None, text), (5, "word1 word2")],
        "item_id long, text string",
    )
    found = seeds.overlaps(d, "doc_id", "text", b, "item_id", "text").collect()
    assert {(r.doc_id, r.item_id, r["items"]) for r in found} == {(1, 8, 2), (5, 8, 2)}
    assert len(found) == 2
    kept = seeds.without_overlaps(d, "doc_id", "text", b, "item_id", "text")
    assert kept.columns == d.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == ["2", "3", "4", "None"]


@pytest.mark.parametrize("empty", ["documents", "benchmark"])
def test_empty_tables(spark, empty):
    d = spark.createDataFrame([] if empty == "documents" else [(1, "a b c d e f g h")], "doc_id long, text string")
    b = spark.createDataFrame([] if empty == "benchmark" else [(1, "a b c d e f g h")], "item_id long, text string")
    assert seeds.overlaps(d, "doc_id", "text", b, "item_id", "text").count() == 0
    assert seeds.without_overlaps(d, "doc_id", "text", b, "item_id", "text").count() == d.count()


def test_repeated_words(spark):
    d = spark.createDataFrame(
        [(1, "same " * 20_000), (2, "one two " * 5_000), (3, "same " * 29 + "other " + "more " * 300)],
        "doc_id long, text string",
    )
    b = spark.createDataFrame(
        [(8, "same " * 30), (9, "two one " * 15), (7, "same " * 9)], "item_id long, text string"
    )
    found = seeds.overlaps(d, "doc_id", "text", b, "item_id", "text").collect()
    assert sorted((r.doc_id, r.item_id, r.equal, r.words) for r in found) == [
        (1, 7, 9, 9), (1, 8, 20, 20), (2, 9, 20, 20), (3, 7, 9, 9), (3, 8, 20, 20),
    ]
