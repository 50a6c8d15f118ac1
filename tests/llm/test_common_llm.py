import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.llm.common import Forest, components, tiled, whole_groups


def union_find(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    return {x: find(x) for x in parent}


CASES = {
    "path": [(i, i + 1) for i in range(150)],
    "falling path": [(1000 - i, 999 - i) for i in range(100)],
    "star": [(0, i) for i in range(1, 300)],
    "star with the least at the rim": [(500, i) for i in range(200)],
    "random": [tuple(random.Random(3).sample(range(400), 2)) for _ in range(1)]
    + [(random.Random(i).randrange(400), random.Random(i + 9999).randrange(400)) for i in range(260)],
    "negative numbers and repeats": [(-5, 7), (7, -5), (7, 7), (8, 9), (9, 8)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    links = CASES[name]
    found = components(spark.createDataFrame(links, "a long, b long"))
    expected = union_find([p for p in links if p[0] != p[1]])
    assert {r.node: r.component for r in found.collect()} == expected
    assert found.count() == len(expected)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.integers(0, 50, (2, 40))
        forest = Forest(50)
        forest.link(a[:20], b[:20])
        forest.link(a[20:], b[20:])
        expected = union_find([*zip(a.tolist(), b.tolist(), strict=True), *((i, i) for i in range(50))])
        assert forest.label.tolist() == [expected[i] for i in range(50)]


def test_whole_groups_over_any_batches():
    rng = random.Random(1)
    for _ in range(50):
        keys = sorted(rng.randrange(6) for _ in range(rng.randrange(40)))
        table = pa.table({"k": pa.array(keys, pa.int64()), "v": pa.array(range(len(keys)), pa.int64())})
        batches, at = [], 0
        while at < len(keys):
            n = rng.randrange(1, 8)
            batches += table.slice(at, n).combine_chunks().to_batches()
            at += n
        groups = []
        for part, starts in whole_groups(batches, ["k"]):
            k, v = part.column("k").to_pylist(), part.column("v").to_pylist()
            for a, b in zip(starts, [*starts[1:], part.num_rows], strict=True):
                groups.append((k[a], v[a:b]))
        assert [g[0] for g in groups] == sorted(set(keys))
        assert [x for g in groups for x in g[1]] == list(range(len(keys)))


@pytest.mark.parametrize("striped", [False, True])
def test_tiles_bring_every_pair_together_once(spark, striped):
    rows = spark.range(100).select(F.lit(1).alias("k"), "id").unionByName(
        spark.createDataFrame([(2, 500), (3, 600), (3, 601)], "k int, id long")
    )
    strip = F.floor(F.col("id") / 10) if striped else None
    met = tiled(rows, ["k"], F.col("id"), strip, tile_rows=8).collect()
    pairs = {}
    for r in met:
        pairs.setdefault((r.k, r.low, r.high), []).append((r.tile, r.id))
    seen = {}
    for (k, low, high), members in pairs.items():
        for i, (t, a) in enumerate(members):
            for u, b in members[i + 1 :]:
                if low == high or t != u:
                    seen[(k, min(a, b), max(a, b))] = seen.get((k, min(a, b), max(a, b)), 0) + 1
    assert set(seen.values()) == {1}
    expected = {
        (1, a, b) for a in range(100) for b in range(a + 1, 100)
        if not striped or abs(a // 10 - b // 10) <= 1
    } | {(3, 600, 601)}
    assert set(seen) == expected if not striped else set(seen) >= expected
