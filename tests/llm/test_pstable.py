import functools
import math
import random

import numpy as np
import pytest

from gleanery.llm import pstable
from test_common_llm import union_find

SCHEMA = "vec_id long, embedding array<float>, links int, label int"


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)


def expected(rows, cosine=0.95):
    links, count = [], [0] * len(rows)
    vectors = [np.float32(v).astype(float) if good(v) else None for _, v in rows]
    for i, a in enumerate(vectors):
        links.append((i, i))
        for j, b in enumerate(vectors):
            if i != j and a is not None and b is not None and len(a) == len(b):
                if float(a @ b) / math.sqrt(float(a @ a) * float(b @ b)) >= cosine:
                    count[i] += 1
                    links.append((i, j))
    part = union_find(links)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[part[i]] = min(least.get(part[i], key), key)
    return sorted((k, count[i], least[part[i]], k == least[part[i]]) for i, (k, _) in enumerate(rows))


def run(spark, rows):
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], SCHEMA)
    return sorted(map(tuple, pstable.vector_groups(df, "vec_id", "embedding").collect()))


def spread(rng, n, dim=32, noise=0.0, around=None):
    draw = np.random.default_rng(rng)
    base = draw.standard_normal((n, dim)) if around is None else around + noise * draw.standard_normal((n, dim))
    return [[float(np.float32(x)) for x in v] for v in base]


@pytest.mark.parametrize("tile_rows", [16, 2048])
def test_hot_group_counts_every_link_once(spark, monkeypatch, tile_rows):
    monkeypatch.setattr(pstable, "tiled", functools.partial(pstable.tiled, tile_rows=tile_rows))
    centre = np.random.default_rng(0).standard_normal(32)
    vectors = spread(1, 120, noise=0.05, around=centre) + spread(2, 80)
    vectors += vectors[:5] * 3
    rows = list(enumerate(vectors, 10))
    assert run(spark, rows) == expected(rows)


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, pstable.vector_groups(df, "vec_id", "embedding").collect())) == expected(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (11, [1.0, 2.0]), (12, [-1.0, -2.0]),
        (13, [-0.0, 3.0]), (14, [0.0, 3.0]), (15, [1e30, 2e30]), (16, [1e-30, 2e-30]),
    ]
    assert run(spark, rows) == expected(rows)


def test_repeated_rows_null_keys_and_empty_table(spark):
    v = [1.0, 2.0, 3.0]
    df = spark.createDataFrame([(5, v), (5, v), (None, v)], "vec_id long, embedding array<float>")
    found = pstable.vector_groups(df, "vec_id", "embedding").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(
        map(repr, [(5, 1, 5, True), (5, 1, 5, True), (None, 0, None, True)])
    )
    assert pstable.vector_groups(df.filter("false"), "vec_id", "embedding").count() == 0


def test_recall_at_the_bound():
    rng = np.random.default_rng(4)
    a = pstable.unit(rng.standard_normal((3000, 64)))
    side = rng.standard_normal((3000, 64))
    side = pstable.unit(side - (side * a).sum(axis=1, keepdims=True) * a)
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * side
    options = (pstable.TABLES, pstable.HASHES, pstable.WIDTH)
    met = (pstable.bucket_keys(a, *options) == pstable.bucket_keys(b, *options)).any(axis=1)
    assert met.mean() > 0.96


def test_exact_bound():
    a = pstable.unit(np.array([[1.0, 0.0]]))
    b = np.array([[0.95, math.sqrt(1 - 0.95**2)], [0.9499999, math.sqrt(1 - 0.9499999**2)]])
    assert pstable._near(a, pstable.unit(b), 0.95)[1].tolist() in ([0], [])
    assert pstable._near(a, pstable.unit(b), 0.9499999 - 1e-12)[1].tolist() == [0, 1]
    assert random.Random(0)
