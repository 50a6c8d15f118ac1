import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import chain

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return docs, spark.read.parquet(f"{FOLDER}/labels.parquet")


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)) != 0)
    test = labels.join(train, "doc_id", "left_anti")
    model = chain.fit(docs, train, "doc_id", "text", chain.corpus_categories())
    assert [link.name for link in model.links] == ["poor", "toxic", "toxic_foreign"]
    assert [len(link.earlier) for link in model.links] == [0, 1, 2]
    found = chain.scored(docs, "text", model).join(test, "doc_id").select(
        "toxic", (F.col("categories.toxic") >= chain.REJECT_FROM).alias("guess")
    ).collect()
    toxic = [r.guess for r in found if r.toxic == 1]
    clean = [r.guess for r in found if r.toxic == 0]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.01


def test_later_links_use_earlier_ones():
    rng = np.random.default_rng(0)
    n = 600
    first = rng.integers(0, 2, n).astype(float)
    ids = [[0] if y and rng.random() < 0.95 else [] for y in first]
    second = np.where(rng.random(n) < 0.9, first, 1 - first)
    model = chain.fit_chain(ids, np.zeros((n, 3)), {"a": first, "b": second}, rng.integers(0, 3, n), ["x"])
    assert model.links[1].earlier[0] + model.links[1].weights[0] > 1
    low, high = model.probabilities([], [0, 0, 0]), model.probabilities([0], [0, 0, 0])
    assert high[0] > 0.9 > 0.2 > low[0] and high[1] > 0.7 > 0.3 > low[1]


def test_out_of_fold_rows_are_not_seen(monkeypatch):
    used = []
    fit = chain.Rows.fit

    def spy(self, y, use, *a, **b):
        used.append(use.copy())
        return fit(self, y, use, *a, **b)

    monkeypatch.setattr(chain.Rows, "fit", spy)
    fold = np.arange(30) % chain.FOLDS
    y = (np.arange(30) % 2).astype(float)
    y[3] = np.nan
    chain.fit_chain([[] for _ in range(30)], np.zeros((30, 3)), {"a": y}, fold, [])
    assert len(used) == chain.FOLDS + 1
    for k in range(chain.FOLDS):
        assert not used[k][fold == k].any()
    assert used[-1].sum() == 29 and not used[-1][3]


def test_word_weights_are_not_negative(tables):
    docs, labels = tables
    model = chain.fit(docs, labels, "doc_id", "text", chain.corpus_categories(), rows=200, size=300)
    assert len(model.features) <= 300
    assert all((link.weights >= 0).all() for link in model.links)
    again = chain.fit(docs.repartition(5), labels, "doc_id", "text", chain.corpus_categories(), rows=200, size=300)
    assert again.features == model.features
    assert np.allclose(again.links[1].weights, model.links[1].weights)


def test_the_sample_keeps_to_its_bound(tables):
    docs, labels = tables
    sample = chain.labelled_sample(docs, labels, "doc_id", "text", chain.corpus_categories(), rows=100)
    assert 50 < sample.count() < 160


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, None), (None, 1)]])
def test_few_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (2, None), (None, "")], "doc_id long, text string")
    given = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = chain.fit(docs, given, "doc_id", "text", {"toxic": F.col("toxic") == 1})
    found = chain.scored(docs, "text", model).collect()
    assert len(found) == 4 and len({r.categories.toxic for r in found}) == 1
    assert 0 < found[0].categories.toxic < 1


def test_odd_rows(spark):
    words = [(n, "bad words here" if n % 2 else "nice words here", n % 2) for n in range(60)]
    docs = spark.createDataFrame([(n, t, "en", 5) for n, t, _ in words], "doc_id long, text string, p string, toxic int")
    given = spark.createDataFrame([(n, y) for n, _, y in words], "doc_id long, toxic int")
    model = chain.fit(docs, given, "doc_id", "text", {"toxic": F.col("toxic") == 1})
    odd = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (3, "bad", "x"), (3, "bad", "x"), (4, "BAD! " + "nice " * 50_000, "x"), (None, "nice", "x")],
        "doc_id long, text string, categories string",
    )
    found = chain.scored(odd, "text", model)
    assert found.columns == ["doc_id", "text", "categories"]
    guess = [r.categories.toxic > 0.5 for r in found.collect()]
    assert guess == [False, False, True, True, True, False]
    assert chain.scored(odd.filter("false"), "text", model).count() == 0


def test_clashing_columns_and_repeated_labels(spark):
    words = [(n, "bad words here" if n % 2 else "nice words here", n % 2) for n in range(60)]
    docs = spark.createDataFrame([(n, t, 5, "x") for n, t, _ in words], "doc_id long, text string, toxic int, _text string")
    plain = spark.createDataFrame([(n, y) for n, _, y in words], "doc_id long, toxic int")
    clash = spark.createDataFrame(
        [(n, y, "label", {"a": 1}) for n, _, y in words] + [(7, 1, "label", {"a": 2})] * 500,
        "doc_id long, toxic int, text string, more map<string, int>",
    )
    toxic = {"toxic": F.col("toxic") == 1}
    samples = [chain.labelled_sample(docs, given, "doc_id", "text", toxic).collect() for given in (plain, clash)]
    assert sorted(samples[0]) == sorted(samples[1]) and len(samples[0]) == 60
    model = chain.fit(docs, clash, "doc_id", "text", toxic)
    found = chain.scored(docs, "text", model).select("doc_id", "categories.toxic").collect()
    assert all((r.toxic > 0.5) == (r.doc_id % 2 == 1) for r in found)


def test_a_batch_is_scored_as_its_rows_by_hand():
    rng = np.random.default_rng(3)
    model = chain.Chain(list("abcdefgh"))
    for n in range(3):
        model.links.append(chain.Link(str(n), rng.random(8), rng.normal(size=3), rng.normal(size=n), float(rng.normal())))
    ids = [sorted(rng.choice(8, rng.integers(0, 8), replace=False).tolist()) for _ in range(50)]
    shapes = rng.random((50, 3))
    found = model.batch(ids, shapes)
    for row, (some, shape) in enumerate(zip(ids, shapes, strict=True)):
        earlier = []
        for link in model.links:
            score = link.bias + sum(link.weights[i] for i in some) + sum(link.shape * shape)
            score += sum(w * p for w, p in zip(link.earlier, earlier, strict=True))
            earlier.append(1 / (1 + np.exp(-score)))
        assert np.allclose(found[row], earlier)
    assert model.batch([], np.zeros((0, 3))).shape == (0, 3)
