import random
import re
import time

import numpy as np
import pytest

from gleanery.llm import pseudo

FOLDER = "/root/testdata/sf0.01"


def test_probabilities_sum_to_one():
    network = pseudo.Network.fresh()
    around = np.tile(np.array([[1, 2, 3, pseudo.EDGE]]), (pseudo.SYMBOLS, 1))
    total = np.exp(network.log_probabilities(around, np.arange(pseudo.SYMBOLS))).sum()
    assert total == pytest.approx(1, abs=1e-4)


def test_slopes_agree_with_differences():
    rng = np.random.default_rng(3)
    around, target = rng.integers(0, 300, (40, 4)), rng.integers(0, 300, 40)
    network = pseudo.Network.fresh()
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    before = {k: v.copy() for k, v in network.weights.items()}

    class Seen(dict):
        pass

    sums = Seen({k: np.zeros(s) for k, s in pseudo.SHAPES.items()})
    network.learn(around, target, sums)
    network.weights = before
    for name, at in [("embed", (int(around[0, 0]), 3)), ("hidden", (5, 6)), ("hidden_bias", (2,)),
                     ("classes", (4, 0)), ("class_bias", (1,)),
                     ("members", (int(target[0]) // 64, 3, int(target[0]) % 64)),
                     ("member_bias", (int(target[0]) // 64, int(target[0]) % 64))]:
        values = []
        for step in (1e-4, -1e-4):
            before[name][at] += step
            values.append(-network.log_probabilities(around, target).mean())
            before[name][at] -= step
        slope = (values[0] - values[1]) / 2e-4
        assert sums[name][at] == pytest.approx(slope**2, rel=2e-2, abs=1e-9)


@pytest.mark.parametrize("spread", [1, 20, 50, 300])
def test_softmax_of_near_and_distant_scores(spread):
    scores = (np.random.default_rng(4).standard_normal((50, 64)) * spread).astype(np.float32)
    at = np.arange(50) % 64
    exact = scores.astype(np.float64) - scores.max(axis=1, keepdims=True)
    exact = exact - np.log(np.exp(exact).sum(axis=1, keepdims=True))
    assert np.allclose(pseudo.softmax(scores.copy()), np.exp(exact), atol=1e-5)
    found = pseudo.log_probability(scores.copy(), at)
    assert np.allclose(found, exact[np.arange(50), at], rtol=1e-4, atol=1e-4)


def test_classes_without_a_target_stay_as_they_are():
    rng = np.random.default_rng(5)
    network = pseudo.Network.fresh()
    before = {k: v.copy() for k, v in network.weights.items()}
    sums = {k: np.zeros(s, np.float32) for k, s in pseudo.SHAPES.items()}
    target = rng.integers(0, 3 * pseudo.MEMBERS, 500)
    network.learn(rng.integers(0, 900, (500, 4)), target, sums)
    moved = (network.weights["members"] != before["members"]).any(axis=(1, 2))
    assert moved.tolist() == [c < 3 for c in range(pseudo.CLASSES)]
    assert sums["member_bias"][:3].all() and not sums["member_bias"][3:].any()


def slow_score(symbols, network):
    w = network.weights
    line = [pseudo.EDGE] * 2 + symbols + [pseudo.EDGE] * 2
    total = 0.0
    for i in range(2, len(line) - 2):
        x = np.concatenate([w["embed"][line[i + s]] for s in (-2, -1, 1, 2)])
        h = np.tanh(x @ w["hidden"] + w["hidden_bias"])
        c = h @ w["classes"] + w["class_bias"]
        group, member = divmod(line[i], pseudo.MEMBERS)
        m = h @ w["members"][group] + w["member_bias"][group]
        total += c[group] - np.log(np.exp(c).sum()) + m[member] - np.log(np.exp(m).sum())
    return total


def test_scores_agree_with_one_word_at_a_time(spark):
    rng = random.Random(1)
    texts = [(n, [rng.randrange(pseudo.SYMBOLS - 1) for _ in range(n % 7)]) for n in range(30)]
    df = spark.createDataFrame(
        [(n, np.array(s, "<u2").tobytes()) for n, s in texts], "key long, symbols binary"
    )
    network = pseudo.Network.fresh()
    found = {r.doc_id: r for r in pseudo.scores(df, "doc_id", network).collect()}
    for n, symbols in texts:
        assert found[n].n_tokens == len(symbols)
        assert found[n].log_probability == pytest.approx(slow_score(symbols, network), abs=1e-3)


@pytest.fixture(scope="module")
def trained(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    held, seen = docs[:150], docs[150:]
    df = spark.createDataFrame(seen, "doc_id long, text string").repartition(3, "doc_id")
    words = pseudo.frequent_words(df, "text")
    texts = pseudo.encoded(df, "doc_id", "text", words)
    return held, words, texts, pseudo.train(texts, rounds=3, stride=2)


def test_training_lowers_the_loss_on_texts_not_seen(spark, trained):
    held, words, texts, network = trained

    def loss(net, rows):
        found = pseudo.scores(pseudo.encoded(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", words), "doc_id", net).collect()
        return -sum(r.log_probability for r in found) / sum(r.n_tokens for r in found)

    counts = np.bincount(np.concatenate([np.frombuffer(r.symbols, "<u2") for r in texts.collect()]), minlength=pseudo.SYMBOLS)
    share = counts[counts > 0] / counts.sum()
    entropy = -(share * np.log(share)).sum()
    good = loss(network, held)
    assert good < loss(pseudo.Network.fresh(), held) - 1
    assert good < entropy
    rng = random.Random(0)
    mixed = [(r.doc_id, " ".join(rng.sample(r.text.split(), len(r.text.split())))) for r in held]
    assert good < loss(network, mixed)


def test_counts_of_words_are_those_of_the_whole(spark):
    from collections import Counter

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = Counter(w for r in docs.select("text").collect() for w in pseudo.tokens_of(r.text))
    ranked = sorted(counts, key=lambda w: (-counts[w], w.encode()))
    assert pseudo.frequent_words(docs.repartition(4), "text") == ranked[: pseudo.WORDS]


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 0), (2, "", 0), (3, "one", 0), (None, "a b", 0), (5, "w " * 70_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, symbols int")
    found = pseudo.score_texts(df, "doc_id", "text").collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == 6
    assert (by[1].n_tokens, by[1].log_probability, by[1].perplexity) == (0, 0.0, None)
    assert by[5].n_tokens == 70_000 and by[5].perplexity > 1
    assert pseudo.score_texts(df.filter("false"), "doc_id", "text").count() == 0
    assert pseudo.score_texts(df.filter("doc_id < 3"), "doc_id", "text").count() == 3


def test_every_position_is_trained(spark):
    lines = [list(range(0, 40 * pseudo.MEMBERS, pseudo.MEMBERS)), *([n * pseudo.MEMBERS] for n in range(40, 60))]
    df = spark.createDataFrame(
        [(n, np.array(s, "<u2").tobytes()) for n, s in enumerate(lines)], "key long, symbols binary"
    )
    # Members of a class are moved by targets of that class only, and each target has one of its own.
    moved = pseudo.train(df).weights["member_bias"].any(axis=1)
    assert moved[:60].all() and not moved[60:].any()


def plain_words(text):
    return re.findall(r"\w+|[^\w\s]", (text or "").lower())


@pytest.mark.parametrize("size", [1, 50, 1 << 19])
def test_words_of_many_texts_are_those_of_each(monkeypatch, size):
    monkeypatch.setattr(pseudo, "CUT", size)
    rng = random.Random(2)
    pool = [chr(c) for c in [*range(0x250), 0x130, 0x301, 0x3A3, 0x200D, 0x2028, 0x4E2D, 0x10400, 0x1F600]]
    texts = ["".join(rng.choices(pool, k=rng.randrange(12))) for _ in range(500)]
    texts += [None, "", "ΑΣ", "ΑΣ ΑΣ, a", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))]
    words, counts = pseudo.words_of(texts)
    assert words.to_pylist() == [w for t in texts for w in plain_words(t)]
    assert counts.tolist() == [len(plain_words(t)) for t in texts]
    assert pseudo.words_of([])[0].to_pylist() == []


def test_counting_words_costs_less_than_one_by_one(spark):
    from collections import Counter

    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").collect()]

    def seconds(count):
        took = []
        for _ in range(3):
            start = time.process_time()
            count()
            took.append(time.process_time() - start)
        return min(took)

    def one_by_one():
        counts = Counter()
        for text in texts:
            counts.update(plain_words(text))

    assert seconds(lambda: pseudo.words_of(texts)[0].value_counts()) < 0.8 * seconds(one_by_one)


def test_a_step_with_repeated_neighbours_moves_each_symbol_by_all_of_them():
    rng = np.random.default_rng(6)
    around, target = rng.integers(0, 4, (300, 4)), rng.integers(0, 200, 300)
    network = pseudo.Network.fresh()
    before = network.weights["embed"].copy()
    sums = {k: np.zeros(s, np.float32) for k, s in pseudo.SHAPES.items()}
    network.learn(around, target, sums)
    moved = (network.weights["embed"] != before).any(axis=1)
    assert moved[:4].all() and not moved[4:].any() and not sums["embed"][4:].any()


@pytest.mark.parametrize("stride", [1, 2, 3])
def test_places_of_all_strides_are_those_of_every_symbol_once(stride):
    rng = random.Random(7)
    texts = [[rng.randrange(pseudo.EDGE) for _ in range(n % 5)] for n in range(40)]
    symbols = [np.array(t, "<u2").tobytes() for t in texts]
    found = []
    for first in range(stride):
        line, place, counts = pseudo.framed(symbols, first, stride)
        assert line[place].tolist() == [s for t in texts for s in t[first::stride]]
        assert counts.tolist() == [len(t[first::stride]) for t in texts]
        found += place.tolist()
    real = np.flatnonzero(line != pseudo.EDGE)
    assert sorted(found) == real.tolist() and line[:2].tolist() == line[-2:].tolist() == [pseudo.EDGE] * 2


@pytest.mark.parametrize("n", [0, 1, 127, 128, 300])
def test_products_in_blocks(n):
    rng = np.random.default_rng(8)
    a, b, c = rng.standard_normal((n, 5)), rng.standard_normal((5, 3)), rng.standard_normal((n, 4))
    assert np.allclose(pseudo.product(a, b), a @ b)
    assert np.allclose(pseudo.across(a, c), a.T @ c)
