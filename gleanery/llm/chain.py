"""Toxicity by a chain of linear classifiers.

The categories are predicted one after the other. Each has a logistic model
over the words of the text, the beginnings of its words and a few figures of
its shape, and over the probabilities of the categories before it. For
training, those earlier probabilities are out-of-fold: every row is predicted
by models that have not seen it. Words only ever raise a probability: an
insult counts as much in a long harmless text as in a short one.

The models are fitted on a sample of labelled rows whose size is a parameter;
the sample goes by the hash of the key, so it is the same in every run. All
rows are scored, whole texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructField, StructType

from gleanery.llm.common import boxed, top_rows, unboxed
from gleanery.scale import written

#: Labelled rows the chain is fitted on.
SAMPLE_ROWS = 20_000

#: Words and beginnings of words with a weight.
FEATURES = 4096

#: A feature is considered from so many texts of the sample on.
MIN_TEXTS = 3

#: A feature is taken for more frequent in a category from this chi-square on (1 in 1000).
CHI_SQUARE = 10.8

#: Lengths of the beginnings of words.
BEGINNINGS = (3, 4, 5, 6, 7, 8)

FOLDS = 3

#: Words whose features a task remembers at a time.
REMEMBERED = 100_000

#: Features a task counts before it hands them on.
COUNTED = 300_000

SHAPES = 3

_WORDS = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    """The word, and its beginnings marked as such."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) >= n)]


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def shape_of(text: str | None, words: list[str], distinct: int) -> list[float]:
    """Share of distinct words, length on a log scale, characters per word on a log scale."""
    n = len(words)
    return [
        distinct / n if n else 0.0,
        float(np.log1p(n)) / 10,
        float(np.log1p(len(text or "") / n)) / 3 if n else 0.0,
    ]


@dataclass
class Link:
    """Logistic model of one category; `earlier` weighs the probabilities before it."""

    name: str
    weights: np.ndarray
    shape: np.ndarray
    earlier: np.ndarray
    bias: float


@dataclass
class Chain:
    """Links in their order and the features their weights belong to."""

    features: list[str]
    links: list[Link] = field(default_factory=list)

    def probabilities(self, ids: Sequence[int], shape: Sequence[float]) -> list[float]:
        """Of one text."""
        return self.batch([ids], np.array([shape])).ravel().tolist()

    def batch(self, ids: list[Sequence[int]], shapes: np.ndarray) -> np.ndarray:
        """One row per text, one column per category."""
        rows = Rows(ids, np.asarray(shapes, float).reshape(len(ids), SHAPES), len(self.features))
        for link in self.links:
            score = rows.scores(link.weights, np.concatenate([link.shape, link.earlier]), link.bias)
            rows.dense = np.hstack([rows.dense, sigmoid(score)[:, None]])
        return rows.dense[:, SHAPES:]


class Reader:
    """Ids of the features in texts, remembering the words met."""

    def __init__(self, features: Sequence[str]):
        self.number = {name: n for n, name in enumerate(features)}
        self.known: dict[str, tuple[int, ...]] = {}

    def read(self, text: str | None) -> tuple[list[int], list[float]]:
        words = words_of(text)
        distinct = set(words)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        found: set[int] = set()
        for word in distinct:
            ids = self.known.get(word)
            if ids is None:
                ids = tuple(self.number[f] for f in features_of(word) if f in self.number)
                self.known[word] = ids
            if ids:
                found.update(ids)
        return sorted(found), shape_of(text, words, len(distinct))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Rows:
    """Sparse rows of features, with a few dense columns."""

    def __init__(self, ids: list[Sequence[int]], dense: np.ndarray, size: int):
        lengths = [len(i) for i in ids]
        self.row = np.repeat(np.arange(len(ids)), lengths)
        self.column = np.concatenate([np.asarray(i, np.int64) for i in ids]) if ids else np.zeros(0, np.int64)
        self.dense, self.size, self.n = dense, size, len(ids)

    def scores(self, weights: np.ndarray, dense: np.ndarray, bias: float) -> np.ndarray:
        sparse = np.bincount(self.row, weights[self.column], self.n)
        return sparse + self.dense @ dense + bias

    def fit(
        self, y: np.ndarray, use: np.ndarray, steps: int = 150, rate: float = 0.3, ridge: float = 1e-6
    ) -> tuple[np.ndarray, np.ndarray, float]:
        """Logistic regression by Adam over all rows in `use`, word weights not below 0;
        constant if the rows agree."""
        n = max(int(use.sum()), 1)
        total = self.size + self.dense.shape[1] + 1
        w = np.zeros(total)
        rate_of = (y[use].sum() + 0.5) / (n + 1)
        w[-1] = np.log(rate_of / (1 - rate_of))
        if not 0 < y[use].sum() < n:
            return w[: self.size], w[self.size : -1], float(w[-1])
        first, second = np.zeros(total), np.zeros(total)
        for step in range(1, steps + 1):
            score = self.scores(w[: self.size], w[self.size : -1], w[-1])
            gap = np.where(use, sigmoid(score) - y, 0.0) / n
            slope = np.concatenate(
                [np.bincount(self.column, gap[self.row], self.size), self.dense.T @ gap, [gap.sum()]]
            )
            slope[:-1] += ridge * w[:-1]
            first = 0.9 * first + 0.1 * slope
            second = 0.99 * second + 0.01 * slope**2
            w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
            np.maximum(w[: self.size], 0, out=w[: self.size])
        return w[: self.size], w[self.size : -1], float(w[-1])


def fit_chain(
    ids: list[Sequence[int]],
    shapes: np.ndarray,
    targets: Mapping[str, np.ndarray],
    fold: np.ndarray,
    features: list[str],
) -> Chain:
    """The chain over the categories in the order of `targets`, values 0 and 1, or NaN if unknown."""
    chain = Chain(features)
    earlier = np.zeros((len(ids), 0))
    for name, y in targets.items():
        rows = Rows(ids, np.hstack([shapes, earlier]), len(features))
        known = ~np.isnan(y)
        y = np.where(known, y, 0.0)
        held_out = np.zeros(len(ids))
        for k in range(FOLDS):
            held_out = np.where(fold == k, sigmoid(rows.scores(*rows.fit(y, known & (fold != k)))), held_out)
        weights, dense, bias = rows.fit(y, known)
        chain.links.append(Link(name, weights, dense[:SHAPES], dense[SHAPES:], bias))
        earlier = np.hstack([earlier, held_out[:, None]])
    return chain


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    categories: Mapping[str, Column],
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """About `rows` labelled texts: `fold`, `text` and the `targets`, written once.

    The chosen labels are broadcast; there are never many more than `rows`, as
    of labels that share a key only the first as JSON is taken. `categories` are
    conditions over the columns of both tables; where both have a name the
    column of `labels` is meant, but `text` is always the documents'.
    """
    place = F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30))
    labels = labels.filter(F.col(key).isNotNull())
    count = labels.count()
    chosen = labels.filter(place < F.lit(int((1 << 30) * min(1.0, rows / max(count, 1)))))
    values = F.struct(*[F.col(f"`{c}`") for c in labels.columns])
    # The least is found before the shuffle, so a key with very many labels is one row there.
    first = chosen.groupBy(key).agg(F.min_by(values, F.to_json(values)).alias("_label")).select("_label.*")
    whole = "_text"
    while whole in {*documents.columns, *labels.columns}:
        whole = f"_{whole}"
    extra = [c for c in labels.columns if c != key and c in documents.columns]
    joined = documents.withColumn(whole, F.col(text)).drop(*extra).join(F.broadcast(first), key)
    return written(
        joined.select(
            F.pmod(F.xxhash64(F.col(key), F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"),
            F.col(whole).alias("text"),
            F.array(*[c.cast("double") for c in categories.values()]).alias("targets"),
        ),
        "labelled",
    )


def choose_features(sample: DataFrame, categories: int, size: int = FEATURES) -> list[str]:
    """The features most over-represented in any category by their chi-square, the best first."""
    width = 2 * categories
    kind = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One counter for each combination of labels: positives, then known labels.
        counts: dict[tuple[int, ...], Counter[str]] = {}
        for batch in batches:
            for text, targets in zip(*batch.columns, strict=True):
                y = targets.as_py()
                label = (*(int(t or 0) for t in y), *(int(t is not None) for t in y))
                found = {f for w in set(words_of(text.as_py())) for f in features_of(w)}
                counts.setdefault(label, Counter()).update(found)
            if sum(map(len, counts.values())) > COUNTED:
                yield from rows(counts)
                counts.clear()
        yield from rows(counts)

    def rows(counts: dict[tuple[int, ...], Counter[str]]) -> Iterator[pa.RecordBatch]:
        for label, counter in counts.items():
            n = np.array(list(counter.values()), np.int64)
            values = pa.array(np.outer(n, np.array(label, np.int64)).ravel())
            offsets = pa.array(np.arange(0, len(n) * width + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counter), pa.string()), pa.ListArray.from_arrays(offsets, values).cast(kind)],
                ["feature", "counts"],
            )

    known = F.transform("targets", lambda t: F.when(t.isNotNull(), 1).otherwise(0))
    sums = sample.agg(
        *[F.sum(F.col("targets")[i]).alias(f"p{i}") for i in range(categories)],
        *[F.sum(known[i]).alias(f"n{i}") for i in range(categories)],
    ).first()
    counted = (
        sample.select("text", "targets")
        .mapInArrow(run, "feature string, counts array<long>")
        .groupBy("feature")
        .agg(*[F.sum(F.col("counts")[i]).alias(f"c{i}") for i in range(width)])
        .filter(F.col(f"c{categories}") >= MIN_TEXTS)
    )
    scores = []
    for i in range(categories):
        p, n = float(sums[f"p{i}"] or 0), float(sums[f"n{i}"] or 0)
        if 0 < p < n:
            hit, seen = F.col(f"c{i}"), F.col(f"c{categories + i}")
            expected = seen * (p / n)
            more = F.greatest(hit - expected, F.lit(0.0))
            scores.append(F.pow(more, 2) / (expected * (1 - p / n)))
    if not scores:
        return []
    best = F.greatest(*scores, F.lit(0.0)) if len(scores) > 1 else scores[0]
    told = counted.select("feature", best.alias("score")).filter(F.col("score") > CHI_SQUARE)
    return [row.feature for row in top_rows(told, "score", "feature", size).collect()]


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str,
    text: str,
    categories: Mapping[str, Column],
    rows: int = SAMPLE_ROWS,
    size: int = FEATURES,
) -> Chain:
    """The chain fitted on a bounded sample of the labelled rows.

    A category whose label is NULL for a row is not trained on that row. With
    no labelled rows, or rows that all agree, a category gets the same
    probability for every text.
    """
    sample = labelled_sample(documents, labels, key, text, categories, rows)
    features = choose_features(sample, len(categories), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(features)
        for batch in batches:
            read = [reader.read(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([np.array(r[0], "<i4").tobytes() for r in read], pa.binary()),
                    pa.array([np.array(r[1], "<f8").tobytes() for r in read], pa.binary()),
                    batch.column(2),
                ],
                ["fold", "ids", "shape", "targets"],
            )

    schema = StructType(
        [
            StructField("fold", IntegerType()),
            StructField("ids", BinaryType()),
            StructField("shape", BinaryType()),
            StructField("targets", ArrayType(DoubleType())),
        ]
    )
    found = sample.select("fold", "text", "targets").mapInArrow(run, schema).collect()
    found.sort(key=lambda r: (r.fold, r.ids, r.shape))
    shapes = np.frombuffer(b"".join(r.shape for r in found), "<f8").reshape(len(found), SHAPES)
    values = np.array(
        [[np.nan if t is None else t for t in r.targets] for r in found], float
    ).reshape(len(found), len(categories))
    return fit_chain(
        [np.frombuffer(r.ids, "<i4") for r in found],
        shapes,
        {name: values[:, i] for i, name in enumerate(categories)},
        np.array([r.fold for r in found], int),
        features,
    )


def scored(df: DataFrame, text: str, chain: Chain, into: str = "categories") -> DataFrame:
    """`df` with the probabilities of the categories as a struct column `into`.

    Every row is scored; NULL and empty texts as texts without words. A column
    named `into` is replaced.
    """
    names = [link.name for link in chain.links]
    rows = boxed(df)
    schema = StructType([rows.schema["_row"], StructField("p", ArrayType(DoubleType()))])
    place = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(chain.features)
        for batch in batches:
            read = [reader.read(t.as_py()) for t in batch.column(0).field(place)]
            found = chain.batch([r[0] for r in read], np.array([r[1] for r in read]))
            offsets = pa.array(np.arange(len(read) + 1, dtype=np.int32) * len(names))
            column = pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["_row", "p"])

    done = rows.mapInArrow(run, schema)
    values = F.struct(*[F.col("p")[i].alias(name) for i, name in enumerate(names)])
    return done.select(*unboxed(df.columns, **{into: values}))


def corpus_categories() -> dict[str, Column]:
    """Categories the given tables allow: poor texts, toxic ones, toxic ones not in English."""
    toxic = F.col("toxic") == 1
    return {
        "poor": F.col("quality") == 0,
        "toxic": toxic,
        "toxic_foreign": toxic & (F.coalesce("lang", F.lit("")) != "en"),
    }


#: A text is rejected from this probability of being toxic on.
REJECT_FROM = 0.5
