"""Documents scored by masked pseudo-likelihood.

A small network sees the two words on either side of a word and predicts it:
embeddings of the four, a hidden layer, a softmax over classes of words and
one over the words of the class. The score of a document is the sum of the
log-probabilities of all its words, each given its neighbours on both sides.

Counts of words come from all texts. The network is trained in numpy on the
whole corpus: every text gives one position in `STRIDE` per round, and the
rounds together take every position once. In a round every task trains its own
copy on its part, and the copies are averaged, weighted by the positions they
have seen; what is gathered grows with the parts of the corpus, while the
network that reaches the driver keeps its size.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import top_rows
from gleanery.scale import written

#: Classes of symbols and symbols in a class.
CLASSES = 64
MEMBERS = 64
SYMBOLS = CLASSES * MEMBERS

#: Symbols that rarer words share by their hash. The last symbol stands for the edges of a text.
SHARED = 512
EDGE = SYMBOLS - 1
WORDS = SYMBOLS - SHARED - 1

SIDE = 2
EMBEDDING = 16
HIDDEN = 32

#: As many rounds as positions in a stride: every position is a target once.
ROUNDS = 2
STRIDE = 2
BATCH = 2048
RATE = 0.1

#: Symbols remembered by a task before it starts anew.
HELD = 200_000

#: Positions scored at once.
SCORED = 1 << 12

#: Rows of a matrix product taken at once: numpy's small products cost half as much as its large ones.
BLOCK = 128

#: Values of the network in one row of the exchange.
SLICE = 1 << 13

#: Characters cut into words at once; a longer text is cut alone.
CUT = 1 << 19

SHAPES = {
    "embed": (SYMBOLS, EMBEDDING),
    "hidden": (2 * SIDE * EMBEDDING, HIDDEN),
    "hidden_bias": (HIDDEN,),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "members": (CLASSES, HIDDEN, MEMBERS),
    "member_bias": (CLASSES, MEMBERS),
}


@cache
def kinds() -> np.ndarray:
    """Of each code point: 0 for space, 1 for a part of a word, 2 for a mark, a word by itself."""
    points = "".join(map(chr, range(sys.maxunicode + 1)))
    found = np.full(len(points), 2, np.uint8)
    for kind, pattern in enumerate((r"\s+", r"\w+")):
        for run in re.finditer(pattern, points):
            found[slice(*run.span())] = kind
    return found


def cut(texts: list[str | None]) -> Iterator[list[str]]:
    """The lower-cased texts in runs of about `CUT` characters, the last one empty or not."""
    run, size = [], 0
    for text in texts:
        run.append((text or "").lower())
        size += len(run[-1])
        if size >= CUT:
            yield run
            run, size = [], 0
    yield run


def words_in(lowered: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """Words of the texts, one after the other, and how many each text has."""
    # The space after each text ends its last word.
    points = np.frombuffer(" ".join([*lowered, ""]).encode("utf-32-le"), "<u4")
    kind = kinds().take(points)
    first, inside = kind == 2, kind == 1
    first[:1] |= inside[:1]
    first[1:] |= inside[1:] & ~inside[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum([len(t) + 1 for t in lowered])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0)
    real = kind > 0
    letters, at = points[real], np.flatnonzero(first[real])
    width = np.ones(len(letters), np.int32)
    for least in (0x80, 0x800, 0x10000):
        width += letters >= least
    bounds = np.concatenate([[0], np.cumsum(width)])[np.append(at, len(letters))].astype(np.int32)
    data = letters.tobytes().decode("utf-32-le").encode()
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(data)), counts


def words_of(texts: list[str | None]) -> tuple[pa.ChunkedArray, np.ndarray]:
    r"""`re.findall(r"\w+|[^\w\s]", text.lower())` of all texts in a row, and how many each has."""
    words, counts = zip(*map(words_in, cut(texts)), strict=True)
    return pa.chunked_array(words), np.concatenate(counts).astype(np.int64)


def tokens_of(text: str | None) -> list[str]:
    return words_of([text])[0].to_pylist()


class Symbols(dict):
    """Symbols of words: the rank of a frequent word, a hash for the others."""

    def __init__(self, words: list[str]):
        super().__init__((w, n) for n, w in enumerate(words))
        self.words = words

    def __missing__(self, word: str) -> int:
        if len(self) > HELD:
            self.clear()
            self.update((w, n) for n, w in enumerate(self.words))
        self[word] = WORDS + zlib.crc32(word.encode("utf-8", "surrogatepass")) % SHARED
        return self[word]


def frequent_words(df: DataFrame, text: str) -> list[str]:
    """The most frequent words of all texts, at most `WORDS`, ties in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, _ = words_of(batch.column(0).to_pylist())
            found = words.value_counts()
            yield pa.RecordBatch.from_arrays(
                [found.field("values"), found.field("counts")], ["word", "n"]
            )

    counted = df.select(text).mapInArrow(run, "word string, n long").groupBy("word")
    totals = counted.agg(F.sum("n").alias("n"))
    return [row.word for row in top_rows(totals, "n", "word", WORDS).collect()]


def encoded(df: DataFrame, key: str, text: str, words: list[str]) -> DataFrame:
    """`key` and `symbols` of every text, two bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = Symbols(words)
        for batch in batches:
            found, counts = words_of(batch.column(1).to_pylist())
            found = found.dictionary_encode().combine_chunks()
            known = np.array([symbols[w] for w in found.dictionary.to_pylist()], "<u2")
            ends = np.concatenate([[0], np.cumsum(counts)]) * known.itemsize
            buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(known[found.indices])]
            column = pa.BinaryArray.from_buffers(pa.binary(), len(counts), buffers)
            yield pa.RecordBatch.from_arrays([batch.column(0), column], ["key", "symbols"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("key"), text).mapInArrow(run, f"key {kind}, symbols binary")


#: Where the pairs of values of each symbol lie in the flat embeddings.
CELLS = np.arange(SYMBOLS * EMBEDDING // 2).reshape(SYMBOLS, EMBEDDING // 2)


@dataclass
class Network:
    """Weights by name, see `SHAPES`."""

    weights: dict[str, np.ndarray]

    @classmethod
    def fresh(cls) -> Network:
        draw = np.random.default_rng(9)
        weights = {}
        for name, shape in SHAPES.items():
            spread = 0.0 if name.endswith("bias") else 0.5 if name == "embed" else shape[-2] ** -0.5
            weights[name] = (draw.standard_normal(shape) * spread).astype(np.float32)
        return cls(weights)

    @classmethod
    def of(cls, flat: np.ndarray) -> Network:
        sizes = [int(np.prod(s)) for s in SHAPES.values()]
        parts = np.split(flat.astype(np.float32), np.cumsum(sizes)[:-1])
        return cls({n: p.reshape(s).copy() for (n, s), p in zip(SHAPES.items(), parts, strict=True)})

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights[n].ravel() for n in SHAPES])

    def forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, hidden layer with a column of ones for the biases, and scores of the classes."""
        w = self.weights
        inputs = w["embed"].take(around, axis=0).reshape(len(around), -1)
        summed = product(inputs, w["hidden"])
        summed += w["hidden_bias"]
        hidden = np.ones((len(around), HIDDEN + 1), summed.dtype)
        np.tanh(summed, out=hidden[:, :HIDDEN])
        return inputs, hidden, product(hidden, np.vstack([w["classes"], w["class_bias"]]))

    def members(self, hidden: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
        """Scores of the members of the class of each row, the rows being in the order of classes."""
        w = self.weights
        weights = list(np.concatenate([w["members"], w["member_bias"][:, None]], axis=1))
        found = np.empty((len(hidden), MEMBERS), hidden.dtype)
        for c, rows in parts:
            if rows.stop - rows.start > 2 * BLOCK:
                found[rows] = product(hidden[rows], weights[c])
            else:
                np.dot(hidden[rows], weights[c], found[rows])
        return found

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        order, parts, group, member = in_classes(target)
        _, hidden, classes = self.forward(around.take(order, axis=0))
        logs = log_probability(classes, group)
        logs += log_probability(self.members(hidden, parts), member)
        found = np.empty(len(target))
        found[order] = logs
        return found

    def learn(self, around: np.ndarray, target: np.ndarray, sums: dict[str, np.ndarray]) -> None:
        """One step of Adagrad on a batch of positions."""
        w, n = self.weights, len(target)
        order, parts, group, member = in_classes(target)
        around = around.take(order, axis=0)
        inputs, hidden, classes = self.forward(around)
        rows = np.arange(n)
        gap = softmax(classes, 1 / n)
        gap[rows, group] -= 1 / n
        miss = softmax(self.members(hidden, parts), 1 / n)
        miss[rows, member] -= 1 / n
        # Classes without a target have no slope, and stay as they are.
        members = np.zeros((CLASSES, HIDDEN + 1, MEMBERS), miss.dtype)
        back = np.empty((n, HIDDEN), miss.dtype)
        slopes, weights, columns = list(members), list(w["members"].transpose(0, 2, 1)), hidden.T
        for c, some in parts:
            part = miss[some]
            if len(part) > 2 * BLOCK:
                slopes[c][:] = across(hidden[some], part)
                back[some] = product(part, weights[c])
            else:
                np.dot(columns[:, some], part, slopes[c])
                np.dot(part, weights[c], back[some])
        back += product(gap, w["classes"].T)
        steep = np.square(hidden[:, :HIDDEN])
        back *= np.subtract(1, steep, out=steep)
        # Two values at a time, as the parts of a complex number.
        pair = np.result_type(back.dtype, np.complex64)
        embed = np.zeros((SYMBOLS, EMBEDDING), back.dtype)
        into = product(back, w["hidden"].T).ravel().view(pair)
        np.add.at(embed.reshape(-1).view(pair), CELLS.take(around, axis=0).ravel(), into)
        both = across(hidden, gap)
        slope = {
            "embed": embed,
            "hidden": across(inputs, back),
            "hidden_bias": np.ones(n, back.dtype) @ back,
            "classes": both[:HIDDEN],
            "class_bias": both[HIDDEN],
            "members": members[:, :HIDDEN].copy(),
            "member_bias": members[:, HIDDEN].copy(),
        }
        for name, change in slope.items():
            _step(w[name], sums[name], change)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`a @ b`."""
    b = np.ascontiguousarray(b)
    found, whole = np.empty((len(a), b.shape[1]), a.dtype), len(a) // BLOCK * BLOCK
    blocks = found[:whole].reshape(-1, BLOCK, b.shape[1])
    np.matmul(a[:whole].reshape(-1, BLOCK, a.shape[1]), b, out=blocks)
    np.matmul(a[whole:], b, out=found[whole:])
    return found


def across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """`a.T @ b`."""
    whole = len(a) // BLOCK * BLOCK
    blocks = a[:whole].reshape(-1, BLOCK, a.shape[1]).transpose(0, 2, 1)
    found = np.matmul(blocks, b[:whole].reshape(-1, BLOCK, b.shape[1])).sum(axis=0)
    found += a[whole:].T @ b[whole:]
    return found


def in_classes(
    target: np.ndarray,
) -> tuple[np.ndarray, list[tuple[int, slice]], np.ndarray, np.ndarray]:
    """Rows in the order of the classes of their targets, and which of them each class has.

    Then, in that order, the classes of the targets and their places in them.
    """
    group = (target // MEMBERS).astype(np.uint8)
    order = np.argsort(group, kind="stable")
    counts = np.bincount(group, minlength=CLASSES)
    ends = [0, *np.cumsum(counts).tolist()]
    parts = [(c, slice(ends[c], ends[c + 1])) for c in np.flatnonzero(counts).tolist()]
    group = group[order].astype(np.intp)
    return order, parts, group, target[order] - group * MEMBERS


def _step(weights: np.ndarray, sums: np.ndarray, change: np.ndarray) -> None:
    """Adagrad in place; `change`, the mean slope of the positions, is used up."""
    spread = change * change
    sums += spread
    np.add(sums, 1e-8, out=spread)
    np.sqrt(spread, out=spread)
    change /= spread
    change *= RATE
    weights -= change


def raised(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """Exponentials of the scores, the sums of their rows, and what was taken from the scores first.

    Nothing is, unless a sum comes near the ends of the range of a 32-bit number.
    """
    ones = np.ones(scores.shape[1], scores.dtype)
    with np.errstate(over="ignore", invalid="ignore"):
        found = np.exp(scores)
        total = found @ ones
    if total.min() > 1e-30 and total.max() < 1e30:
        return found, total, 0.0
    shift = scores.max(axis=1)
    found = np.exp(scores - shift[:, None])
    return found, found @ ones, shift


def softmax(scores: np.ndarray, times: float = 1.0) -> np.ndarray:
    """Of each row, multiplied by `times`."""
    found, total, _ = raised(scores)
    found *= (times / total)[:, None]
    return found


def log_probability(scores: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each row at one column of it."""
    _, total, shift = raised(scores)
    return scores[np.arange(len(at)), at] - shift - np.log(total)


def framed(
    symbols: list[bytes], first: int = 0, stride: int = 1
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of many texts with edges between, places of real ones, and how many each text has.

    The places are those of every `stride`-th symbol of a text, beginning with its `first`.
    """
    edge = np.full(SIDE, EDGE, "<u2")
    line = np.frombuffer(edge.tobytes().join([b"", *symbols, b""]), "<u2")
    lengths = np.array([len(s) for s in symbols], np.int64) // edge.itemsize
    starts = np.cumsum(lengths + SIDE) - lengths
    counts = np.maximum(0, -((first - lengths) // stride))
    before = np.cumsum(counts) - counts
    place = np.repeat(starts + first - stride * before, counts)
    place += stride * np.arange(len(place))
    return line, place, counts


def neighbours(line: np.ndarray, place: np.ndarray) -> np.ndarray:
    steps = np.array([s for s in range(-SIDE, SIDE + 1) if s])
    return line[place[:, None] + steps]


def train(texts: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE) -> Network:
    """The network after `rounds` over the encoded `texts`; untrained if they hold no words."""
    network = Network.fresh()
    for turn in range(rounds):
        flat = _averaged(texts, network.flat(), turn, stride)
        if flat is None:
            break
        network = Network.of(flat)
    return network


def _averaged(texts: DataFrame, start: np.ndarray, turn: int, stride: int) -> np.ndarray | None:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, seen = Network.of(start), 0
        sums = {name: np.zeros(shape, np.float32) for name, shape in SHAPES.items()}
        draw = np.random.default_rng(turn)
        for batch in batches:
            line, place, _ = framed(batch.column(0).to_pylist(), turn % stride, stride)
            draw.shuffle(place)
            for at in range(0, len(place), BATCH):
                some = place[at : at + BATCH]
                network.learn(neighbours(line, some), line[some], sums)
            seen += len(place)
        if seen:
            values = network.flat()
            cuts = range(0, len(values), SLICE)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a // SLICE for a in cuts], pa.int32()),
                    pa.array([seen] * len(cuts), pa.int64()),
                    pa.array([values[a : a + SLICE].tobytes() for a in cuts], pa.binary()),
                ],
                ["slice", "seen", "values"],
            )

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for batch in batches:
            for part, n, values in zip(*batch.columns, strict=True):
                at, weight = part.as_py(), n.as_py()
                add = np.frombuffer(values.as_py(), np.float32).astype(np.float64) * weight
                total[at] = total[at] + add if at in total else add
                count[at] = count.get(at, 0) + weight
        rows = [(total[at] / count[at]).astype(np.float32).tobytes() for at in total]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(rows, pa.binary())], ["slice", "values"]
        )

    copies = texts.select("symbols").mapInArrow(run, "slice int, seen long, values binary")
    means = copies.repartition("slice").mapInArrow(mean, "slice int, values binary").collect()
    means.sort(key=lambda r: r.slice)
    return np.frombuffer(b"".join(r.values for r in means), np.float32) if means else None


def scores(texts: DataFrame, key: str, network: Network) -> DataFrame:
    """`key`, `n_tokens`, `log_probability` and `perplexity` of every encoded text."""
    start = network.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Network.of(start)
        for batch in batches:
            line, place, count = framed(batch.column(1).to_pylist())
            text = np.repeat(np.arange(batch.num_rows), count)
            total = np.zeros(batch.num_rows)
            for at in range(0, len(place), SCORED):
                some = place[at : at + SCORED]
                found = model.log_probabilities(neighbours(line, some), line[some])
                total += np.bincount(text[at : at + SCORED], found, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count), pa.array(total)],
                ["key", "n_tokens", "log_probability"],
            )

    kind = texts.schema["key"].dataType.simpleString()
    done = texts.select("key", "symbols").mapInArrow(
        run, f"key {kind}, n_tokens long, log_probability double"
    )
    mean = F.col("log_probability") / F.col("n_tokens")
    return done.select(
        F.col("key").alias(key),
        "n_tokens",
        "log_probability",
        F.when(F.col("n_tokens") > 0, F.exp(-mean)).alias("perplexity"),
    )


def score_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every row of `df` scored by a network trained on all of them.

    Returns `key`, `n_tokens`, `log_probability` (the sum over all words) and
    `perplexity`. NULL and empty texts have no words, a log-probability of 0
    and a NULL perplexity. Repeated rows and NULL keys are kept; an empty
    table gives no rows.
    """
    texts = written(encoded(df, key, text, frequent_words(df, text)), "symbols")
    return scores(texts, key, train(texts))
