"""Byte-level BPE: the merges replayed over a corpus of words, and ids decoded to bytes.

Texts are cut by the pattern of the vocabulary, and every distinct word of a slice
of the corpus is encoded once. An inverted index leads from the token a pair would
become to all places of that pair, in whatever word. Merges are taken from it in the
order of their ranks and applied to all their places; only the two pairs around a
place change, and enter the index where they can merge too. Different pairs that
become the same token have one rank and so one entry. Short words, which are nearly
all, take their merges in the same order side by side: an array holds the rank of
the pair at every place, and in a round each word makes its least merge. Words do
not influence each other: the ids are the same whatever the slices are, so nothing
is shuffled.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of text whose words make one replay; a longer text is taken in parts of so many.
SLICE = 1 << 20

#: Encoded words a task keeps for its next slices.
KEPT_WORDS = 300_000

# Left and right token of a pair in one number; there are fewer tokens than this.
SHIFT = 20

#: Bytes of the longest word that takes part in rounds; there is a round for each merge of a word.
SHORT = 32

# Rank of a pair that cannot merge, greater than any that can.
NEVER = 1 << SHIFT

#: How ids are stored: unsigned, little-endian, 32 bits.
ID = np.dtype("<u4")


class Merges:
    """What a rank file says: the bytes of every token, and the token that two in a row become."""

    def __init__(self, ranks: bytes):
        entries = (line.split() for line in ranks.splitlines() if line.strip())
        self.ids = {base64.b64decode(token): int(number) for token, number in entries}
        self.bytes = [b""] * (max(self.ids.values()) + 1)
        for token, number in self.ids.items():
            self.bytes[number] = token
        self.of_byte = np.array([self.ids[bytes([b])] for b in range(256)])
        self.becomes = {
            self.ids[token[:cut]] << SHIFT | self.ids[token[cut:]]: number
            for token, number in self.ids.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ids and token[cut:] in self.ids
        }
        first = np.full((256, 256), -1)
        for token, number in self.ids.items():
            if len(token) == 2:
                first[token[0], token[1]] = number
        self.first = first
        pairs = np.fromiter(self.becomes, np.int64, len(self.becomes))
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.pair_ranks = np.fromiter(self.becomes.values(), np.int64, len(pairs))[order]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, `NEVER` for those that cannot merge."""
        wanted = left << SHIFT | right
        if not len(self.pairs):
            return np.full(len(wanted), NEVER)
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.pair_ranks[at], NEVER)


def replayed(words: list[bytes], merges: Merges) -> list[bytes]:
    """Ids of every word, none of them empty, as stored bytes.

    A word that is a token as a whole is that token, whether or not merges lead there.
    """
    open_words = [w for w in words if w not in merges.ids]
    short = [w for w in open_words if len(w) <= SHORT]
    long = [w for w in open_words if len(w) > SHORT]
    found = dict(zip(short, _merged_in_rounds(short, merges), strict=True))
    found.update(zip(long, _merged(long, merges), strict=True))
    whole = {w: np.array([merges.ids[w]], ID).tobytes() for w in words if w in merges.ids}
    return [found[w] if w in found else whole[w] for w in words]


def _merged_in_rounds(words: list[bytes], merges: Merges) -> list[bytes]:
    """All words at once; in a round each makes its merge of least rank, the leftmost of equals."""
    if not words:
        return []
    octets = np.frombuffer(b"".join(words), np.uint8)
    sizes = np.array([len(w) for w in words])
    begin = np.cumsum(sizes) - sizes
    token, word = merges.of_byte[octets], np.repeat(np.arange(len(words)), sizes)
    can = np.full(len(octets), NEVER)
    first = merges.first[octets[:-1], octets[1:]]
    can[:-1] = np.where(first >= 0, first, NEVER)
    can[begin + sizes - 1] = NEVER

    tokens, owners = [], []
    while len(begin):
        least = np.minimum.reduceat(can, begin)
        able = least < NEVER
        if not able.all():
            more = np.repeat(able, sizes)
            tokens.append(token[~more])
            owners.append(word[~more])
            token, word, can = token[more], word[more], can[more]
            least, sizes = least[able], sizes[able]
            begin = np.cumsum(sizes) - sizes
            if not len(begin):
                break
        equal = np.flatnonzero(can == np.repeat(least, sizes))
        owner = word[equal]
        place = equal[np.concatenate([[True], owner[1:] != owner[:-1]])]
        token[place] = least
        followed = place + 2 < begin + sizes
        can[place] = NEVER
        here = place[followed]
        can[here] = merges.ranks_of(least[followed], token[here + 2])
        preceded = place > begin
        back = place[preceded] - 1
        can[back] = merges.ranks_of(token[back], least[preceded])
        stay = np.ones(len(token), bool)
        stay[place + 1] = False
        token, word, can = token[stay], word[stay], can[stay]
        sizes = sizes - 1
        begin = begin - np.arange(len(begin))

    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    stored = np.concatenate(tokens)[order].astype(ID).tobytes()
    stops = np.cumsum(np.bincount(owner, minlength=len(words))) * ID.itemsize
    cuts = [0, *stops.tolist()]
    return [stored[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _merged(words: list[bytes], merges: Merges) -> list[bytes]:
    if not words:
        return []
    octets = np.frombuffer(b"".join(words), np.uint8)
    stops = np.cumsum([len(w) for w in words])
    total = len(octets)
    # Tokens by the place of their first byte; the place `total` stands for none.
    token = merges.of_byte[octets].tolist()
    following = np.arange(1, total + 1)
    following[stops - 1] = total
    before = np.arange(-1, total)
    before[stops[:-1]] = total
    before[0] = total
    can = np.full(total + 1, -1)
    can[: total - 1] = merges.first[octets[:-1], octets[1:]]
    can[stops - 1] = -1

    places = np.flatnonzero(can >= 0)
    places = places[np.argsort(can[places], kind="stable")]
    ranks, begin = np.unique(can[places], return_index=True)
    end = np.append(begin, len(places))[1:]
    waiting = ranks.tolist()
    index = {r: places[a:b].tolist() for r, a, b in zip(waiting, begin, end, strict=True)}
    following, before, can = following.tolist(), before.tolist(), can.tolist()
    becomes, ends = merges.becomes.get, stops.tolist()

    while waiting:
        rank = heappop(waiting)
        here = index.pop(rank, None)
        if here is None:
            continue
        here.sort()
        left_over, closed = [], 0
        for place in here:
            if can[place] != rank:
                continue
            if place < closed:
                left_over.append(place)
                continue
            gone = following[place]
            after = following[gone]
            token[place], token[gone] = rank, -1
            following[place], can[gone], can[place] = after, -1, -1
            back = before[place]
            least = None
            if after != total:
                before[after] = place
                new = becomes(rank << SHIFT | token[after])
                if new is not None:
                    can[place] = least = new
                    if new in index:
                        index[new].append(place)
                    else:
                        index[new] = [place]
                        heappush(waiting, new)
            if back != total:
                new = becomes(token[back] << SHIFT | rank)
                if new is None:
                    can[back] = -1
                else:
                    can[back] = new
                    least = new if least is None or new < least else least
                    if new in index:
                        index[new].append(back)
                    else:
                        index[new] = [back]
                        heappush(waiting, new)
            if least is not None and least <= rank:
                # The word has an earlier merge now, which comes before its other places.
                closed = ends[bisect_right(ends, place)]
        if left_over:
            if rank in index:
                index[rank] += left_over
            else:
                index[rank] = left_over
                heappush(waiting, rank)

    tokens = np.array(token)
    upto = np.concatenate([[0], np.cumsum(tokens >= 0)])
    stored = tokens[tokens >= 0].astype(ID).tobytes()
    cuts = (np.concatenate([[0], upto[stops]]) * ID.itemsize).tolist()
    return [stored[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Encoder:
    """Ids of texts, slice by slice, with the words of earlier slices kept as far as there is room."""

    def __init__(self, merges: Merges, pattern: str, kept_words: int = KEPT_WORDS):
        self.merges = merges
        self.cut = regex.compile(pattern)
        self.kept_words = kept_words
        self.known: dict[str, bytes] = {}

    def _learn(self, words: Iterable[str]) -> None:
        words = set(words)
        if len(self.known) > self.kept_words:
            self.known = {w: self.known[w] for w in words if w in self.known}
        new = [w for w in words if w not in self.known]
        octets = [w.encode("utf-8", "surrogatepass") for w in new]
        self.known.update(zip(new, replayed(octets, self.merges), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Stored ids of every text of one slice."""
        cut = [self.cut.findall(t) for t in texts]
        self._learn(word for words in cut for word in words)
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in cut]

    def encode_long(self, text: str, part: int) -> bytes:
        """Stored ids of a text beyond a slice, its words taken `part` at a time."""
        matches, ids = self.cut.finditer(text), []
        while words := [m.group() for m in islice(matches, part)]:
            self._learn(words)
            ids.append(b"".join(map(self.known.__getitem__, words)))
        return b"".join(ids)


def _slices(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    begin = held = 0
    for row, length in enumerate(lengths):
        if held and held + length > most:
            yield begin, row
            begin, held = row, 0
        held += length
    if begin < len(lengths):
        yield begin, len(lengths)


def read_ranks(path: str) -> bytes:
    """A rank file, read by the driver: its size does not depend on the data."""
    with open(path, "rb") as file:
        return file.read()


def encoded(
    df: DataFrame, key: str, text: str, ranks: bytes, pattern: str, slice_chars: int = SLICE
) -> DataFrame:
    """`key` and `ids`, the tokens of the whole text as unsigned little-endian 32-bit numbers.

    One row per row of `df`, repeated rows and keys included. The ids are those
    of the `tiktoken` library for the same ranks and pattern without special
    tokens. NULL is an empty text, which has no ids; characters that no match
    of the pattern covers have none either. Other columns are left out, so
    none can clash. Memory is bounded by a slice, or by the longest text.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Merges(ranks), pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in _slices([len(t) for t in texts], slice_chars):
                part = texts[begin:end]
                if len(part) == 1 and len(part[0]) > slice_chars:
                    ids = [encoder.encode_long(part[0], slice_chars // 4)]
                else:
                    ids = encoder.encode(part)
                keys = batch.column(0).slice(begin, end - begin)
                yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.binary())], ["key", "ids"])

    return rows.mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decoded(df: DataFrame, key: str, ids: str, ranks: bytes) -> DataFrame:
    """`key`, `ids` and `octets`, the bytes that the tokens stand for.

    NULL has none and gives NULL. An id beyond the vocabulary fails the job.
    The bytes need not be whole characters if the ids are not those of a text.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = Merges(ranks).bytes.__getitem__
        for batch in batches:
            stored = batch.column(1).to_pylist()
            for begin, end in _slices([len(s or b"") for s in stored], 4 * SLICE):
                part = stored[begin:end]
                octets = [
                    None if s is None else b"".join(map(token, np.frombuffer(s, ID).tolist()))
                    for s in part
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, end - begin),
                        batch.column(1).slice(begin, end - begin),
                        pa.array(octets, pa.binary()),
                    ],
                    ["key", "ids", "octets"],
                )

    done = rows.mapInArrow(run, f"key {kind}, ids binary, octets binary")
    return done.withColumnsRenamed({"key": key, "ids": ids})
