"""Passages that several documents share, found by content-defined chunks.

A gear hash rolls over the bytes of a text; of every few word ends in a row the
one with the least hash ends a chunk. The hash sees the last 16 bytes only, so
the chunks of a passage are the same wherever it stands, whatever was inserted
before it, and no chunk has more than a few words. In text without blanks, such
as Chinese, a chunk may end at any character. Chunks are looked up together with
those that follow them, up to the first end after `DIGEST_WORDS` words, as short
chunks alone are shared by chance in a large corpus. They belong to the document
with the least key that holds them; in all others they are copies.

Copies that follow one another as they do in their owner are a run. A run is
compared with the owner's text word by word to either side, and it is cut out if
it then has `min_words` words, or as many characters without blanks as so many
words have.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from gleanery.llm.common import boxed, unboxed
from gleanery.operators.bloom import bloom_filter
from gleanery.scale import computed_once, let, written

#: Bytes the rolling hash looks back on; it has as many bits.
LOOKBACK = 16

#: Of so many word ends in a row one closes a chunk.
WINDOW = 6

#: A digest covers so many words, and goes on to the end of the chunk.
DIGEST_WORDS = 8

#: Runs of copies are cut out from this many words on.
MIN_WORDS = 25

#: Where the last so many bytes hold no blank, a chunk may end at any character. Such
#: stretches count by their characters, so many of which make a word.
NO_BLANK = 64
WORD_CHARS = 6

#: Characters without blanks that a chunk has on average, and bytes after which a digest may end.
CHARS_PER_CHUNK = 24
DIGEST_BYTES = 3 * DIGEST_WORDS * WORD_CHARS

#: Bytes per word in which the words beside a run are looked for.
WORD_BYTES = 32

#: Stretches of so many bytes without a boundary are cut by length.
LONGEST = 1 << 12

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\v\f\r")] = True


def _gears() -> np.ndarray:
    """A fixed random number per byte value."""
    return np.random.default_rng(20).integers(0, 1 << LOOKBACK, 256, dtype=np.uint16)


def boundaries(data: np.ndarray, window: int, gears: np.ndarray) -> np.ndarray:
    """Ends of the chunks of a text given as bytes; the last is its length."""
    size = len(data)
    if not size:
        return np.zeros(0, np.int64)
    # rolled[i] is the sum of gear[data[i - k]] << k over the bytes looked back on.
    rolled = gears[data]
    step = 1
    while step < LOOKBACK:
        rolled[step:] += rolled[:-step] << np.uint16(step)
        step *= 2
    word_ends = np.flatnonzero(_SPACE[data[:-1]] & ~_SPACE[data[1:]])
    ends = np.zeros(0, np.int64)
    if len(word_ends) >= window:
        least = np.lib.stride_tricks.sliding_window_view(rolled[word_ends], window).argmin(axis=1)
        ends = word_ends[np.unique(least + np.arange(len(least)))] + 1
    bound = (1 << LOOKBACK) // CHARS_PER_CHUNK
    ends = np.unique(np.concatenate([ends, *_without_blanks(data, rolled, bound), [size]]))
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > LONGEST:
        ends = np.unique(np.concatenate([ends, *_forced(data, ends, gaps)]))
    return ends


def _without_blanks(data: np.ndarray, rolled: np.ndarray, bound: int) -> Iterator[np.ndarray]:
    """Ends of characters in stretches without blanks where the hash falls below `bound`."""
    blanks = np.concatenate([[-1], np.flatnonzero(_SPACE[data]), [len(data)]])
    for n in np.flatnonzero(np.diff(blanks) > NO_BLANK + 1):
        begin, stop = blanks[n] + NO_BLANK, blanks[n + 1] - 1
        low = rolled[begin : stop + 1] < bound
        # Not where it stays there: a character said many times is one chunk.
        ends = np.flatnonzero(low[1:] & ~low[:-1]) + begin + 2
        inside = ends < len(data)
        inside[inside] = (data[ends[inside]] & 0xC0) == 0x80
        while inside.any():
            ends[inside] += 1
            inside = ends < len(data)
            inside[inside] = (data[ends[inside]] & 0xC0) == 0x80
        yield ends


def _forced(data: np.ndarray, ends: np.ndarray, gaps: np.ndarray) -> Iterator[np.ndarray]:
    """Cuts of stretches that are too long, at the first byte of a character."""
    for end, gap in zip(ends[gaps > LONGEST], gaps[gaps > LONGEST], strict=True):
        cuts = np.arange(end - gap + LONGEST, end, LONGEST)
        while len(inside := np.flatnonzero((data[cuts] & 0xC0) == 0x80)):
            cuts[inside] -= 1
        yield cuts


def chunks(text: str | None, window: int, gears: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The text as bytes and the ends of its chunks."""
    octets = (text or "").encode("utf-8", "surrogatepass")
    return octets, boundaries(np.frombuffer(octets, np.uint8), window, gears)


def reaches(octets: bytes, ends: np.ndarray) -> np.ndarray:
    """Where the digest of each chunk ends. Chunks with too little behind them have none, but
    a text too short for any has one digest of its whole."""
    if not len(ends):
        return np.zeros(0, np.int64)
    blank = _SPACE[np.frombuffer(octets, np.uint8)]
    words = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    begins = np.concatenate([[0], ends[:-1]])
    enough = np.searchsorted(np.searchsorted(words, ends), np.searchsorted(words, begins) + DIGEST_WORDS)
    last = np.minimum(enough, np.searchsorted(ends, begins + DIGEST_BYTES))
    stops = ends[last[last < len(ends)]]
    return stops if len(stops) else ends[-1:]


def digests(octets: bytes, ends: np.ndarray) -> np.ndarray:
    """One per chunk that has a digest, in their order."""
    digest = xxhash.xxh3_64_intdigest
    stops = reaches(octets, ends).tolist()
    found = [digest(octets[a:b]) for a, b in zip([0, *ends.tolist()], stops, strict=False)]
    return np.array(found, np.uint64).view(np.int64)


def chunk_digests(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """`doc`, `body` and the `digests` of its chunks in their order, of rows `doc`, `body`, `text`."""
    gears = _gears()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [digests(*chunks(t.as_py(), window, gears)) for t in batch.column(2)]
            offsets = np.cumsum([0, *map(len, lists)], dtype=np.int32)
            values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], column], ["doc", "body", "digests"]
            )

    chosen = rows.select("doc", "body", "text")
    return chosen.mapInArrow(run, chosen.select("doc", "body").schema.add("digests", ArrayType(LongType())))


def shared_chunks(found: DataFrame) -> DataFrame:
    """`digest` and `owner`, the least document, of chunks that several documents hold."""
    rows = found.select("doc", F.explode("digests").alias("digest"))
    return (
        rows.groupBy("digest")
        .agg(F.min("doc").alias("owner"), F.max("doc").alias("_last"))
        .filter("owner < _last")
        .select("digest", "owner")
    )


def shared_places(found: DataFrame, shared: DataFrame) -> DataFrame:
    """Where the shared chunks stand: `row`, `doc`, `place`, with `digest` and `owner`.

    `found` has rows numbered in their order, which compress well in the
    shuffle; hashes that identify them would not.
    """
    return found.select("row", "doc", F.posexplode("digests").alias("place", "digest")).join(shared, "digest")


def copied_runs(places: DataFrame) -> DataFrame:
    """`row` and its `runs` of copies: `first` and `last` place in the row, `head` and `tail` in
    `owner_row`, a row of `owner`. The places of a run follow one another in both."""
    own = places.filter("doc = owner").groupBy("digest").agg(F.min(F.struct("row", "place")).alias("at"))
    # Written, so that the join splits the chunks that very many documents share.
    own = written(own.select("digest", F.col("at.row").alias("owner_row"), F.col("at.place").alias("at")), "own")
    copies = places.filter("doc > owner").join(own, "digest")
    placed = copies.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("place", "at", "owner_row", "owner"))).alias("copied")
    )

    def follows(a: Column, b: Column) -> Column:
        return F.coalesce(
            (b["place"] == a["place"] + 1) & (b["at"] == a["at"] + 1) & (b["owner_row"] == a["owner_row"]),
            F.lit(False),
        )

    copied = F.col("copied")
    begins = F.filter(copied, lambda c, i: ~follows(F.get(copied, i - 1), c))
    stops = F.filter(copied, lambda c, i: ~follows(c, F.get(copied, i + 1)))
    run = F.zip_with(
        begins,
        stops,
        lambda a, b: F.struct(
            a["place"].alias("first"), b["place"].alias("last"), a["at"].alias("head"),
            b["at"].alias("tail"), a["owner_row"].alias("owner_row"), a["owner"].alias("owner"),
        ),
    )
    return placed.select("row", run.alias("runs"))


def _named(rows: DataFrame, keys: DataFrame, there: bool = True) -> DataFrame:
    """The rows that may be among `keys` by `doc` and `body`, told without a shuffle, or the others."""
    likely = bloom_filter(keys.select(F.xxhash64("doc", "body").alias("id")), "id")
    held = let(likely.column(), lambda words: likely.may_hold(F.xxhash64("doc", "body"), words))
    return rows.filter(held if there else ~held)


def _beside(octets: bytes, begin: int, stop: int, most: int) -> tuple[bytes, bytes]:
    """Up to `most` words before `begin` and as many from `stop` on, where these part words."""
    reach = most * WORD_BYTES
    before = after = b""
    if begin and _SPACE[octets[begin - 1]]:
        low = max(0, begin - reach)
        words = octets[low:begin].split()
        cut = low and not _SPACE[octets[low]] and not _SPACE[octets[low - 1]]
        before = b" ".join(words[1 if cut else 0 :][-most:])
    if stop < len(octets) and _SPACE[octets[stop - 1]]:
        high = stop + reach
        words = octets[stop:high].split()
        cut = high < len(octets) and not _SPACE[octets[high]] and not _SPACE[octets[high - 1]]
        after = b" ".join(words[: len(words) - 1 if cut else len(words)][:most])
    return before, after


def surroundings(rows: DataFrame, asked: DataFrame, window: int, min_words: int) -> DataFrame:
    """The words `before` and `after` the digests at the `places` that are `asked` of a row.

    `asked` has `doc`, `body`, `owner_row` and `places`; gives one row per `owner_row` and `place`.
    """
    gears = _gears()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                octets, ends = chunks(text, window, gears)
                begins, stops = np.concatenate([[0], ends]), reaches(octets, ends)
                found += [(row, p, *_beside(octets, int(begins[p]), int(stops[p]), min_words)) for p in places]
            columns = zip(*found, strict=True) if found else [[]] * 4
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                ["owner_row", "place", "before", "after"],
            )

    texts = _named(rows, asked).join(asked, ["doc", "body"]).select("owner_row", "text", "places")
    beside = texts.mapInArrow(run, "owner_row long, place int, before binary, after binary")
    # The rows of a document that are alike give the same words.
    return beside.groupBy("owner_row", "place").agg(F.min("before").alias("before"), F.min("after").alias("after"))


_WORD = re.compile(rb"\S+")


def extended(octets: bytes, begin: int, stop: int, before: bytes, after: bytes) -> tuple[int, int]:
    """The span with the words to its left and right that are the owner's as well."""
    if before and begin and _SPACE[octets[begin - 1]]:
        low = max(0, begin - 2 * len(before) - WORD_BYTES)
        mine = list(_WORD.finditer(octets, low, begin))
        if low and mine and mine[0].start() == low and not _SPACE[octets[low - 1]]:
            del mine[0]
        for own, word in zip(reversed(mine), reversed(before.split()), strict=False):
            if own.group() != word:
                break
            begin = own.start()
    if after and stop < len(octets) and _SPACE[octets[stop - 1]]:
        for word in after.split():
            own = _WORD.match(octets, stop)
            if not own or own.group() != word:
                break
            stop = own.end()
            while stop < len(octets) and _SPACE[octets[stop]]:
                stop += 1
    return begin, stop


def _passage(words: list[bytes], min_words: int) -> bool:
    unbroken = (len(w.decode("utf-8", "replace")) for w in words if len(w) > NO_BLANK)
    return len(words) >= min_words or sum(unbroken) >= min_words * WORD_CHARS


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap or touch as one, in their order."""
    found: list[tuple[int, int]] = []
    for begin, stop in sorted(spans):
        if found and begin <= found[-1][1]:
            found[-1] = (found[-1][0], max(found[-1][1], stop))
        else:
            found.append((begin, stop))
    return found


def without_copies(
    df: DataFrame,
    key: str,
    text: str,
    window: int = WINDOW,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """`df` with shared passages cut out of `text` everywhere but in the least document.

    Sets `removed`, the byte spans cut out of the text, and `owners`, the
    documents that these were compared with; both are empty where nothing was
    cut, and replace columns of these names. All that is cut out stands in an
    earlier document, whole words, `min_words` at least, however few of them
    differ. A few words may stay where a passage goes over into one of another
    owner, or where it repeats itself without end. Repeats within one document
    stay, as do copies of fewer words. NULL texts stay NULL, rows with a NULL key
    are not touched, rows that share a key count as one document, and a table
    without rows gives none.
    """
    rows = boxed(df, doc=F.col(key), body=F.xxhash64(text), text=F.col(text))
    chunked = chunk_digests(rows.filter("doc is not null"), window)
    found = written(chunked.withColumn("row", F.monotonically_increasing_id()), "chunks")
    # Written, so that the join below splits the chunks that very many documents share.
    shared = written(shared_chunks(found), "shared")
    runs = written(copied_runs(written(shared_places(found, shared), "places")), "runs")
    known = found.select("row", "doc", "body")
    edge = F.explode(
        F.flatten(
            F.transform(
                "runs",
                lambda r: F.array(
                    F.struct(r["owner_row"].alias("owner_row"), r["head"].alias("place")),
                    F.struct(r["owner_row"].alias("owner_row"), r["tail"].alias("place")),
                ),
            )
        )
    )
    edges = written(runs.select("row", edge.alias("edge")).select("row", "edge.*").distinct(), "edges")
    asked = edges.groupBy("owner_row").agg(F.collect_set("place").alias("places"))
    asked = written(asked.join(known.withColumnRenamed("row", "owner_row"), "owner_row"), "asked")
    beside = written(surroundings(rows, asked, window, min_words), "beside")
    met = edges.join(beside, ["owner_row", "place"]).groupBy("row").agg(
        F.collect_list(F.struct("owner_row", "place", "before", "after")).alias("beside")
    )
    copied = runs.join(met, "row").join(known, "row").drop("row").dropDuplicates(["doc", "body"])
    copied = written(copied, "copied")
    cut = _cutter(window, min_words)
    done = computed_once(
        _named(rows, copied).join(copied, ["doc", "body"], "left"), "cut", cut("text", "runs", "beside")
    )
    owners = F.array_sort(F.array_distinct(F.transform("cut.used", lambda n: F.get("runs", n)["owner"])))
    list_of_keys = f"array<{df.schema[key].dataType.simpleString()}>"
    no_owner = F.array().cast(list_of_keys)
    cleared = done.select("_row", "cut.kept", "cut.removed", F.coalesce(owners, no_owner).alias("owners"))
    nothing = F.array().cast(cleared.schema["removed"].dataType)
    others = _named(rows, copied, there=False).select(
        "_row", F.col("text").alias("kept"), nothing.alias("removed"), no_owner.alias("owners")
    )
    changed = {text: F.col("kept"), "removed": F.col("removed"), "owners": F.col("owners")}
    return cleared.unionByName(others).select(*unboxed(df.columns, **changed))


def _cutter(window: int, min_words: int):
    gears = _gears()

    def spans(octets: bytes, ends: np.ndarray, runs, beside) -> tuple[list[tuple[int, int]], list[int]]:
        begins, stops = np.concatenate([[0], ends]), reaches(octets, ends)
        words = {(b["owner_row"], b["place"]): b for b in beside}
        gone, used = [], {}
        for n, run in enumerate(runs):
            before = words[run["owner_row"], run["head"]]["before"]
            after = words[run["owner_row"], run["tail"]]["after"]
            begin, stop = extended(octets, int(begins[run["first"]]), int(stops[run["last"]]), before, after)
            if _passage(octets[begin:stop].split(), min_words):
                gone.append((begin, stop))
                used.setdefault(run["owner_row"], n)
        return united(gone), list(used.values())

    @F.pandas_udf("struct<kept:string,removed:array<struct<start:int,stop:int>>,used:array<int>>")
    def cut(texts, runs, beside):
        import pandas as pd

        kept, removed, owners = [], [], []
        for body, copied, words in zip(texts, runs, beside, strict=True):
            gone, used = [], []
            if body is not None and copied is not None:
                octets, ends = chunks(body, window, gears)
                gone, used = spans(octets, ends, copied, words)
            if gone:
                edges = [0, *(e for span in gone for e in span), len(octets)]
                parts = (octets[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                body = b"".join(parts).decode("utf-8", "surrogatepass")
            kept.append(body)
            removed.append([{"start": a, "stop": b} for a, b in gone])
            owners.append(used)
        return pd.DataFrame({"kept": kept, "removed": removed, "used": owners})

    return cut
