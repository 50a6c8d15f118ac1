"""Packing of documents into sequences whose sources keep to target shares.

Three passes. The first encodes every document once and writes blocks of about
a million ids with the count of ids per source. The counts alone give the
schedule: how many ids of every source belong before each border between the
blocks to be packed. The second pass cuts the documents at these borders and
deals them out, so that every packed block gets its share of every source,
however the input was ordered. The third fills the sequences of a block: every
sequence credits each source with its share, and the source that is owed most
is served next, what it is owed and a packet at most, until the sequence is
full. Where a source has run out, the others share what was its part.

No piece is shorter than the least packet, unless its document or sequence has
no more, so a sequence may hold more or less of a source than its share. What
a source is owed then, or has had too much, is carried to the next sequence.
Blocks are dealt whole least packets of every source but one, and begin with
what the schedule owes their sources there, so deficits cross blocks, and with
them partitions, though every block is packed alone.

All packed blocks but the last hold whole sequences; what is left at the end
fills sequences whose lengths are powers of two, so none needs padding.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.tokens import ByteTokenizer
from gleanery.scale import WIDE_ROWS, written

WINDOW = 1024

#: Most ids served to a source at a time.
PACKET = 256

#: Ids of a block, give or take the last document.
BLOCK_IDS = 1 << 20

#: Blocks are dealt smaller packets where sources are so many that this many of each fill a block.
BLOCK_PACKETS = 16

#: Id that ends every document.
END = 0

_BLOCK = (
    "part long, block long, docs array<{key}>, queues array<string>, lengths array<long>, "
    "sources array<string>, counts array<long>, ids binary"
)
_PIECE = {
    "source": "string", "start": "long", "length": "long", "ids": "binary", "doc_tokens": "long",
    "sequence_id": "long", "offset": "long",
}


def encoded_blocks(
    df: DataFrame, key: str, text: str, source: str, tokenizer: str, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Blocks of whole documents: their keys, queues and lengths, and all their ids.

    Ids take two bytes each where the vocabulary allows it, else four.
    """
    queue = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    rows = df.select(F.col(key).alias("doc"), queue.alias("queue"), F.col(text).alias("text"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokenizer(tokenizer)
        width = np.dtype("<u2" if tokens.size <= 1 << 16 else "<u4")
        part = TaskContext.get().partitionId()
        block, docs, queues, arrays, held = 0, [], [], [], 0

        def full() -> pa.RecordBatch:
            lengths = [len(a) for a in arrays]
            totals: dict[str, int] = {}
            for name, n in zip(queues, lengths, strict=True):
                totals[name] = totals.get(name, 0) + n
            row = [
                [part], [block], [docs], [queues], [lengths], [list(totals)],
                [list(totals.values())], [np.concatenate(arrays).tobytes()],
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, schema.types, strict=True)], schema.names
            )

        schema = None
        for batch in batches:
            schema = schema or pa.schema(
                [
                    ("part", pa.int64()), ("block", pa.int64()),
                    ("docs", pa.list_(batch.schema.field(0).type)),
                    ("queues", pa.list_(pa.string())), ("lengths", pa.list_(pa.int64())),
                    ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64())),
                    ("ids", pa.binary()),
                ]
            )
            for doc, name, body in zip(*batch.columns, strict=True):
                ids = tokens.encode(body.as_py() or "")
                ids.append(END)
                docs.append(doc.as_py())
                queues.append(name.as_py())
                arrays.append(np.array(ids, width))
                held += len(ids)
                if held >= block_ids:
                    yield full()
                    block, docs, queues, arrays, held = block + 1, [], [], [], 0
        if docs:
            yield full()

    return rows.mapInArrow(run, _BLOCK.format(key=kind))


def lengths_of(total: int, window: int = WINDOW) -> list[int]:
    """Lengths of the sequences that `total` ids fill: whole windows, then powers of two."""
    rest = total % window
    return [window] * (total // window) + [
        1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1
    ]


def fill(
    queues: list[str],
    lengths: list[int],
    credit: Mapping[str, tuple[float, float]],
    window: int = WINDOW,
    packet: int = PACKET,
    least: int = 1,
) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one block, every id in one of them.

    `credit` holds the share of every source and what it is owed at the start.
    """
    least = min(least, packet)
    names = list(dict.fromkeys(queues))
    place = {name: n for n, name in enumerate(names)}
    waiting: list[list[int]] = [[] for _ in names]
    for doc in range(len(queues) - 1, -1, -1):
        waiting[place[queues[doc]]].append(doc)
    share = np.array([credit[name][0] for name in names])
    owed = np.array([credit[name][1] for name in names])
    counts = np.zeros(len(names))
    np.add.at(counts, [place[name] for name in queues], lengths)
    part = _parts(share, counts)
    done = [0] * len(queues)
    pieces: list[tuple[int, int, int, int, int]] = []
    for sequence, size in enumerate(lengths_of(sum(lengths), window)):
        owed += part * size
        offset = 0
        while offset < size:
            at = int(owed.argmax())
            doc = waiting[at][-1]
            start = done[doc]
            space = min(size - offset, lengths[doc] - start)
            taken = min(packet, max(least, round(owed[at])), space)
            # Nothing shorter than the least packet is left of the document or of the sequence.
            if lengths[doc] - start - taken < least or size - offset - taken < least:
                taken = space
            last = pieces[-1] if offset else None
            if last and last[0] == doc:
                pieces[-1] = (doc, last[1], last[2] + taken, sequence, last[4])
            else:
                pieces.append((doc, start, taken, sequence, offset))
            offset += taken
            owed[at] -= taken
            done[doc] = start + taken
            if done[doc] == lengths[doc]:
                waiting[at].pop()
                if not waiting[at]:
                    counts[at] = 0
                    part = _parts(share, counts)
                    left = owed[at]
                    owed[at] = -np.inf
                    owed += part * left
    return pieces


def _parts(share: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Shares of the sources that have ids left; by their counts where none of them has a share."""
    part = np.where(counts > 0, share, 0.0)
    part = part if part.any() else counts
    return part / (part.sum() or 1)


class Schedule:
    """How many ids of every source lie before each border between the blocks to be packed.

    Every source but one gets whole units; what it is owed beyond them at a border it is owed still
    at the start of the next block.
    """

    def __init__(
        self,
        totals: Mapping[str, int],
        targets: Mapping[str, float] | None,
        block: int,
        unit: int = 1,
    ):
        self.block = block
        self.unit = max(1, min(unit, block // (BLOCK_PACKETS * max(1, len(totals)))))
        self.names = sorted(totals)
        self.totals = np.array([totals[n] for n in self.names], np.int64)
        weights = self.totals if targets is None else [targets.get(n, 0.0) for n in self.names]
        weights = np.array(weights, np.float64)
        self.shares = dict(zip(self.names, (weights / (weights.sum() or 1)).tolist(), strict=True))
        rest = self.totals.astype(np.float64)
        times, done = [0.0], [np.zeros(len(rest))]
        while rest.any():
            part = _parts(weights, rest)
            lasts = np.where(part > 0, rest / np.where(part > 0, part, 1), np.inf)
            step = lasts.min()
            out = lasts <= step * (1 + 1e-9)
            rest = np.where(out, 0.0, np.maximum(rest - part * step, 0.0))
            times.append(times[-1] + step)
            done.append(self.totals - rest)
            self.filler = int(np.argmax(np.where(out, self.totals, -1)))
        self.times, self.done = np.array(times), np.array(done)
        self._last: tuple[str, np.ndarray] | None = None

    def due(self, name: str, block: int) -> float:
        """Ids of a source that belong before a block by its share, fractions included."""
        at = min(block * self.block, self.totals.sum())
        return float(np.interp(at, self.times, self.done[:, self.names.index(name)]))

    def _of(self, number: int, cuts: np.ndarray) -> np.ndarray:
        found = np.interp(cuts, self.times, self.done[:, number])
        total = self.totals[number]
        # A source that has run out has no later block to be given the rest of a unit in.
        return np.where(found > total - 0.5, total, found // self.unit * self.unit).astype(np.int64)

    def borders(self, name: str) -> np.ndarray:
        """Ids of a source before each border.

        The source that lasts longest takes what rounding leaves, so that the blocks are whole.
        Only the borders of one source are held, and none travel with the job.
        """
        if self._last is None or self._last[0] != name:
            number, every = self.names.index(name), self.totals.sum()
            cuts = np.arange(0, every + self.block, self.block).clip(max=every)
            if number == self.filler:
                found = cuts.copy()
                for other in range(len(self.names)):
                    if other != number:
                        found -= self._of(other, cuts)
                found = found.clip(0, self.totals[number])
            else:
                found = self._of(number, cuts)
            found[-1] = self.totals[number]
            self._last = (name, np.maximum.accumulate(found))
        return self._last[1]


def own_starts(blocks: DataFrame) -> DataFrame:
    """For every written block the ids of each of its sources in the blocks before it."""
    counted = blocks.select(
        "part", "block", F.inline(F.arrays_zip(F.col("sources").alias("queue"), F.col("counts").alias("n")))
    )
    unbounded = (Window.unboundedPreceding, -1)
    # One row per input partition and source, so these windows stay small.
    of_source = Window.partitionBy("queue").orderBy("part").rowsBetween(*unbounded)
    in_part = Window.partitionBy("part", "queue").orderBy("block").rowsBetween(*unbounded)
    before = counted.groupBy("part", "queue").agg(F.sum("n").alias("n")).select(
        "part", "queue", F.coalesce(F.sum("n").over(of_source), F.lit(0)).alias("before")
    )
    own = F.col("before") + F.coalesce(F.sum("n").over(in_part), F.lit(0))
    return (
        counted.join(before, ["part", "queue"])
        .withColumn("own", own)
        .groupBy("part", "block")
        .agg(F.map_from_entries(F.collect_list(F.struct("queue", "own"))).alias("before"))
    )


def dealt(blocks: DataFrame, schedule: Schedule) -> DataFrame:
    """`block`, the block to be packed, and its `slices`: runs of one source from a written block."""
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    rows = blocks.join(written(own_starts(blocks), "starts"), ["part", "block"]).select(
        "docs", "queues", "lengths", "ids", F.map_entries("before").alias("before")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                docs, queues, lengths, ids, before = (column[at].as_py() for column in batch.columns)
                found = list(cut(docs, queues, lengths, ids, before))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types(batch), strict=True)],
                    ["block", "queue", "at", "docs", "starts", "lengths", "tokens", "ids"],
                )

    def types(batch: pa.RecordBatch) -> list[pa.DataType]:
        many = pa.list_(pa.int64())
        return [
            pa.int64(), pa.string(), pa.int64(), pa.list_(batch.schema.field(0).type.value_type),
            many, many, many, pa.binary(),
        ]

    def cut(docs, queues, lengths, ids, before) -> Iterator[tuple]:
        size = np.array(lengths, np.int64)
        every = np.frombuffer(ids, f"<u{len(ids) // size.sum()}")
        begin = np.cumsum(size) - size
        names = np.array(queues, object)
        for entry in before:
            mine = np.flatnonzero(names == entry["key"])
            borders = schedule.borders(entry["key"])
            stop = entry["value"] + np.cumsum(size[mine])
            start = stop - size[mine]
            first = int(np.searchsorted(borders, start[0], "right")) - 1
            last = int(np.searchsorted(borders, stop[-1], "left"))
            for block in range(first, last):
                low, high = borders[block], borders[block + 1]
                if low == high:
                    continue
                inside = slice(np.searchsorted(stop, low, "right"), np.searchsorted(start, high, "left"))
                chosen, own = mine[inside], start[inside]
                a = np.maximum(own, low) - own
                b = np.minimum(stop[inside], high) - own
                parts = [every[x + y : x + z] for x, y, z in zip(begin[chosen], a, b, strict=True)]
                yield (
                    block, entry["key"], int(own[0] + a[0]), [docs[n] for n in chosen], a.tolist(),
                    (b - a).tolist(), size[chosen].tolist(), np.concatenate(parts).tobytes(),
                )

    slices = rows.mapInArrow(
        run,
        f"block long, queue string, at long, docs array<{kind}>, starts array<long>, "
        "lengths array<long>, tokens array<long>, ids binary",
    )
    columns = [c for c in slices.columns if c != "block"]
    return slices.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias("slices"))


def pack(
    df: DataFrame,
    key: str,
    text: str,
    source: str,
    tokenizer: str,
    targets: Mapping[str, float] | None = None,
    window: int = WINDOW,
    packet: int = PACKET,
    block_ids: int = BLOCK_IDS,
    least: int = 1,
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and its ids.

    `ids` holds the ids as little-endian unsigned 32-bit numbers. A document
    is the ids of its text and a final 0; NULL and empty texts are that 0
    alone. Rows with equal or NULL keys are documents of their own; a NULL
    source is a queue of its own. A table without rows gives none. The key may
    be of any type that Arrow takes; where it is named like a column of the
    pieces, that column is called `piece_` and its name. No other column of
    `df` is kept, whatever its name.

    With `least` 1 every sequence holds the share of each source to an id or
    so; a greater number makes fewer and longer pieces, and deficits of up to
    a packet are carried from sequence to sequence.
    """
    kind = df.schema[key].dataType.simpleString()
    names = {f"piece_{c}" if c.lower() == key.lower() else c: t for c, t in _PIECE.items()}
    blocks = written(encoded_blocks(df, key, text, source, tokenizer, block_ids), "blocks", WIDE_ROWS)
    counted = blocks.select(F.inline(F.arrays_zip(F.col("sources").alias("queue"), F.col("counts").alias("n"))))
    totals = {r.queue: r.n for r in counted.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    named = None if targets is None else {f"={name}": weight for name, weight in targets.items()}
    schedule = Schedule(totals, named, max(1, block_ids // window) * window, min(least, packet))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                slices = sorted(batch.column(1)[at].as_py(), key=lambda s: (s["queue"], s["at"]))
                key_type = batch.schema.field(1).type.value_type.field("docs").type.value_type
                yield packed(batch.column(0)[at].as_py(), slices, key_type)

    def packed(block, slices, key_type: pa.DataType) -> pa.RecordBatch:
        docs, starts, lengths, tokens = (
            [x for s in slices for x in s[name]] for name in ("docs", "starts", "lengths", "tokens")
        )
        queues = [s["queue"] for s in slices for _ in s["docs"]]
        total = sum(lengths)
        ids = b"".join(s["ids"] for s in slices)
        every = np.frombuffer(ids, f"<u{len(ids) // total}").astype("<u4")
        begin = np.concatenate([[0], np.cumsum(lengths)])
        # The first slice of a source begins at its border, so this is what the border left owing.
        firsts = {s["queue"]: s["at"] for s in reversed(slices)}
        credit = {
            name: (schedule.shares[name], schedule.due(name, block) - first)
            for name, first in firsts.items()
        }
        pieces = fill(queues, lengths, credit, window, packet, least)
        doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*pieces, strict=True))
        first = begin[doc] + start
        chosen = [every[a : a + n].tobytes() for a, n in zip(first, length, strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([docs[d] for d in doc], key_type),
                pa.array([queues[d][1:] if queues[d] else None for d in doc], pa.string()),
                pa.array(np.array(starts, np.int64)[doc] + start),
                pa.array(length),
                pa.array(chosen, pa.binary()),
                pa.array(np.array(tokens, np.int64)[doc]),
                pa.array((np.int64(block) << 20) + sequence),
                pa.array(offset),
            ],
            [key, *names],
        )

    quoted = key.replace("`", "``")
    columns = ", ".join([f"`{quoted}` {kind}", *(f"{c} {t}" for c, t in names.items())])
    return dealt(blocks, schedule).mapInArrow(run, columns)
