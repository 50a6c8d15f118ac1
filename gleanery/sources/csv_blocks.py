"""Records of CSV files, cut by every task out of its own block.

Whether a line end closes a record depends on the quotes before it in its file,
but of a block only their number being odd or even matters: a block is a
transition between two states, outside and inside a quoted field. A first pass
reduces every block to what it is from either state: the state it leaves behind,
its faults, its head up to the first end of a record and its tail behind the last
one. The transitions are composed over the blocks of each file; a second pass then
cuts the records, a block by itself. Only heads and tails meet those of other
blocks, to make the records that cross a border.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.scale import BROADCAST_BYTES, written

# The functions below travel with the job, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE, COMMA, LINE, RETURN = b'",\n\r'

#: States before a line: what a block is reduced to is worked out from both.
OUTSIDE, INSIDE = STATES = range(2)

#: Bytes that a record may have, so that a stray quote cannot make one of half a file.
LONGEST_RECORD = 4 << 20

#: Bytes that a block's key and state take in a broadcast table.
KNOWN_BYTES = 64

SUMMARY = (
    "file string, key long, block long, flips int, strays array<long>, longest array<long>, "
    "ends array<long>, head array<binary>, tail array<binary>"
)


def _octets(lines: pa.Array) -> np.ndarray:
    """The lines, each with its end, as one piece."""
    nothing, end = (pa.scalar(octets, pa.large_binary()) for octets in (b"", b"\n"))
    ended = pc.binary_join_element_wise(lines.cast(pa.large_binary()), nothing, end)
    offsets = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset :]
    return np.frombuffer(ended.buffers()[2], np.uint8)[offsets[0] : offsets[len(ended)]]


def _ends(octets: np.ndarray, quotes: np.ndarray, state: int) -> np.ndarray:
    """Places of the line ends outside quotes."""
    ends = np.flatnonzero((octets == LINE) | (octets == RETURN))
    return ends[(np.searchsorted(quotes, ends) + state) % 2 == 0]


def _strays(octets: np.ndarray, quotes: np.ndarray, state: int) -> int:
    """Quotes that open a field behind a character of it, or close it before one.

    The octets begin and end a line, so every quote's neighbours are there.
    """
    opening, closing = quotes[state::2], quotes[1 - state :: 2]
    before = octets[np.maximum(opening, 1) - 1]
    good = np.isin(before, (COMMA, LINE, RETURN, QUOTE)) | (opening == 0)
    after = octets[closing + 1]
    return int((~good).sum() + (~np.isin(after, (COMMA, LINE, RETURN, QUOTE))).sum())


class _Summary:
    """What a block is from one of the two states, as its lines pass."""

    def __init__(self, state: int, most: int):
        self.state, self.most = state, most
        self.strays = self.longest = self.ends = self.open = 0
        self.head: list[bytes] = []
        self.tail: list[bytes] = []

    def _kept(self, held: list[bytes], part: np.ndarray) -> None:
        # What is over the limit is an error if this state is the true one.
        if self.open <= self.most:
            held.append(part.tobytes())

    def add(self, octets: np.ndarray, quotes: np.ndarray) -> None:
        ends = _ends(octets, quotes, self.state)
        self.strays += _strays(octets, quotes, self.state)
        self.state = (self.state + len(quotes)) % 2
        if not len(ends):
            self.open += len(octets)
            self._kept(self.tail if self.ends else self.head, octets)
            self.longest = max(self.longest, self.open)
            return
        self.open += int(ends[0]) + 1
        if not self.ends:
            self._kept(self.head, octets[: ends[0] + 1])
        self.longest = max(self.longest, self.open, int(np.diff(ends).max(initial=0)))
        self.ends += len(ends)
        self.open = len(octets) - int(ends[-1]) - 1
        self.tail = []
        self._kept(self.tail, octets[ends[-1] + 1 :])
        self.longest = max(self.longest, self.open)


def _runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Stretches of rows with one `key`, and whether it is a new one."""
    before = None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a < b:
                yield keys[a] != before, batch.slice(a, b - a)
                before = keys[a]


def _summaries(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict | None = None

        def handed() -> pa.RecordBatch:
            both = found.pop("both")
            lists = {
                "strays": [s.strays for s in both],
                "longest": [s.longest for s in both],
                "ends": [s.ends for s in both],
                "head": [b"".join(s.head) for s in both],
                "tail": [b"".join(s.tail) for s in both],
            }
            row = {**found, "flips": both[OUTSIDE].state, **lists}
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32()]
            types += [pa.list_(pa.int64())] * 3 + [pa.list_(pa.binary())] * 2
            names = ["file", "key", "block", "flips", *lists]
            return pa.RecordBatch.from_arrays(
                [pa.array([row[n]], t) for n, t in zip(names, types, strict=True)], names
            )

        for new, part in _runs(batches, "key"):
            if new:
                if found:
                    yield handed()
                found = {name: part.column(name)[0].as_py() for name in ("file", "key", "block")}
                found["both"] = [_Summary(s, most) for s in STATES]
            octets = _octets(part.column("value"))
            quotes = np.flatnonzero(octets == QUOTE)
            for summary in found["both"]:
                summary.add(octets, quotes)
        if found:
            yield handed()

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records that lie in one block as a whole, without the header."""
    state, skip, held = OUTSIDE, False, []
    for new, part in _runs(batches, "key"):
        if new:
            state = part.column("state")[0].as_py()
            # A block's first piece is the end of a record before it, or the header.
            skip, held = bool(state or part.column("first")[0].as_py()), []
        octets = _octets(part.column("value"))
        quotes = np.flatnonzero(octets == QUOTE)
        ends = _ends(octets, quotes, state)
        state = (state + len(quotes)) % 2
        if not len(ends):
            held.append(octets)
            continue
        stops = ends + 1
        whole = np.concatenate([*held, octets[: stops[-1]]])
        before = sum(map(len, held))
        held = [octets[stops[-1] :]]
        offsets = np.concatenate([[0], stops + before]).astype(np.int64)
        if skip:
            offsets, skip = offsets[1:], False
        pieces = pa.LargeStringArray.from_buffers(
            len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(whole)
        )
        # Outside quotes nothing but the end of the record can be a line end.
        records = pc.ascii_rtrim(pieces, "\n\r")
        records = records.filter(pc.not_equal(records, "")).cast(pa.string())
        if len(records):
            yield pa.RecordBatch.from_arrays([records], ["record"])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files in order, with the block of bytes they lie in and a key for it."""
    place = ("file_path", "file_block_start", "file_block_length")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.xxhash64(*[F.col(f"_metadata.{name}") for name in place]).alias("key"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def _states(blocks: DataFrame) -> DataFrame:
    """The blocks without their texts, with the states that the blocks before them lead to.

    `state` is the one before the block and `after` the one behind it. A block
    is `through` if all of it is the inside of one record, `begun` if a record
    begins in it and goes on, `last` if no other follows in its file. `origin`
    is the block in which the record begins that the block begins within.
    """
    in_order = Window.partitionBy("file").orderBy("block")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    state = (F.coalesce(F.sum("flips").over(earlier), F.lit(0)) % 2).cast("int")
    known = blocks.select("file", "key", "block", "flips", "strays", "longest", "ends", state.alias("state"))
    own = {name: F.col(name)[F.col("state")] for name in ("strays", "longest", "ends")}
    through = (F.col("state") == INSIDE) & (own["ends"] == 0)
    after = (F.col("state") + F.col("flips")) % 2
    told = known.select(
        "file",
        "key",
        "block",
        "state",
        after.alias("after"),
        ((after == INSIDE) & ~through).alias("begun"),
        F.lead("block").over(in_order).isNull().alias("last"),
        *[value.alias(name) for name, value in own.items()],
    )
    begun = F.when(F.col("begun"), F.col("block"))
    return told.withColumn("origin", F.last(begun, ignorenulls=True).over(earlier))


def _placed(lines: DataFrame, known: DataFrame, n: int, broadcast_bytes: int) -> DataFrame:
    """Lines with what is known of their block, still in order.

    `known` has `n` rows of three numbers: broadcast if that is little enough.
    Beyond that the blocks are shuffled, each a key of as many rows as a task
    reads anyway.
    """
    if n * KNOWN_BYTES <= broadcast_bytes:
        return lines.join(F.broadcast(known), "key", "left")
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    return numbered.join(known, "key", "left").repartition("key").sortWithinPartitions("key", "line")


def records(
    spark: SparkSession,
    path: str,
    longest_record: int = LONGEST_RECORD,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The records of CSV files as one column `record`, without the header record of each file.

    The files are read twice, once when this is called; lines are not shuffled
    or written. A quoted field that never ends, a quote inside an unquoted
    field and a record of more than `longest_record` bytes fail by the names
    of the files. Blank lines are no records.
    """
    lines = _lines(spark, path)
    blocks = written(lines.mapInArrow(_summaries(longest_record), SUMMARY), "csv-blocks")
    states = _states(blocks)
    faults = {
        "a quoted field never ends": (F.col("after") == INSIDE) & F.col("last"),
        "a quote inside an unquoted field": F.col("strays") > 0,
        f"a record of more than {longest_record} bytes": F.col("longest") > longest_record,
    }
    seen = states.agg(
        F.count(F.lit(1)).alias("blocks"),
        F.count_distinct("key").alias("keys"),
        F.count_if("begun").alias("begun"),
        *[F.count_if(fault).alias(name) for name, fault in faults.items()],
    ).first()
    for name, fault in faults.items():
        if seen[name]:
            files = states.filter(fault).select("file").distinct().limit(3).collect()
            raise ValueError(f"{name} in " + ", ".join(sorted(row.file for row in files)))
    if seen.blocks != seen.keys:
        raise ValueError("two blocks have the same key; read the files apart")

    known = states.select("key", "state", (F.col("block") == 0).alias("first"))
    placed = _placed(lines.select("key", "value"), known, seen.blocks, broadcast_bytes)
    moved = F.raise_error(F.lit("the files or the size of their parts changed since they were counted"))
    inside = placed.select(
        "key", F.coalesce("state", moved.cast("int")).alias("state"), "first", "value"
    ).mapInArrow(_cut, "record string")
    if not seen.begun:
        return inside
    return inside.unionByName(_crossing(blocks, states, longest_record))


def _crossing(blocks: DataFrame, states: DataFrame, longest_record: int) -> DataFrame:
    """Records that lie in more than one block.

    One begins in the tail of a block that is left inside a field, goes on
    through blocks without an end of a record, and ends in a head.
    """
    parts = blocks.select("key", "head", "tail").join(
        states.filter((F.col("state") == INSIDE) | F.col("begun")).drop("strays", "longest"), "key"
    )
    state = F.col("state")
    without_end = F.col("ends") == 0
    # The header, if no record ends in the first block of a file.
    header = (F.col("block") == 0) & without_end
    whole = F.when(without_end, F.col("head")[state]).otherwise(F.col("tail")[state])

    def part(octets: Column, origin: Column, header: Column) -> Column:
        return F.struct(origin.alias("origin"), F.col("block"), octets.alias("part"), header.alias("header"))

    head = F.when(state == INSIDE, part(F.col("head")[state], F.col("origin"), F.lit(False)))
    tail = F.when(F.col("begun"), part(whole, F.col("block"), header))
    pieces = parts.select("file", F.inline(F.array_compact(F.array(head, tail))))
    joined = pieces.groupBy("file", "origin").agg(
        F.array_sort(F.collect_list(F.struct("block", "part"))).alias("parts"),
        F.sum(F.octet_length("part")).alias("size"),
        F.bool_or("header").alias("header"),
    )
    text = F.array_join(F.transform("parts", lambda p: p["part"].cast("string")), "")
    over = F.concat(F.lit(f"a record of more than {longest_record} bytes in "), F.col("file"))
    record = F.when(F.col("size") > longest_record, F.raise_error(over)).otherwise(
        F.rtrim(text, F.lit("\n\r"))
    )
    return joined.filter("NOT header").select(record.alias("record")).filter("record <> ''")
