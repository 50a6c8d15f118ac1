"""Conversation structure repair: the cheapest edits that make turns alternate, by Hirschberg's method.

A conversation is to be nothing, or an optional system turn and then pairs of a user
and an assistant turn. That is an automaton of four states, so between two places of
a conversation all that matters is what it costs to get from each state to each. The
rows before the middle give the costs of reaching every state there, the rows behind
it those of ending well from there. The cheapest state in the middle is on the best
way, and both halves are solved likewise from then on: space grows with the rows, not
with rows times states. Among equally cheap states the one with the least audit up to
the middle is taken. Its audit is not kept for that: audits to different states differ
and none begins with another, so the order of four audits is carried from row to row.

Rows lie in sorted ranges. A conversation may be all of many ranges: the rows of one
range are then reduced to sixteen costs and orders, from which the states at its ends
are found by the same method, and each range is repaired by itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import whole_groups
from gleanery.scale import written

# Costs of the edits by their initials, and of a cut-off row that stays.
COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}
TRUNCATED = 3

# Nothing yet; after the system turn; after a user turn; after an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = STATES = range(4)
ENDS = (NOTHING, ASSISTANT)
FAR = 1 << 60

#: Faults of a row, the first that holds counts.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)
FAULTS = 4

# A row as far as edits depend on it is a number: FAULTS times the place of its role's initial
# among these, from 1, or 0, plus its fault.
INITIALS = "sua"

#: From each state to each: the cost, and the place of the audit among those from that state.
Table = tuple[tuple[tuple[int, object], ...], ...]


def _said(state: int) -> int:
    """What an inserted or reroled row makes of a state: the turn that is due."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: int) -> int | None:
    if initial == 1:
        return SYSTEM if state == NOTHING else None
    if initial == 2:
        return USER if state != USER else None
    return ASSISTANT if initial == 3 and state == USER else None


@cache
def step(row: int | None) -> Table:
    """Cheapest (cost, audit) over one row from each state to each; None is the end, which only inserts.

    Two inserts lead to every state that inserts reach, so more are never needed.
    """
    found: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(a: int, b: int, cost: int, audit: str) -> None:
        found[a, b] = min(found.get((a, b), (FAR, "")), (cost, audit))

    for a, inserts in product(STATES, range(3)):
        b, cost, audit = a, COSTS["I"] * inserts, "I" * inserts
        for _ in range(inserts):
            b = _said(b)
        if row is None:
            offer(a, b, cost, audit)
            continue
        initial, fault = divmod(row, FAULTS)
        offer(a, b, cost + COSTS["D"], audit + "D")
        if fault in (BLANK, DUPLICATE):
            continue
        extra = TRUNCATED if fault == CUT_OFF else 0
        kept = _kept(b, initial)
        if kept is not None:
            offer(a, kept, cost + COSTS["K"] + extra, audit + "K")
        offer(a, _said(b), cost + COSTS["R"] + extra, audit + "R")
    return tuple(tuple(found.get((a, b), (FAR, "")) for b in STATES) for a in STATES)


def forward(tables: Sequence[Table], start: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Cost of every state behind the tables, and the place of its audit among the four."""
    costs = list(start)
    for table in tables:
        best = [
            min(
                (costs[a][0] + table[a][b][0], costs[a][1], table[a][b][1])
                for a in STATES
                if costs[a][0] < FAR
            )
            for b in STATES
        ]
        order = sorted(STATES, key=lambda b: best[b][1:])
        places = {b: n for n, b in enumerate(order)}
        costs = [(min(best[b][0], FAR), places[b]) for b in STATES]
    return costs


def backward(tables: Sequence[Table], ends: Sequence[int]) -> list[int]:
    """Cost of ending in one of `ends` from every state before the tables."""
    costs = [0 if s in ends else FAR for s in STATES]
    for table in reversed(tables):
        costs = [min(min(table[a][b][0] + costs[b] for b in STATES), FAR) for a in STATES]
    return costs


def only(state: int) -> list[tuple[int, int]]:
    return [(0 if s == state else FAR, s) for s in STATES]


def crossings(tables: Sequence[Table], start: int, ends: Sequence[int]) -> list[int]:
    """State behind every table on the cheapest way from `start` to one of `ends`, of the least audit."""
    states = [start] * (len(tables) + 1)
    halves = [(0, len(tables), tuple(ends))]
    while halves:
        low, high, wanted = halves.pop()
        middle = (low + high) // 2 if high - low > 1 else high
        reached = forward(tables[low:middle], only(states[low]))
        left = backward(tables[middle:high], wanted)
        states[middle] = min(STATES, key=lambda s: (reached[s][0] + left[s], reached[s][1]))
        if high - low > 1:
            # The left half first: the right one begins with the state found in the middle.
            halves.append((middle, high, wanted))
            if middle - low > 1:
                halves.append((low, middle, (states[middle],)))
    return states[1:]


def composed(tables: Sequence[Table]) -> Table:
    """All tables as one: costs from each state to each, and the order of the audits from each."""
    return tuple(tuple(forward(tables, only(a))) for a in STATES)


@lru_cache(50_000)
def _short(rows: tuple[int, ...], start: int, ends: tuple[int, ...], last: bool) -> tuple[str, ...]:
    return tuple(_audits(rows, start, ends, last))


def audits_of(rows: Sequence[int], start: int, ends: Sequence[int], last: bool) -> Sequence[str]:
    """Edits of every row, inserts before it included, and for the last one of all those behind it.

    Conversations of a few rows repeat and are looked up.
    """
    solve = _short if len(rows) <= 12 else _audits
    return solve(tuple(rows), start, tuple(ends), last)


def _audits(rows: Sequence[int], start: int, ends: Sequence[int], last: bool) -> list[str]:
    tables = [step(r) for r in rows] + [step(None)] * last
    audits, state = [], start
    for table, reached in zip(tables, crossings(tables, start, ends), strict=True):
        audits.append(table[state][reached][1])
        state = reached
    if last:
        behind = audits.pop()
        audits[-1] += behind
    return audits


def roles_after(audits: Sequence[str], rows: Sequence[int], state: int) -> list[list[str | None]]:
    """Per row the roles of the turns its edits leave, None where it keeps its own."""
    result = []
    for audit, row in zip(audits, rows, strict=True):
        roles: list[str | None] = []
        for edit in audit:
            if edit == "D":
                continue
            if edit == "K":
                roles.append(None)
                state = _kept(state, row // FAULTS)
            else:
                state = _said(state)
                roles.append("user" if state == USER else "assistant")
        result.append(roles)
    return result


def damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with faults that the checksum of their keys chooses, as the columns conv, turn, role, text.

    One in twenty each is dropped, emptied, left without ends of sentences,
    repeated or made a user's. NULL keys count as a space in the checksum and
    stay NULL; a NULL role or text is a space.
    """
    blank = F.lit(" ")
    names = [F.coalesce(F.col(f"`{c}`").cast("string"), blank) for c in (conv, turn)]
    number = F.crc32(F.encode(F.concat_ws(":", *names), "utf-8")) % 20
    given = df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), blank).alias("role"),
        F.coalesce(F.col(f"`{text}`"), blank).alias("text"),
        number.alias("number"),
    ).filter("number <> 0")
    copies = F.explode(F.array_repeat(F.col("number"), F.when(F.col("number") == 3, 2).otherwise(1)))
    return given.select(
        "conv",
        "turn",
        F.when(F.col("number") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("number") == 1, "")
        .when(F.col("number") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        copies.alias("_"),
    ).drop("_")


WHITE = " \t\n\x0b\x0c\r"


def in_order(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows conv, turn, role, text in sorted ranges with `slot`, their order, and `segment`; written.

    Conversations lie one behind the other, each by turn with NULL first; ties
    are in the order of role and text, so only equal rows have no order. A
    segment is what one range holds of a conversation, named by its first
    slot. Ranges are cut between equal rows too.
    """
    blank = F.lit(" ")
    rows = df.select(
        F.col(f"`{conv}`").alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), blank).alias("role"),
        F.coalesce(F.col(f"`{text}`"), blank).alias("text"),
        # What cuts between equal rows; their order does not change any result.
        F.monotonically_increasing_id().alias("slot"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    ranged = rows.repartitionByRange(*order, "slot").sortWithinPartitions(*order, "slot")
    ranged = ranged.withColumn("slot", F.monotonically_increasing_id())

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, segment = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            convs, slots = batch.column(0).to_pylist(), batch.column(4).to_pylist()
            found = []
            for name, slot in zip(convs, slots, strict=True):
                if before != [name]:
                    before, segment = [name], slot
                found.append(segment)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names)

    names = [*rows.columns, "segment"]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranged.schema)
    return written(ranged.mapInArrow(segments, f"{kinds}, segment long"), "turns")


def faults(ordered: DataFrame) -> DataFrame:
    """`slot`, `segment` and `row`, the number that stands for it, of the rows of `in_order`; written.

    What was said before is found by the least slot per conversation and
    digest, so a turn repeated in all rows is one row per task in the shuffle.
    """
    shown = F.btrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    narrow = ordered.select(
        "slot",
        "segment",
        "conv",
        F.when(initial == "", 0).otherwise(F.instr(F.lit(INITIALS), initial)).alias("known"),
        (shown == "").alias("blank"),
        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.sha2(F.concat(F.sha2("role", 256), F.lit(":"), F.col("text")), 256).alias("said"),
    )
    first = (
        narrow.filter("NOT blank")
        .groupBy("conv", "said")
        .agg(F.min("slot").alias("slot"))
        .select("slot", F.lit(True).alias("first"))
    )
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("first").isNull(), DUPLICATE)
        .when(F.col("cut"), CUT_OFF)
        .otherwise(SOUND)
    )
    judged = narrow.join(first, "slot", "left")
    row = (F.col("known") * FAULTS + fault).cast("long")
    return written(judged.select("slot", "segment", row.alias("row")), "faults")


def conversation_ends(ordered: DataFrame, judged: DataFrame) -> DataFrame:
    """`segment`, `key` of its conversation, the states `start` and `stop` at its ends; written.

    `stop` is -1 for the last segment of a conversation, which may end in any
    sound state. A conversation has at most one segment per range.
    """
    convs = ordered.groupBy("segment").agg(F.first("conv").alias("conv"))
    same = Window.partitionBy("conv")
    keyed = written(
        convs.select(
            "segment", F.min("segment").over(same).alias("key"), F.count("segment").over(same).alias("parts")
        ),
        "segments",
    )
    whole = keyed.filter("parts = 1").select(
        "segment", "key", F.lit(NOTHING).cast("long").alias("start"), F.lit(-1).cast("long").alias("stop")
    )
    # Only the first and the last conversation of a range go on in another: two rows a range.
    parts = keyed.filter("parts > 1").select("segment", "key")
    rows = judged.join(F.broadcast(parts), "segment")
    tables = _sorted(rows, "segment", "slot").mapInArrow(_composed, "segment long, key long, costs array<long>")
    states = _sorted(tables, "key", "segment").mapInArrow(_states, "segment long, key long, start long, stop long")
    return written(whole.unionByName(states), "states")


def _sorted(rows: DataFrame, group: str, order: str) -> DataFrame:
    return rows.repartition(group).sortWithinPartitions(group, order)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    for table, starts in whole_groups(batches, [key]):
        for a, b in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
            yield table.slice(a, b - a)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _groups(batches, "segment"):
        table = composed([step(r) for r in part.column("row").to_pylist()])
        flat = [number for row in table for entry in row for number in entry]
        names = {name: part.column(name).combine_chunks().slice(0, 1) for name in ("segment", "key")}
        yield pa.RecordBatch.from_pydict({**names, "costs": pa.array([flat], pa.list_(pa.int64()))})


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _groups(batches, "key"):
        tables: list[Table] = []
        for flat in part.column("costs").to_pylist():
            entries = list(zip(flat[::2], flat[1::2], strict=True))
            tables.append(tuple(tuple(entries[4 * a : 4 * a + 4]) for a in STATES))
        states = crossings([*tables, step(None)], NOTHING, ENDS)[:-1]
        named = {"segment": part.column("segment"), "key": part.column("key")}
        named["start"] = pa.array([NOTHING, *states[:-1]], pa.int64())
        named["stop"] = pa.array([*states[:-1], -1], pa.int64())
        yield from pa.table(named).to_batches()


def edited(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Every row with its edits: conv, turn, role, text, `slot`, `key`, `row`, `audit` and `roles`.

    `audit` has the initials of Insert, Keep, Rerole and Delete in order, those
    inserts that follow a conversation with its last row; `roles` has a role
    for each of them but Delete, NULL where the row keeps its own. `key` is a
    number per conversation (NULL is one) and `slot` the order of its rows.
    Faults are, by FAULTS, in `row`. Rows with equal turn, and with equal
    everything, are rows of their own; an empty table gives no rows.
    """
    ordered = in_order(df, conv, turn, role, text)
    judged = faults(ordered)
    rows = judged.join(conversation_ends(ordered, judged), "segment")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, ["segment"]):
            numbers = table.column("row").to_pylist()
            begins, stops = table.column("start").to_pylist(), table.column("stop").to_pylist()
            audits, roles = [], []
            for a, b in zip(starts, np.append(starts[1:], table.num_rows), strict=True):
                ends = ENDS if stops[a] < 0 else (stops[a],)
                found = audits_of(numbers[a:b], begins[a], ends, stops[a] < 0)
                audits += found
                roles += roles_after(found, numbers[a:b], begins[a])
            named = {name: table.column(name) for name in ("slot", "key", "row")}
            named["audit"] = pa.array(audits, pa.string())
            named["roles"] = pa.array(roles, pa.list_(pa.string()))
            yield from pa.table(named).to_batches()

    edits = _sorted(rows, "segment", "slot").mapInArrow(
        solve, "slot long, key long, row long, audit string, roles array<string>"
    )
    return ordered.drop("segment").join(edits, "slot")


def repaired(edits: DataFrame) -> DataFrame:
    """The repaired turns of `edited`: conv, `slot` and `part`, their order, role and text.

    Inserted turns have an empty text. A conversation left with nothing has no rows.
    """
    left = F.transform(F.split(F.translate("audit", "D", ""), ""), lambda edit: edit == "I")
    turns = F.arrays_zip(left.alias("inserted"), F.col("roles").alias("as"))
    each = edits.filter("size(roles) > 0").select("conv", "slot", "role", "text", F.posexplode(turns))
    return each.select(
        "conv",
        "slot",
        F.col("pos").alias("part"),
        F.coalesce("col.as", "role").alias("role"),
        F.when(F.col("col.inserted"), "").otherwise(F.col("text")).alias("text"),
    )


LEGAL = ("su", "ua", "au")


class _Report:
    """What is counted and digested of one conversation while its rows pass."""

    def __init__(self, conv: object):
        self.conv = conv
        self.faults = [0] * FAULTS
        self.turns = self.illegal = self.cost = 0
        self.least = self.most = self.initial = None
        self.audit: list[str] = []
        self.digest, self.any = hashlib.sha256(), False

    def add(self, turn: int | None, role: str, text: str, row: int, audit: str, roles: list) -> None:
        fault = row % FAULTS
        self.faults[fault] += 1
        if turn is not None and turn != self.most:
            self.least = turn if self.least is None else self.least
            self.most = turn
            self.turns += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        self.audit.append(audit)
        named = iter(roles)
        for edit in audit:
            self.cost += COSTS[edit]
            if edit == "D":
                continue
            if edit != "I" and fault == CUT_OFF:
                self.cost += TRUNCATED
            said = f"{next(named) or role}:{'' if edit == 'I' else text}"
            self.digest.update(("\n" * self.any + said).encode("utf-8", "surrogatepass"))
            self.any = True

    def values(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        return (
            self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[CUT_OFF],
            self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest(),
        )


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def reports(edits: DataFrame) -> DataFrame:
    """One row per conversation of `edited`: its faults, the cost and audit of the repair, its digest.

    Columns conv, gaps (turn numbers missing between the first and the last),
    blank, duplicate, truncated, illegal (neighbours in no order), cost, audit
    and repaired_sha256 (of role:text lines). A digest is made of one byte
    after the other, so the rows of a conversation pass through one task; it
    holds the audit, which is the result, and nothing else of them.
    """
    kind = edits.schema["conv"].dataType.simpleString()
    rows = edits.select("key", "slot", "conv", F.col("turn").cast("long"), "role", "text", "row", "audit", "roles")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None

        def handed(done: list[_Report]) -> pa.RecordBatch:
            columns = zip(*(r.values() for r in done), strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        now, open_report = None, None
        for batch in batches:
            if schema is None:
                numbers = [pa.field(name, pa.int64()) for name in COUNTS]
                texts = [pa.field(name, pa.string()) for name in ("audit", "repaired_sha256")]
                schema = pa.schema([pa.field("conv", batch.schema.field("conv").type), *numbers, *texts])
            done = []
            for key, _, conv, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now:
                    if open_report is not None:
                        done.append(open_report)
                    now, open_report = key, _Report(conv)
                open_report.add(*row)
            if done:
                yield handed(done)
        if open_report is not None:
            yield handed([open_report])

    fields = ", ".join(f"{name} long" for name in COUNTS)
    return _sorted(rows, "key", "slot").mapInArrow(
        report, f"conv {kind}, {fields}, audit string, repaired_sha256 string"
    )
