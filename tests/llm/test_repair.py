import hashlib
import heapq
import random
import re
import zlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gleanery.llm import repair
from gleanery.llm.queries import op12_repair

WHITE = " \t\n\x0b\x0c\r"


def faults(turns):
    """(role, text, fault) of every row, from the rules."""
    seen, found = set(), []
    for role, text in turns:
        shown = text.strip(WHITE)
        fault = None
        if not shown:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif shown[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        found.append((role, text, fault))
    return found


def cheapest(turns):
    """Cost, audit and repaired rows, by search over all edits in the order of cost and audit."""
    turns = faults(turns)
    waiting = [(0, "", 0, "", ())]
    settled = {}
    while waiting:
        cost, audit, at, roles, left = heapq.heappop(waiting)
        # Of initials all that matters is whether they are allowed to go on.
        if not re.fullmatch("(s?(ua)*u?)?", roles):
            continue
        if settled.setdefault((at, roles[-1:]), (cost, audit)) < (cost, audit):
            continue
        if at == len(turns) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, [f"{r}:{t}" for r, t in left]
        for role in ("user", "assistant"):
            heapq.heappush(waiting, (cost + 3, audit + "I", at, roles + role[0], (*left, (role, ""))))
        if at == len(turns):
            continue
        role, text, fault = turns[at]
        heapq.heappush(waiting, (cost + 4, audit + "D", at + 1, roles, left))
        if fault in ("blank", "duplicate"):
            continue
        more = 3 if fault == "truncated" else 0
        heapq.heappush(waiting, (cost + more, audit + "K", at + 1, roles + (role[:1] or "?"), (*left, (role, text))))
        for new in ("user", "assistant"):
            heapq.heappush(waiting, (cost + 3 + more, audit + "R", at + 1, roles + new[0], (*left, (new, text))))


def expected(turns):
    """A row of the report of (turn, role, text) rows."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
    judged = [f for _, _, f in faults([t[1:] for t in turns])]
    initials = [role[:1] for _, role, _ in turns]
    numbers = [t for t, _, _ in turns if t is not None]
    cost, audit, left = cheapest([t[1:] for t in turns])
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        judged.count("blank"), judged.count("duplicate"), judged.count("truncated"),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest(),
    )


def by_brute_force(turns):
    groups = {}
    for conv, turn, role, text in turns:
        groups.setdefault(conv, []).append((turn, role or " " if role != "" else "", " " if text is None else text))
    return sorted(((conv, *expected(group)) for conv, group in groups.items()), key=repr)


def conversation(rng, length):
    roles = ["system", "user", "assistant", "tool", ""]
    texts = ["Yes.", "No!", "well", " ", "", "Why?\n", "and so", "x."]
    return [
        (rng.choice([None, n, n, n, n + 3]), rng.choices(roles, [1, 4, 4, 1, 0.3])[0], rng.choice(texts))
        for n in range(length)
    ]


def found(spark, turns):
    df = spark.createDataFrame(turns, "conv int, turn int, role string, text string")
    return rows(repair.reports(repair.edited(df, "conv", "turn", "role", "text")))


@pytest.mark.parametrize("seed", range(2))
def test_random_conversations(spark, seed):
    rng = random.Random(seed)
    turns = [(c, *t) for c in range(120) for t in conversation(rng, rng.randrange(1, 14))]
    rng.shuffle(turns)
    assert found(spark, turns) == by_brute_force(turns)


@pytest.fixture
def many_ranges(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_a_conversation_over_many_ranges(spark, many_ranges):
    # Far more rows of one conversation than of all others: it goes through every range.
    rng = random.Random(5)
    turns = [(7, *t) for t in conversation(rng, 500)] + [(c, *t) for c in range(15) for t in conversation(rng, 6)]
    rng.shuffle(turns)
    df = spark.createDataFrame(turns, "conv int, turn int, role string, text string")
    ordered = repair.in_order(df, "conv", "turn", "role", "text")
    assert ordered.filter("conv = 7").select("segment").distinct().count() > 3
    assert found(spark, turns) == by_brute_force(turns)


def test_equal_rows_only(spark, many_ranges):
    turns = [(1, None, "user", "Same.")] * 300
    assert found(spark, turns) == by_brute_force(turns)


def test_halves_agree_with_one_pass():
    rng = random.Random(2)
    for _ in range(200):
        numbers = [rng.randrange(16) for _ in range(rng.randrange(1, 40))]
        whole = list(repair.audits_of(numbers, repair.NOTHING, repair.ENDS, True))
        cut = rng.randrange(1, len(numbers)) if len(numbers) > 1 else None
        if cut is None:
            continue
        parts = [repair.composed([repair.step(r) for r in part]) for part in (numbers[:cut], numbers[cut:])]
        middle, end, _ = repair.crossings([*parts, repair.step(None)], repair.NOTHING, repair.ENDS)
        first = repair.audits_of(numbers[:cut], repair.NOTHING, (middle,), False)
        second = repair.audits_of(numbers[cut:], middle, repair.ENDS, True)
        assert [*first, *second] == whole


def test_odd_rows(spark):
    long = "word " * 20_000
    turns = [
        (None, None, None, None), (None, 2, "user", "Hi."), (1, 1, "user", long), (1, 1, "user", long),
        (1, 2, "assistant", "a ."), (2, 1, "system", "Only."), (3, 1, "User", "Big?"), (3, 9, "ua", "b\x0b"),
    ]
    df = spark.createDataFrame(turns, "slot int, audit int, conv string, key string").withColumn("text", F.lit(1))
    edits = repair.edited(df, "slot", "audit", "conv", "key")
    assert rows(repair.reports(edits)) == by_brute_force(turns)
    empty = repair.edited(df.limit(0), "slot", "audit", "conv", "key")
    assert repair.reports(empty).collect() == [] and repair.repaired(empty).collect() == []


def test_repaired_turns(spark):
    turns = [(1, 1, "assistant", "So."), (1, 2, "user", ""), (2, 1, "user", "A?"), (2, 2, "user", "B?"), (3, 1, "user", " ")]
    df = spark.createDataFrame(turns, "conv int, turn int, role string, text string")
    left = repair.repaired(repair.edited(df, "conv", "turn", "role", "text"))
    told = {}
    for row in left.orderBy("slot", "part").collect():
        told.setdefault(row.conv, []).append(f"{row.role}:{row.text}")
    assert told == {1: ["user:", "assistant:So."], 2: ["user:A?", "assistant:B?"]}


def damaged_by_hand(turns):
    left = []
    for conv, turn, role, text in turns:
        names = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(names).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        left += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return left


def test_damage(spark):
    rng = random.Random(4)
    turns = [(rng.choice([None, c]), *t) for c in range(60) for t in conversation(rng, 6)] + [(5, 1, None, None)]
    df = spark.createDataFrame(turns, "text int, role int, turn string, conv string")
    done = repair.damaged(df, "text", "role", "turn", "conv")
    assert rows(done) == sorted(damaged_by_hand(turns), key=repr)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    whole = dict.fromkeys((t[0] for t in turns), nothing)
    whole.update({r[0]: r[1:] for r in by_brute_force(damaged_by_hand(turns))})
    assert rows(op12_repair(spark, folder)) == sorted(((c, *r) for c, r in whole.items()), key=repr)
