import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery import scale
from gleanery.llm import mixture

PATH = public_tokenizers.path("byte_bpe_50k.json")
SLOW = Tokenizer.from_file(PATH)


def whole(text):
    return [*SLOW.encode(text or "", add_special_tokens=False).ids, 0]


def check(pieces, rows, window=1024):
    """Every id of every row in one piece, sequences gapless and full or powers of two."""
    pieces = pieces.collect()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for members in sequences.values():
        members.sort(key=lambda p: p.offset)
        assert [p.offset for p in members] == np.cumsum([0, *(p.length for p in members[:-1])]).tolist()
        size = sum(p.length for p in members)
        assert size <= window and (size == window or size & (size - 1) == 0)
        assert all(len(p.ids) == 4 * p.length and p.length > 0 for p in members)
    by_key = {}
    for p in pieces:
        by_key.setdefault(repr(p.doc_id), []).append(p)
    expected = {}
    for key, text in rows:
        expected.setdefault(repr(key), []).append(whole(text))
    assert set(by_key) == set(expected)
    for key, texts in expected.items():
        if len(texts) == 1:
            parts = sorted(by_key[key], key=lambda p: p.start)
            assert [p.start for p in parts] == np.cumsum([0, *(p.length for p in parts[:-1])]).tolist()
            ids = [i for p in parts for i in np.frombuffer(p.ids, "<u4").tolist()]
            assert ids == texts[0] and {p.doc_tokens for p in parts} == {len(ids)}
        else:
            assert sum(p.length for p in by_key[key]) == sum(map(len, texts))
    return pieces


@pytest.mark.parametrize("block_ids", [1 << 20, 3000])
def test_round_trip(spark, block_ids):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(mixture.pack(docs.repartition(3), "doc_id", "text", "source", PATH, block_ids=block_ids), rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a word"), (3, "a word"), (None, "no key"), (4, "long " * 5000)]
    df = spark.createDataFrame(
        [(k, t, "s" if n % 2 else None, n) for n, (k, t) in enumerate(rows)],
        "doc_id long, text string, source string, block int",
    )
    pieces = check(mixture.pack(df, "doc_id", "text", "source", PATH, window=256), rows, 256)
    assert {p.source for p in pieces} == {"s", None}


def test_blocks_are_stored_in_small_row_groups(spark, monkeypatch):
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz "
    rows = [(n, "".join(rng.choices(letters, k=500_000)), "s") for n in range(24)]
    tables = {}

    def kept(df, label, *rest):
        tables[label] = scale.written(df, label, *rest)
        return tables[label]

    monkeypatch.setattr(mixture, "written", kept)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    pieces = mixture.pack(df, "doc_id", "text", "source", PATH)
    lengths = {r.doc_id: (r.n, r.all) for r in pieces.groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("all")
    ).collect()}
    assert set(lengths) == set(range(24)) and all(n == every for n, every in lengths.values())
    (file,) = [f.removeprefix("file://") for f in tables["blocks"].inputFiles()]
    stored = pq.ParquetFile(file).metadata
    sizes = [stored.row_group(n).total_byte_size for n in range(stored.num_row_groups)]
    # A page is no larger than its row group, and that one block at most over its limit.
    assert sum(sizes) > 12 << 20 and max(sizes) < 11 << 20


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixture.pack(df, "doc_id", "text", "source", PATH).count() == 0


def test_sequences_keep_to_the_shares():
    rng = random.Random(1)
    queues, lengths = [], []
    for _ in range(3000):
        name = rng.choices(["a", "b", "c"], [6, 3, 1])[0]
        queues.append(name)
        lengths.append(rng.randrange(1, 900))
    total = {n: sum(s for q, s in zip(queues, lengths, strict=True) if q == n) for n in "abc"}
    all_ids = sum(total.values())
    credit = {n: (total[n] / all_ids, 0.0) for n in total}
    pieces = mixture.fill(queues, lengths, credit)
    served = {n: 0 for n in total}
    last = len(mixture.lengths_of(all_ids)) - 1
    ends = {}
    for doc, _, n, sequence, _ in pieces:
        served[queues[doc]] += n
        ends[sequence] = dict(served)
    for sequence, counts in ends.items():
        if sequence < last - 12:
            done = sum(counts.values())
            assert all(abs(counts[n] - done * credit[n][0]) <= 2 * mixture.PACKET for n in counts)
    assert served == total


def test_what_is_owed_is_carried_over_sequences():
    names = [f"s{n}" for n in range(20)]
    queues = names * 40
    lengths = [700] * len(queues)
    owed = {name: n * 6.0 - 57 for n, name in enumerate(names)}
    credit = {name: (1 / 20, owed[name]) for name in names}
    pieces = mixture.fill(queues, lengths, credit, least=128)
    assert sum(n for _, _, n, _, _ in pieces) == sum(lengths)
    assert np.median([n for _, _, n, _, _ in pieces]) >= 128
    served = dict.fromkeys(names, 0)
    sequences = len(mixture.lengths_of(sum(lengths)))
    for at in range(sequences - 20):
        for doc, _, n, sequence, _ in pieces:
            if sequence == at:
                served[queues[doc]] += n
        # Whatever was served, what is owed by now stays within two packets of what was at first.
        done = sum(served.values())
        assert all(abs(done / 20 + owed[n] - served[n]) <= 2 * mixture.PACKET for n in names)
    # A source that began with more owed has had more by the middle.
    first = dict.fromkeys(names, 0)
    for doc, _, n, sequence, _ in pieces:
        first[queues[doc]] += n if sequence < 8 else 0
    assert sum(first[n] for n in names[10:]) > sum(first[n] for n in names[:10])


def test_what_is_owed_is_carried_over_blocks():
    totals = {f"s{n}": 10_007 * (n + 1) for n in range(7)}
    schedule = mixture.Schedule(totals, None, 8 * 1024, 32)
    borders = {name: schedule.borders(name) for name in totals}
    every = sum(totals.values())
    assert all(b[0] == 0 and b[-1] == totals[n] and (np.diff(b) >= 0).all() for n, b in borders.items())
    filler = schedule.names[schedule.filler]
    largest = 0
    for block in range(len(borders["s0"]) - 1):
        cut = block * 8 * 1024
        assert sum(b[block] for b in borders.values()) == cut
        owed = {n: schedule.due(n, block) - b[block] for n, b in borders.items()}
        assert all(abs(schedule.due(n, block) - totals[n] * cut / every) < 1e-3 for n in totals)
        assert all(-1e-6 <= v < 32 for n, v in owed.items() if n != filler)
        largest = max(largest, *owed.values())
    assert largest > 16


@pytest.mark.parametrize("sources", [20, 200])
def test_pieces_are_not_scraps(spark, sources):
    rows = [(n, "some words of text here " * 300, f"s{n % sources}") for n in range(2 * sources)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    pieces = mixture.pack(df, "doc_id", "text", "source", PATH, block_ids=1 << 16, least=128)
    pieces = check(pieces, [r[:2] for r in rows])
    sizes = [p.length for p in pieces]
    assert np.median(sizes) >= 128
    plain = mixture.pack(df, "doc_id", "text", "source", PATH, block_ids=1 << 16)
    assert len(sizes) < plain.count() / 2


@pytest.mark.parametrize("kind", ["smallint", "decimal(12,2)", "string", "int", "date"])
def test_keys_of_other_types(spark, kind):
    value = "date_add(date'2020-01-01', cast(id as int))" if kind == "date" else "id"
    df = spark.range(30).selectExpr(f"cast({value} as {kind}) as doc_id", "'some words' as text", "'s' as source")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    check(mixture.pack(df, "doc_id", "text", "source", PATH, window=64), rows, 64)


@pytest.mark.parametrize(
    "name", ["source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "block", "text"]
)
def test_keys_named_like_other_columns(spark, name):
    rows = [(n, "some words of text", "s", 5, "x") for n in range(9)]
    others = [c for c in ("start", "block", "ids", "piece_start") if c != name][:2]
    df = spark.createDataFrame(rows, ["k", "said", "origin", *others]).withColumnRenamed("k", name)
    found = mixture.pack(df, name, "said", "origin", PATH)
    added = ["source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert found.columns == [name, *(f"piece_{c}" if c == name else c for c in added)]
    assert {r[0] for r in found.collect()} == set(range(9))


def test_named_targets(spark):
    df = spark.range(400).select(
        F.col("id").alias("doc_id"), F.lit("some words of text here").alias("text"),
        F.when(F.col("id") % 4 == 0, "rare").otherwise("common").alias("source"),
    )
    pieces = mixture.pack(df.coalesce(1), "doc_id", "text", "source", PATH, {"rare": 1, "common": 1}, 64, 16).collect()
    first = [p for p in pieces if p.sequence_id < 8]
    rare = sum(p.length for p in first if p.source == "rare")
    assert 0.4 < rare / sum(p.length for p in first) < 0.6


def test_windows_keep_to_the_shares_where_sources_lie_apart(spark):
    sizes = {"a": 600, "b": 300, "c": 100}
    rows = [(f"{name}{n}", "some words of text here " * 20, name) for name in sizes for n in range(sizes[name])]
    rows.append(("long", "words of text here some " * 4000, "d"))
    df = spark.createDataFrame(rows, "doc_id string, text string, source string").coalesce(1)
    pieces = mixture.pack(df, "doc_id", "text", "source", PATH, window=512, block_ids=8192)
    pieces = check(pieces, [r[:2] for r in rows], 512)
    total, held = {}, {}
    for p in pieces:
        total[p.source] = total.get(p.source, 0) + p.length
        of = held.setdefault(p.sequence_id, {})
        of[p.source] = of.get(p.source, 0) + p.length
    whole = [of for of in held.values() if sum(of.values()) == 512]
    assert len(held) <= len(whole) + 9
    every = sum(total.values())
    for of in whole:
        assert all(abs(of.get(n, 0) - 512 * total[n] / every) <= 8 for n in total)


def test_the_others_share_what_a_source_that_ran_out_leaves(spark):
    rows = [(n, "some words of text here " * 20, "abbbccccc"[n % 9]) for n in range(450)]
    df = spark.createDataFrame(sorted(rows, key=lambda r: r[2]), "doc_id long, text string, source string")
    targets = {"a": 5, "b": 3, "c": 2}
    pieces = mixture.pack(df.coalesce(1), "doc_id", "text", "source", PATH, targets, 512, block_ids=4096)
    pieces = check(pieces, [r[:2] for r in rows], 512)
    held = {}
    for p in pieces:
        of = held.setdefault(p.sequence_id, dict.fromkeys("abc", 0))
        of[p.source] += p.length
    both = [of for _, of in sorted(held.items()) if of["a"] == 0 and of["b"] and sum(of.values()) == 512]
    assert len(both) > 10
    assert all(abs(of["b"] - 512 * 0.6) <= 8 for of in both[1:-1])
