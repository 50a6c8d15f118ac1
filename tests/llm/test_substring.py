import random

import numpy as np
import pytest

from gleanery.llm import substring


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_chunks_follow_the_content():
    gears = substring._gears()
    passage = prose(1, 200)
    def cut(text):
        octets, ends = substring.chunks(text, 4, gears)
        begins = [0, *ends[:-1]]
        return [octets[a:b] for a, b in zip(begins, ends, strict=True)]
    plain, shifted = cut(passage), cut("Something before: " + passage + " and after")
    assert b"".join(plain) == passage.encode()
    assert len(set(plain) - set(shifted)) <= 3
    assert 2 < 200 / len(plain) < 8


@pytest.mark.parametrize("text", ["", "é" * 9000, "x" * 20_000, " " * 9000, "日本" * 5000])
def test_chunks_of_odd_texts_cover_them(text):
    octets, ends = substring.chunks(text, 4, substring._gears())
    assert list(ends) == sorted(set(ends)) and (not text or ends[-1] == len(octets))
    begins = [0, *ends[:-1]]
    parts = [octets[a:b].decode() for a, b in zip(begins, ends, strict=False)]
    assert "".join(parts) == text
    assert all(len(p.encode()) <= substring.LONGEST + 3 for p in parts)


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, owners string, row int")
    found = substring.without_copies(df, "doc_id", "text", **options)
    assert found.columns == ["doc_id", "text", "owners", "row", "removed"]
    return {r.row: r for r in found.collect()}


def test_passages_go_from_all_but_the_first(spark):
    passage = prose(50, 80)
    rows = [(n, f"{prose(100 + n, 60)} {passage} {prose(200 + n, 60)}", "-", n) for n in range(5)]
    rows += [(10 + n, prose(300 + n, 150), "-", 10 + n) for n in range(5)]
    found = run(spark, rows)
    original = {r[3]: r[1] for r in rows}
    for n in [0, 10, 11, 12, 13, 14]:
        assert found[n].text == original[n] and found[n].removed == [] and found[n].owners == []
    for n in range(1, 5):
        octets = original[n].encode()
        gone = b"".join(octets[s.start : s.stop] for s in found[n].removed).decode()
        assert gone.strip() == passage
        assert found[n].owners == [0]
        kept, at = b"", 0
        for s in found[n].removed:
            kept, at = kept + octets[at : s.start], s.stop
        assert found[n].text.encode() == kept + octets[at:]


def test_short_repeats_stay(spark):
    line = prose(60, 24)
    rows = [(n, f"{prose(400 + n, 50)} {line} {prose(450 + n, 50)}", "-", n) for n in range(4)]
    assert all(r.removed == [] for r in run(spark, rows).values())


def test_every_passage_of_enough_words_goes_as_a_whole(spark):
    rows = []
    for n in range(300):
        passage = prose(10_000 + n, (25, 26, 30, 40, 60)[n % 5])
        for doc in (2 * n, 2 * n + 1):
            rows.append((doc, f"{prose(77_000 + doc, 40)} {passage}\t{prose(88_000 + doc, 40)}", "-", doc))
    found, texts = run(spark, rows), {r[0]: r[1] for r in rows}
    expected = word_runs(texts, 25)
    assert all(len(expected[2 * n + 1]) >= 25 for n in range(300))
    assert {doc: removed_words(text, found[doc].removed) for doc, text in texts.items()} == expected
    assert all(found[2 * n + 1].owners == [2 * n] for n in range(300))


def test_passages_of_few_different_words_go(spark):
    rng = random.Random(5)
    few = prose(61, 14).split()
    passages = [" ".join(rng.choice(few) for _ in range(400)), " ".join(["the"] * 80)]
    texts = {
        100 * k + n: f"{prose(500 + 10 * k + n, 50)} {passage} {prose(600 + 10 * k + n, 50)}"
        for k, passage in enumerate(passages)
        for n in range(3)
    }
    found = run(spark, [(doc, text, "-", doc) for doc, text in texts.items()])
    expected = word_runs(texts, 25)
    for doc, text in texts.items():
        got = removed_words(text, found[doc].removed)
        assert got <= expected[doc]
        # One word said over and over may keep its ends: it has no places of its own.
        assert len(got) >= len(expected[doc]) - (2 * substring.WINDOW if doc > 99 else 0)


def test_a_passage_whose_middle_is_older_goes_as_a_whole(spark):
    head, middle, tail = prose(62, 16), prose(63, 14), prose(64, 16)
    rows = [(1, f"{prose(700, 40)} {middle} {prose(701, 40)}", "-", 1)]
    rows += [(n, f"{prose(702 + n, 40)} {head} {middle} {tail} {prose(802 + n, 40)}", "-", n) for n in (2, 3)]
    found = run(spark, rows)
    assert found[1].removed == [] and found[2].removed == []
    assert found[3].text == f"{prose(705, 40)} {prose(805, 40)}" and found[3].owners == [2]


def test_repeats_within_a_document_stay(spark):
    passage = prose(70, 60)
    assert run(spark, [(1, f"{passage} {passage}", "-", 1)])[1].removed == []


def test_odd_rows(spark):
    whole = prose(80, 90)
    rows = [
        (1, whole, "-", 0), (2, whole, "-", 1), (2, whole, "-", 2), (2, prose(81, 40), "-", 3),
        (None, whole, "-", 4), (5, None, "-", 5), (6, "", "-", 6), (1, whole, "-", 7),
    ]
    found = run(spark, rows)
    assert [found[n].text for n in range(8)] == [whole, "", "", rows[3][1], whole, None, "", whole]
    assert found[1].owners == [1] and len(found[1].removed) == 1


def test_empty_table(spark):
    assert run(spark, []) == {}


def word_runs(texts, least):
    """Places of the words that stand in runs of `least` words of an earlier document."""
    first = {}
    for doc in sorted(texts):
        words = texts[doc].split()
        for n in range(len(words) - least + 1):
            first.setdefault(tuple(words[n : n + least]), doc)
    found = {}
    for doc, text in texts.items():
        words = text.split()
        runs = [n for n in range(len(words) - least + 1) if first[tuple(words[n : n + least])] < doc]
        found[doc] = {n + k for n in runs for k in range(least)}
    return found


def removed_words(text, spans):
    octets = text.encode()
    found = set()
    for s in spans:
        begin = len(octets[: s.start].split())
        found |= set(range(begin, begin + len(octets[s.start : s.stop].split())))
    return found


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_against_all_runs_of_words(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = word_runs(texts, substring.MIN_WORDS)
    found = substring.without_copies(docs, "doc_id", "text").collect()
    got = {r.doc_id: removed_words(texts[r.doc_id], r.removed) for r in found}
    total = sum(map(len, expected.values()))
    assert total > 1000
    assert all(got[doc] <= expected[doc] for doc in texts)
    # Where a passage of one owner goes over into one of another a few words may stay.
    assert sum(map(len, got.values())) >= 0.999 * total


@pytest.mark.parametrize("blank", ["", "\u3000", "\u00a0"])
def test_passages_without_blanks_go(spark, blank):
    def signs(seed, n):
        rng = random.Random(seed)
        return blank.join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))

    passage = signs(90, 600)
    rows = [(n, f"{signs(500 + n, 300 + 7 * n)}{blank}{passage}{blank}{signs(600 + n, 300)}", "-", n) for n in range(3)]
    found = run(spark, rows)
    assert found[0].removed == [] and found[0].text == rows[0][1]
    for n in (1, 2):
        octets = rows[n][1].encode()
        gone = [octets[s.start : s.stop].decode() for s in found[n].removed]
        assert len(gone) == 1 and gone[0] in passage and len(gone[0]) > 0.8 * len(passage)
