import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import rows

from gleanery.llm import replay
from gleanery.llm.queries import op11_byte_bpe

PATTERN = public_tokenizers.PATTERN
RANKS = replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def merges():
    return replay.Merges(RANKS)


@pytest.fixture(scope="module")
def library(merges):
    return tiktoken.Encoding("r", pat_str=PATTERN, mergeable_ranks=merges.ids, special_tokens={})


def ids(stored):
    return np.frombuffer(stored, replay.ID).tolist()


def test_every_code_point(merges, library):
    encoder = replay.Encoder(merges, PATTERN)
    for base in range(0, 0x110000, 0x400):
        points = [chr(x) for x in range(base, base + 0x400) if not 0xD800 <= x <= 0xDFFF]
        text = " ".join(f"a{c}{c}1 {c}b" for c in points) + "".join(points)
        assert ids(encoder.encode([text])[0]) == library.encode_ordinary(text)


def test_random_texts(merges, library):
    rng = random.Random(3)
    alphabet = "ab cdeéßñ日本'st09.,-\n\t\U0001f600"
    encoder = replay.Encoder(merges, PATTERN, kept_words=50)
    for _ in range(300):
        texts = ["".join(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(9)]
        found = [ids(stored) for stored in encoder.encode(texts)]
        assert found == [library.encode_ordinary(t) for t in texts]


@pytest.mark.parametrize(
    "word", ["a" * 2000, "ab" * 700, "aab" * 500, "\n" * 3000, "=-" * 900, "é" * 999, "0" * 1234]
)
def test_words_of_repeats(merges, library, word):
    assert ids(replay.replayed([word.encode()], merges)[0]) == library.encode_ordinary(word)


def toy(*tokens):
    """Merges over single bytes, in their order, and further tokens in the order given."""
    import base64

    every = [bytes([b]) for b in range(256)] + list(tokens)
    lines = [base64.b64encode(t) + b" " + str(n).encode() for n, t in enumerate(every)]
    return replay.Merges(b"\n".join(lines))


def one_at_a_time(word, merges):
    """The merge of least rank, the leftmost of equals, until none is left."""
    if word in merges.ids:
        return [merges.ids[word]]
    parts = [bytes([b]) for b in word]
    while True:
        able = [
            (merges.ids[a + b], n)
            for n, (a, b) in enumerate(zip(parts, parts[1:]))
            if a + b in merges.ids
        ]
        if not able:
            return [merges.ids[p] for p in parts]
        _, n = min(able)
        parts[n : n + 2] = [parts[n] + parts[n + 1]]


def test_merges_that_allow_earlier_ones():
    # Tokens out of the order in which they could be built: a merge may allow one of lower rank.
    rng = random.Random(8)
    for _ in range(60):
        tokens = {bytes(rng.choices(b"abc", k=rng.randrange(2, 6))) for _ in range(12)}
        tokens = sorted(tokens, key=lambda t: rng.random())
        merges = toy(*tokens)
        words = [bytes(rng.choices(b"abc", k=rng.randrange(1, 25))) for _ in range(40)]
        expected = [one_at_a_time(w, merges) for w in words]
        assert [ids(stored) for stored in replay.replayed(words, merges)] == expected


def test_short_words_need_no_index(merges, library, monkeypatch):
    def fail(waiting):
        raise AssertionError("a merge was taken by itself")

    monkeypatch.setattr(replay, "heappop", fail)
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeinorstéü1-", k=rng.randrange(1, 17))) for _ in range(3000)]
    text = " ".join(words)
    assert ids(replay.Encoder(merges, PATTERN).encode([text])[0]) == library.encode_ordinary(text)


def test_words_around_the_longest_short_one(merges, library):
    rng = random.Random(5)
    words = ["".join(rng.choices("abnt", k=n)) for n in range(1, 70) for _ in range(5)]
    words += ["a" * n for n in range(1, 70)]
    found = replay.replayed([w.encode() for w in words], merges)
    assert [ids(stored) for stored in found] == [library.encode_ordinary(w) for w in words]


def test_texts_beyond_a_slice(spark, library):
    text = "Some words, 12 of them. " * 400
    df = spark.createDataFrame([(1, text), (2, "a"), (3, text[:50])], "k int, t string")
    done = replay.encoded(df, "k", "t", RANKS, PATTERN, slice_chars=64)
    assert {r.k: ids(r.ids) for r in done.collect()} == {
        k: library.encode_ordinary(t) for k, t in [(1, text), (2, "a"), (3, text[:50])]
    }


def test_odd_rows(spark, library):
    given = [(1, None), (1, ""), (1, "x y"), (1, "x y"), (None, "z"), (2, "   \n\n "), (3, "<|endoftext|>")]
    # Columns with the names the operator uses itself.
    df = spark.createDataFrame(given, "key int, text string").selectExpr(
        "key as doc", "text as key", "1 as ids", "2 as octets", "3 as text"
    )
    done = replay.decoded(replay.encoded(df, "doc", "key", RANKS, PATTERN), "doc", "ids", RANKS)
    assert done.columns == ["doc", "ids", "octets"]
    expected = [
        (k, np.array(library.encode_ordinary(t or ""), replay.ID).tobytes(), (t or "").encode())
        for k, t in given
    ]
    assert rows(done) == sorted(((k, bytearray(i), bytearray(o)) for k, i, o in expected), key=repr)
    assert replay.encoded(df.limit(0), "doc", "key", RANKS, PATTERN).collect() == []
    nothing = spark.createDataFrame([(1, None)], "k int, ids binary")
    assert replay.decoded(nothing, "k", "ids", RANKS).first().octets is None


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()

    def expected(text):
        found = np.array(library.encode_ordinary(text), replay.ID)
        return (
            len(found),
            hashlib.sha256(found.tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )

    assert rows(op11_byte_bpe(spark, folder)) == sorted(
        ((d.doc_id, *expected(d.text or "")) for d in documents), key=repr
    )
