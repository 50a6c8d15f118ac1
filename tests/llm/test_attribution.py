import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanery.llm import attribution

PATH = public_tokenizers.path("byte_bpe_50k.json")
SLOW = Tokenizer.from_file(PATH)


def expected(fields, rule):
    present = [(n, f) for n, f in fields if f is not None]
    text = "\n".join(f for _, f in present)
    spans, at = [], 0
    for i, (name, f) in enumerate(present):
        own = f + ("\n" if i < len(present) - 1 else "")
        for line in own.split("\n")[:-1]:
            spans.append((name, at, at + len(line) + 1))
            at += len(line) + 1
        rest = own.split("\n")[-1]
        if rest:
            spans.append((name, at, at + len(rest)))
            at += len(rest)
    counts = [0] * len(spans)
    encoding = SLOW.encode(text, add_special_tokens=False)
    for a, b in encoding.offsets:
        shares = [max(0, min(b, stop) - max(a, start)) for _, start, stop in spans]
        touched = [i for i, s in enumerate(shares) if s]
        counts[{"most": int(np.argmax(shares)), "first": touched[0], "last": touched[-1]}[rule]] += 1
    return [(n, name, a, b, c, len(encoding.ids)) for n, ((name, a, b), c) in enumerate(zip(spans, counts, strict=True))]


ROWS = [
    (1, "src", "some words\nand more", "end"),
    (2, None, "\n\n\nblank lines   \n\n x\n", ""),
    (3, "é日本\U0001f600", "naïve\n\U0001f600\n日", None),
    (4, None, None, None),
    (5, "", "", ""),
    (6, "a<|endoftext|>b", "c\r\nd", "e"),
    (7, "w " * 20_000, "x", "y"),
    (None, "no key", "t", "u"),
]


@pytest.mark.parametrize("rule", ["most", "first", "last"])
def test_agrees_with_offsets_of_the_whole(spark, rule):
    df = spark.createDataFrame(
        [(*r, 1) for r in ROWS], "doc_id long, a string, b string, c string, tokens int"
    )
    found = attribution.token_counts(df, "doc_id", ["a", "b", "c"], PATH, rule).collect()
    for key, *values in ROWS:
        got = sorted(
            (r.section, r.field, r.start, r.stop, r.tokens, r.doc_tokens) for r in found if r.doc_id == key
        )
        assert got == expected(list(zip("abc", values, strict=True)), rule), key


def test_random_documents(spark):
    rng = random.Random(2)
    rows = [
        (n, "".join(rng.choice(" \n\nab.,é日") for _ in range(rng.randrange(1, 60)))) for n in range(150)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = attribution.token_counts(df, "doc_id", ["text"], PATH).collect()
    for key, text in rows:
        got = sorted((r.section, r.field, r.start, r.stop, r.tokens, r.doc_tokens) for r in found if r.doc_id == key)
        assert got == expected([("text", text)], "most")
    assert any(r.crossing for r in found)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x y"), (1, "x y")], "doc_id long, text string")
    assert attribution.token_counts(df, "doc_id", ["text"], PATH).count() == 2
    assert attribution.token_counts(df.filter("false"), "doc_id", ["text"], PATH).count() == 0
