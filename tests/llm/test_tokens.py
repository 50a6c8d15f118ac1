import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanery.llm.tokens import LONGEST_RUN, ByteTokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def both():
    return ByteTokenizer(PATH), Tokenizer.from_file(PATH)


def test_every_kind_of_code_point(both):
    fast, slow = both
    for base in range(0, 0x110000, 0x1000):
        points = [chr(x) for x in range(base, base + 0x1000, 7) if not 0xD800 <= x <= 0xDFFF]
        texts = [f"a{c}{c}1 {c}b" for c in points]
        ids = [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]
        assert [fast.encode(t) for t in texts] == ids


def test_random_texts(both):
    fast, slow = both
    rng = random.Random(6)
    alphabet = " \n\t'sd09.,-éßñ日本 ​\U0001f600abcXYZ"
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        assert fast.encode(text) == slow.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "text",
    ["", "<|endoftext|>", "a<|endoftext|>b", "x" * (LONGEST_RUN + 1), " " * (LONGEST_RUN + 1),
     "ab " * 60_000, "\n" * 50_000 + "end"],
)
def test_odd_texts(both, text):
    fast, slow = both
    assert fast.encode(text) == slow.encode(text, add_special_tokens=False).ids


def test_widths(both):
    fast, _ = both
    for text in ("plain words", "naïve 日本 \U0001f600!", "a<|endoftext|>b"):
        assert int(fast.widths[fast.encode(text)].sum()) == len(text.encode())
