import pytest
from pyspark.sql import functions as F

from gleanery.llm import quotes

MAILS = [
    (1, 0, "hello there\nfriend"),
    (1, 1, "> Hello  there\n> friend\n\nyes I agree"),
    (1, 2, ">> hello there\n>> friend\n> yes I agree\nok"),
    (2, 0, "> ok\nelse"),
    (2, 1, None),
    (2, 2, ""),
    (2, 3, "> > ok\n> else\nfine\n> nobody said this"),
    (3, 0, "ok"),
    (3, 1, "ok"),
    (3, 2, "> ok\r\nsure\r\n"),
]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, "c long, t long, text string")
    found = quotes.reply_order(df, "c", "t", "text", **options).collect()
    return found, {(r.c, r.t): r for r in found}


def test_links_and_order(spark):
    found, by = run(spark, MAILS)
    reply = {k: tuple(r.reply_to) if r.reply_to else None for k, r in by.items()}
    assert reply == {
        (1, 0): None, (1, 1): (1, 0), (1, 2): (1, 1), (2, 0): (1, 2), (2, 1): None, (2, 2): None,
        (2, 3): (2, 0), (3, 0): None, (3, 1): None, (3, 2): (3, 0),
    }
    assert {k: r.depth for k, r in by.items() if r.depth} == {(1, 1): 1, (1, 2): 2, (2, 0): 3, (2, 3): 4, (3, 2): 1}
    assert tuple(by[2, 3].thread) == (1, 0)
    assert [by[k].text for k in ((1, 1), (1, 2), (2, 1), (2, 2), (3, 2))] == ["yes I agree", "ok", None, "", "sure"]
    assert [(q.level, q.source and tuple(q.source)) for q in by[2, 3].quoted] == [
        (2, (1, 2)), (1, (2, 0)), (1, None)
    ]
    keys = [(tuple(r.thread), r.depth, r.c, r.t) for r in found]
    assert keys == sorted(keys)


def test_trimmed_quotes(spark):
    first = "Hi,\nwe meet on Monday at nine\nin the small room\n\nBring the papers along with you please\n\nAnna"
    rows = [
        (1, 0, first),
        # One paragraph of two, in other case and spacing, and one line of a paragraph.
        (1, 1, "> bring  the papers along with you PLEASE\nI will"),
        (1, 2, "> in the small room\nnot the large one"),
        # Two paragraphs with a blank line between them that is not marked.
        (1, 3, "> we meet on Monday at nine\n> in the small room\n\n> Bring the papers along with you please\nboth fine"),
        # Something in the middle cut: the longest line decides, though a shorter one was said elsewhere.
        (1, 4, "I will\nand more of it"),
        (1, 5, "> I will\n> ...\n> we meet on Monday at nine\nsure"),
        (1, 6, "> ...\n> never said at all\nwhat"),
        # Away from their conversation short parts lead nowhere, long ones do.
        (2, 0, "> in the small room\nx"),
        (2, 1, "a line of eight words that stand together\nsecond line"),
        (3, 0, "> A line of eight words that stand together\ny"),
        (3, 1, "> Hi,\n> something that nobody ever said before here\nz"),
    ]
    _, by = run(spark, rows)
    reply = {k: tuple(r.reply_to) if r.reply_to else None for k, r in by.items() if ">" in dict(((a, b), t) for a, b, t in rows)[k]}
    assert reply == {
        (1, 1): (1, 0), (1, 2): (1, 0), (1, 3): (1, 0), (1, 5): (1, 0), (1, 6): None,
        (2, 0): None, (3, 0): (2, 1), (3, 1): None,
    }
    assert [tuple(q.source) for q in by[1, 3].quoted] == [(1, 0), (1, 0)]
    assert by[1, 3].text == "both fine"


def test_a_very_long_quote(spark):
    lines = [f"line number {n} of many" for n in range(20000)]
    text = "\n".join(lines)
    cut = "\n".join(f"> {x}" for x in lines[5:] if x != lines[900])
    _, by = run(spark, [(1, 0, text), (1, 1, cut + "\nI read it"), (1, 2, "> I read it\ngood")])
    assert tuple(by[1, 1].reply_to) == (1, 0) and by[1, 1].text == "I read it"
    assert by[1, 2].depth == 2


def test_levels(spark):
    text = "own\n> one\n>one more\n> > two\n>\n\t> tabbed\n>>> three\nlast"
    said = spark.range(1).select(quotes.passages(F.lit(text)).alias("s")).first().s
    assert [(p.level, p.body) for p in said] == [
        (0, "own"), (1, "one\none more"), (2, "two"), (1, "\ntabbed"), (3, "three"), (0, "last")
    ]


def test_long_chains(spark):
    rows = [(1, 0, "line 0")] + [(1, n, f"> line {n - 1}\nline {n}") for n in range(1, 40)]
    _, by = run(spark, rows)
    assert all(by[1, n].depth == n and tuple(by[1, n].thread) == (1, 0) for n in range(40))


def test_a_passage_that_all_quote(spark):
    rows = [(c, t, "same words" if t == 0 else f"> same words\nanswer {c} {t}") for c in range(60) for t in range(3)]
    _, by = run(spark, rows)
    assert all(tuple(by[c, t].reply_to) == (c, 0) for c in range(60) for t in (1, 2))


def test_odd_rows(spark):
    rows = [(None, 1, "> x\ny"), (1, None, "x"), (1, 1, "x"), (1, 1, "x"), (1, 2, "> x\nz"), (1, 2, "> x\nz"), (4, 0, "> " * 3000 + "deep")]
    found, by = run(spark, rows)
    assert len(found) == len(rows)
    assert by[None, 1].reply_to is None and by[None, 1].text == "y"
    assert tuple(by[1, 2].reply_to) == (1, 1)
    assert by[4, 0].quoted[0].level == 3000


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, 0, "a", "p", 1), (1, 1, "> a\nb", "q", 2)], "conv long, turn long, said string, digest string, depth int")
    found = quotes.reply_order(df, "conv", "turn", "said")
    assert found.columns == ["conv", "turn", "said", "digest", "depth", "reply_to", "thread", "quoted"]
    assert [(r.said, r.digest, r.depth) for r in found.collect()] == [("a", "p", 0), ("b", "q", 1)]


@pytest.mark.parametrize("rows", [[], [(1, 0, None)]])
def test_little(spark, rows):
    assert len(run(spark, rows)[0]) == len(rows)


def test_only_dataframe_functions(spark):
    df = spark.createDataFrame(MAILS, "c long, t long, text string")
    plan = quotes.reply_order(df, "c", "t", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
