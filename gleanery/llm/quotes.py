"""Replies linked to the messages they quote, and the messages without the quotes.

A line belongs to the quote level given by the `>` marks it begins with;
consecutive lines of one level are a passage. Passages are hashed with case
and white space evened out. A quoted passage is joined to the message that
said it first: in the same conversation before the reply, else the first one
anywhere that comes before it in the order of conversation and turn. Links
therefore never run in a circle. The message a reply answers is the latest one
of those that its passages of the lowest level lead to.

Messages are known by their passages, and by the paragraphs and lines of these.
So a quote of some paragraphs or lines is found as it is, and one from which
something in the middle was cut by the longest of its paragraphs and lines that
is found. Such a part leads to another conversation only if it is long enough
not to be a common phrase.

Only DataFrame functions are used. Who said a passage first is found by
minimum before anything is joined, so a passage that stands in a third of all
messages costs one row per conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import boxed, unboxed
from gleanery.scale import computed_once, exploded, let, written

#: Quote marks at the beginning of a line, blanks between them; no group, so any number will do.
_MARKS = r"^[> \t]*>"

#: Chains of replies longer than 2 to this power do not occur in sound input.
MAX_ROUNDS = 40

#: Words of a paragraph or line that is looked for in other conversations too.
AWAY_WORDS = 8

_WHOLE = -(1 << 31)


def passages(text: Column) -> Column:
    """Array of (level, body): the runs of lines with the same number of quote marks."""
    lines = F.split(text, r"\r\n|\r|\n")
    read = F.transform(
        lines,
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), "[^>]", "")).alias("level"),
            F.regexp_replace(line, _MARKS + r"[ \t]?", "").alias("body"),
        ),
    )

    def runs(line: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(line) - 1)
        begins = F.filter(
            places, lambda i: (i == 0) | (F.get(line, i)["level"] != F.get(line, i - 1)["level"])
        )

        def cut(starts: Column) -> Column:
            def run(start: Column, number: Column) -> Column:
                stop = F.coalesce(F.get(starts, number + 1), F.size(line))
                bodies = F.transform(F.slice(line, start + 1, stop - start), lambda x: x["body"])
                return F.struct(
                    F.get(line, start)["level"].alias("level"),
                    F.array_join(bodies, "\n").alias("body"),
                )

            return F.transform(starts, run)

        return F.element_at(F.transform(F.array(begins), cut), 1)

    return F.element_at(F.transform(F.array(read), runs), 1)


def evened(body: Column) -> Column:
    """Lower case, white space as single blanks, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(body), r"\s+", " "))


def _digest(body: Column) -> Column:
    even = evened(body)
    return F.when(even != "", F.md5(even.cast("binary")))


def _parts(body: Column) -> Column:
    """The paragraphs and the lines of a passage, evened."""
    parts = F.concat(F.split(body, r"\n\s*\n"), F.split(body, r"\n"))
    return F.transform(parts, evened)


def _known_far(even: Column) -> Column:
    return F.size(F.split(even, " ")) >= AWAY_WORDS


def _tries(body: Column) -> Column:
    """Digests a quoted passage is looked up by, the best first: itself, then the longest parts."""
    def with_parts(passage: Column) -> Column:
        whole = F.struct(
            F.lit(_WHOLE).alias("size"), F.lit(0).alias("part"), passage.alias("digest"),
            F.lit(True).alias("far"), passage.alias("passage"),
        )
        parts = F.transform(
            _parts(body),
            lambda even, n: F.struct(
                (-F.length(even)).alias("size"), n.alias("part"),
                F.md5(even.cast("binary")).alias("digest"), _known_far(even).alias("far"),
                passage.alias("passage"),
            ),
        )
        further = F.filter(parts, lambda p: (p["size"] < 0) & (p["digest"] != passage))
        return F.concat(F.array(whole), further)

    return let(_digest(body), with_parts)


def own_text(said: Column) -> Column:
    """What is left of a message without its quotes, white space at the ends removed."""
    own = F.transform(F.filter(said, lambda p: p["level"] == 0), lambda p: p["body"])
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+$", "")


def reply_order(
    df: DataFrame, conversation: str, turn: str, text: str, in_order: bool = True
) -> DataFrame:
    """`df` without quotes in `text`, and where each message stands in its chain of replies.

    Adds `reply_to` (conversation, turn) of the message answered, NULL where
    none is found, `thread`, the first message of the chain, `depth`, the
    number of replies before it, and `quoted`, every quoted passage with its
    level, digest and the message that said it, or the longest part of it that
    is found, first; they replace columns of these names. Rows come in the order of thread, depth, conversation and
    turn, replies after what they answer, unless `in_order` is false.

    NULL texts stay NULL and neither quote nor are quoted, as do rows with a
    NULL conversation or turn, whose thread is their own pair. Repeated rows
    are kept and linked alike; an empty table gives none.
    """
    rows = boxed(
        df,
        conv=F.col(conversation),
        turn=F.col(turn),
        body=F.xxhash64(text),
        said=F.when(F.col(text).isNotNull(), passages(F.col(text))),
    )
    rows = written(
        computed_once(rows.withColumnRenamed("said", "_said"), "said", F.col("_said")).drop("_said"),
        "messages",
    )
    keyed = rows.filter("conv is not null and turn is not null and said is not null")
    spoken = keyed.select("conv", "turn", F.explode(_own_digests()).alias("own"))
    here = (
        spoken.filter("own.digest is not null")
        .groupBy(F.col("own.digest").alias("digest"), "conv")
        .agg(F.min("turn").alias("here"), F.min(F.when(F.col("own.far"), F.col("turn"))).alias("_far"))
    )
    here = written(here, "spoken")
    anywhere = here.filter("_far is not null").groupBy("digest").agg(
        F.min(F.struct(F.col("conv"), F.col("_far").alias("turn"))).alias("first")
    )
    # Written, so that the join below splits a passage that very many messages quote.
    anywhere = written(anywhere, "first-spoken")
    quoted = keyed.select("conv", "turn", "body", F.posexplode("said").alias("place", "p")).filter(
        "p.level > 0"
    )
    quoted = quoted.select(
        "conv", "turn", "body", "place", F.col("p.level").alias("level"),
        F.col("p.body").alias("quote"),
    )
    # Rows with the array beside them would grow with the square of the lines, so nothing but the
    # try is kept of it.
    quoted = exploded(
        quoted, _tries(F.col("quote")), "try", "conv", "turn", "body", "place", "level"
    ).select("*", F.col("try.digest").alias("digest")).filter("try.passage is not null")
    message = F.struct(F.col("conv"), F.col("turn"))
    source = F.when(
        F.col("here") < F.col("turn"), F.struct(F.col("conv"), F.col("here").alias("turn"))
    ).when(F.col("try.far") & (F.col("first") < message), F.col("first"))
    linked = (
        quoted.join(here, ["digest", "conv"], "left")
        .join(anywhere, "digest", "left")
        .withColumn("source", source)
        .groupBy("conv", "turn", "body", "place", "level", F.col("try.passage").alias("digest"))
        .agg(
            F.min_by(
                "source", F.when(F.col("source").isNotNull(), F.struct("try.size", "try.part"))
            ).alias("source")
        )
    )
    answers = linked.groupBy("conv", "turn", "body").agg(
        F.min_by("source", F.when(F.col("source").isNotNull(), F.struct(
            "level", (F.col("source.conv") != F.col("conv")).alias("away"), -F.col("source.turn"), "place"
        ))).alias("reply_to"),
        F.array_sort(F.collect_list(F.struct("place", "level", "digest", "source"))).alias("quoted"),
    )
    answers = written(answers, "answers")
    chains = _chains(answers)
    joined = (
        rows.join(answers, ["conv", "turn", "body"], "left")
        .join(chains.withColumnsRenamed({"conv": "_c", "turn": "_t"}), (F.col("conv") == F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
    )
    result = joined.select(
        *unboxed(
            df.columns,
            **{
                text: own_text(F.col("said")),
                "reply_to": F.col("reply_to"),
                "thread": F.coalesce("thread", F.struct("conv", "turn")),
                "depth": F.coalesce("depth", F.lit(0)),
                "quoted": F.coalesce(F.col("quoted"), F.array().cast(answers.schema["quoted"].dataType)),
            },
        )
    )
    return result.orderBy("thread", "depth", conversation, turn) if in_order else result


def _own_digests() -> Column:
    """Digests of the unquoted passages of a message, of all of them together, and of their parts.

    `far` tells which of them other conversations may be linked to by.
    """
    own = F.transform(F.filter("said", lambda p: p["level"] == 0), lambda p: p["body"])
    whole = F.transform(
        F.concat(own, F.array(F.array_join(own, "\n"))),
        lambda body: F.struct(_digest(body).alias("digest"), F.lit(True).alias("far")),
    )
    parts = F.transform(
        F.filter(F.flatten(F.transform(own, _parts)), lambda even: even != ""),
        lambda even: F.struct(
            F.md5(even.cast("binary")).alias("digest"), _known_far(even).alias("far")
        ),
    )
    return F.concat(whole, parts)


def _chains(answers: DataFrame) -> DataFrame:
    """`thread` and `depth` of every message that answers one, by doubling the steps taken.

    Rows with the same conversation and turn are one message here: the one
    whose answer comes first counts.
    """
    step = (
        answers.filter("reply_to is not null")
        .groupBy("conv", "turn")
        .agg(F.min("reply_to").alias("thread"))
        .withColumn("depth", F.lit(1))
    )
    going, ended = written(step, "chains"), []
    for _ in range(MAX_ROUNDS):
        known = reduce(DataFrame.unionByName, ended, going)
        further = known.select(
            F.col("conv").alias("_c"), F.col("turn").alias("_t"),
            F.col("thread").alias("_thread"), F.col("depth").alias("_depth"),
        )
        reached = (F.col("thread.conv") == F.col("_c")) & (F.col("thread.turn") == F.col("_t"))
        moved = written(
            going.join(further, reached, "left").select(
                "conv", "turn",
                F.coalesce("_thread", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
                F.col("_thread").isNotNull().alias("moved"),
            ),
            "chains",
        )
        # A chain whose end answers nothing is at its first message and is not looked up again.
        ended.append(moved.filter("not moved").drop("moved"))
        going = moved.filter("moved").drop("moved")
        if not going.limit(1).count():
            return reduce(DataFrame.unionByName, ended)
    raise RuntimeError(f"chains of replies did not end after {MAX_ROUNDS} doublings")


def as_mail(df: DataFrame, conversation: str, turn: str, text: str) -> DataFrame:
    """Turns as a mail program would send them: the two turns before quoted above the own text.

    As people do, some cut what they quote of the turn just before: every third
    turn keeps its first line only, every third its first and its last.
    """
    def before(back: int, name: str) -> DataFrame:
        return (
            df.groupBy(F.col(conversation).alias("_c"), (F.col(turn) + back).alias("_t"))
            .agg(F.max(text).alias(name))
        )

    def joined(left: DataFrame, back: int) -> DataFrame:
        right = before(back, f"_{back}")
        same = (F.col(conversation) == F.col("_c")) & (F.col(turn) == F.col("_t"))
        return left.join(right, same, "left").drop("_c", "_t")

    def marked(quote: Column, marks: str) -> Column:
        return F.concat(F.regexp_replace(quote, r"(?m)^", marks), F.lit("\n"))

    rows = joined(joined(df, 1), 2)
    none = F.lit("")
    first, last = F.substring_index("_1", "\n", 1), F.substring_index("_1", "\n", -1)
    ends = F.when(F.size(F.split("_1", "\n")) > 2, F.concat(first, F.lit("\n"), last)).otherwise(F.col("_1"))
    kept = F.when(F.pmod(F.col(turn), F.lit(3)) == 2, first).when(
        F.pmod(F.col(turn), F.lit(3)) == 1, ends
    ).otherwise(F.col("_1"))
    body = F.concat(
        F.coalesce(marked(F.col("_2"), ">> "), none), F.coalesce(marked(kept, "> "), none), F.col(text)
    )
    return rows.withColumn(text, body).select(*df.columns)
