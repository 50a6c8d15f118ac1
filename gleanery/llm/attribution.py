"""Token counts of the fields and sections of documents, from one encoding of the whole.

The fields of a document are joined by line ends and encoded once, as a model
would read them. Every token has a span of characters, every field is cut into
its lines, and the two are joined by their intervals. A section owns the line
end that closes it, so the sections cover the document without gaps and every
token is counted exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.tokens import ByteTokenizer

#: Rules for a token that crosses the end of a section: it goes to the section with most of
#: its characters (the earlier one of equals), or to the one with its first or last character.
MOST, FIRST, LAST = "most", "first", "last"


def token_spans(octets: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First character and character after the last of every token, and characters up to each byte.

    A token that holds a part of a character spans the whole character.
    """
    upto = np.cumsum((octets & 0xC0) != 0x80)
    stops = np.cumsum(widths)
    starts = stops - widths
    return upto[starts] - 1, upto[stops - 1], upto


def allocate(begin: np.ndarray, end: np.ndarray, bounds: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of every token, and which tokens cross; `bounds` are 0 and the ends of the sections."""
    first = np.searchsorted(bounds, begin, "right") - 1
    last = np.searchsorted(bounds, end - 1, "right") - 1
    crossing = first != last
    if rule == FIRST:
        return first, crossing
    if rule == LAST:
        return last, crossing
    section = first.copy()
    for t in np.flatnonzero(crossing):
        inside = bounds[first[t] : last[t] + 2]
        shares = np.minimum(inside[1:], end[t]) - np.maximum(inside[:-1], begin[t])
        section[t] = first[t] + int(shares.argmax())
    return section, crossing


def sections_of(fields: Sequence[str | None]) -> tuple[str, np.ndarray, np.ndarray]:
    """The document, the ends of its sections in bytes, and the number of the field of each."""
    present = [(n, value) for n, value in enumerate(fields) if value is not None]
    parts = [value + "\n" for _, value in present[:-1]] + [value for _, value in present[-1:]]
    ends, owners, before = [], [], 0
    for (number, _), part in zip(present, parts, strict=True):
        octets = np.frombuffer(part.encode("utf-8", "surrogatepass"), np.uint8)
        cuts = np.flatnonzero(octets == 10) + 1
        if len(octets) and (not len(cuts) or cuts[-1] != len(octets)):
            cuts = np.append(cuts, len(octets))
        ends.append(cuts + before)
        owners.append(np.full(len(cuts), number))
        before += len(octets)
    none = np.zeros(0, np.int64)
    return "".join(parts), np.concatenate([none, *ends]), np.concatenate([none, *owners])


def token_counts(
    df: DataFrame, key: str, fields: Sequence[str], tokenizer: str, rule: str = MOST
) -> DataFrame:
    """One row per document and section with the number of its tokens.

    Columns `key`, `section` (from 0), `field`, `start` and `stop` (characters
    in the joined document), `tokens`, `crossing` (tokens that begin in the
    section and end in a later one) and `doc_tokens`. NULL fields are left
    out; an empty field that is not the last is its line end. A document
    without any characters has no sections. Repeated rows are documents of
    their own.
    """
    names = list(fields)
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), *[F.col(f).cast("string").alias(f"f{n}") for n, f in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokenizer(tokenizer)
        for batch in batches:
            places, columns = [], [[] for _ in range(7)]
            for at, values in enumerate(zip(*batch.columns[1:], strict=True)):
                text, ends, owners = sections_of([v.as_py() for v in values])
                if not len(ends):
                    continue
                octets = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
                ids = np.array(tokens.encode(text), np.int64)
                begin, end, upto = token_spans(octets, tokens.widths[ids])
                bounds = np.concatenate([[0], upto[ends - 1]])
                section, crossing = allocate(begin, end, bounds, rule)
                cross = np.searchsorted(bounds, begin[crossing], "right") - 1
                n = len(ends)
                found = (
                    np.arange(n), owners, bounds[:-1], bounds[1:],
                    np.bincount(section, minlength=n), np.bincount(cross, minlength=n),
                    np.full(n, len(ids)),
                )
                places.append(np.full(n, at))
                for column, value in zip(columns, found, strict=True):
                    column.append(value)
            if places:
                number, owner, *counts = (np.concatenate(c).astype(np.int64) for c in columns)
                keys = batch.column(0).take(pa.array(np.concatenate(places)))
                field = pa.array(names).take(pa.array(owner))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(number), field, *map(pa.array, counts)], schema
                )

    schema = ["key", "section", "field", "start", "stop", "tokens", "crossing", "doc_tokens"]
    done = rows.mapInArrow(
        run,
        f"key {kind}, section long, field string, start long, stop long, tokens long, "
        "crossing long, doc_tokens long",
    )
    return done.withColumnRenamed("key", key)
