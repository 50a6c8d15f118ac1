"""Near copies by SimHash: fingerprints of word shingles, compared exactly in tiles.

The distinct fingerprints are dealt into buckets by stretches of their bits.
Two of them within `radius` bits agree on at least one of `radius + 1`
stretches, so nothing is missed. Within a bucket they are sorted by their bit
counts and compared tile by tile with exclusive-or and bit counts; tile pairs
whose bit counts differ by more than the radius are skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import Forest, components, in_groups, numbers, tiled, whole_groups
from gleanery.scale import written

BITS = 64
SEED = 42
SHINGLE = 4
RADIUS = 4

#: Rows of one numpy comparison inside a task.
BLOCK = 512

#: Shingles whose bits are unpacked at once.
SLICE = 1 << 14

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint of a text: the bits set in over half of its shingle hashes.

    Words are what stands between ASCII white space, A-Z in lower case. Fewer
    words than a shingle are taken as one shingle; without words it is 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(shingle, len(words))
    stops = (ends[width - 1 :] - 1).tolist()
    begins = [0, *ends[: len(words) - width].tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(begins, stops, strict=True)),
        ">u8",
        len(stops),
    )
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), SLICE):
        octets = hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(df: DataFrame, text: str, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """Columns `keep` and `fingerprint`, the 64 bits as a signed long, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array(
                [fingerprint(t.as_py(), shingle) for t in batch.column(len(keep))], np.uint64
            )
            arrays = [*batch.columns[:-1], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "fingerprint"])

    kept = df.select(*keep, text)
    schema = kept.select(*keep).schema.add("fingerprint", "long")
    return kept.mapInArrow(run, schema)


def _stretches(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of radius + 1 stretches that cover the fingerprint."""
    cuts = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def compare(prints: np.ndarray, tile: np.ndarray, cross: bool, radius: int, forest: Forest) -> None:
    """Links rows of one bucket whose fingerprints differ in at most `radius` bits.

    With `cross` only rows of different tiles are compared.
    """
    counts = np.bitwise_count(prints)
    order = np.lexsort((counts, tile)) if cross else np.argsort(counts, kind="stable")
    first = int((tile == tile.min()).sum()) if cross else 0
    left = order[:first] if cross else order
    right = order[first:] if cross else order
    for i in range(0, len(left), BLOCK):
        a = left[i : i + BLOCK]
        for j in range(0 if cross else i, len(right), BLOCK):
            b = right[j : j + BLOCK]
            if int(counts[b[0]]) - int(counts[a[-1]]) > radius:
                break
            if int(counts[a[0]]) - int(counts[b[-1]]) > radius:
                continue
            near = np.bitwise_count(prints[a][:, None] ^ prints[b][None, :]) <= radius
            x, y = np.nonzero(near)
            forest.link(a[x], b[y])


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links `a`, `b` that join all fingerprints within `radius` bits, a spanning forest per tile.

    `distinct` has each fingerprint once.
    """
    stretches = _stretches(radius)
    masked = [
        F.struct(
            F.lit(n).alias("stretch"),
            F.shiftrightunsigned("fingerprint", shift)
            .bitwiseAND(F.lit((1 << width) - 1))
            .alias("value"),
        )
        for n, (shift, width) in enumerate(stretches)
    ]
    rows = distinct.select("fingerprint", F.inline(F.array(*masked)))
    strip = F.floor(F.bit_count("fingerprint") / (radius + 1))
    keys = ["stretch", "value"]
    pairs = in_groups(tiled(rows, keys, F.col("fingerprint"), strip), [*keys, "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_groups(batches, [*keys, "low", "high"]):
            prints, tile = numbers(table, "fingerprint"), numbers(table, "tile")
            low, high = numbers(table, "low"), numbers(table, "high")
            bits = prints.view(np.uint64)
            found = []
            for a, b in zip(starts, [*starts[1:], table.num_rows], strict=True):
                cross = low[a] != high[a]
                if b - a < 2 or cross and tile[a:b].min() == tile[a:b].max():
                    continue
                forest = Forest(b - a)
                compare(bits[a:b], tile[a:b], cross, radius, forest)
                x, y = forest.edges()
                found.append((prints[a:b][x], prints[a:b][y]))
            for x, y in found:
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def simhash_groups(
    df: DataFrame, key: str, text: str, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """`key`, `fingerprint` (16 hex digits) and `component_id` for every row of `df`.

    Texts whose fingerprints differ in at most `radius` bits are linked;
    `component_id` is the least `key` that can be reached by links, the row's
    own included. Texts without words (NULL, empty) have fingerprint 0 and are
    linked like any other. Rows with a NULL key are kept; a group of only such
    rows has a NULL component. Repeated rows appear as often as they came.
    """
    prints = written(fingerprints(df, text, [key], shingle), "fingerprints")
    classes = written(
        prints.groupBy("fingerprint").agg(F.min(key).alias("_least")), "fingerprint-classes"
    )
    groups = components(fingerprint_links(classes.select("fingerprint"), radius))
    member = classes.join(
        groups.select(F.col("node").alias("fingerprint"), "component"), "fingerprint", "left"
    ).select(
        "fingerprint", "_least", F.coalesce("component", "fingerprint").alias("component")
    )
    least = member.groupBy("component").agg(F.min("_least").alias("component_id"))
    label = written(
        member.join(least, "component").select("fingerprint", "component_id"), "fingerprint-groups"
    )
    return prints.join(label, "fingerprint").select(
        key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(df: DataFrame, key: str, text: str, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows of `df` that stand for their group of near copies: those with the least key.

    Of rows with the same key all stay or none; rows with a NULL key stay.
    """
    groups = simhash_groups(df.filter(F.col(key).isNotNull()), key, text, shingle, radius)
    gone = groups.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    return df.join(gone, key, "left_anti").select(*df.columns)
