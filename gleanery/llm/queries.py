"""One query per operator of this package over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import (
    attribution,
    chain,
    mixture,
    permuterm,
    pseudo,
    pstable,
    quotes,
    repair,
    replay,
    revisit,
    seeds,
    simhash,
    substring,
)
from gleanery.sources.tables import read_table


def op1_substring(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the passages they share with earlier ones, and whose those are."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    return substring.without_copies(documents, "doc_id", "text").withColumn(
        "removed_bytes",
        F.aggregate("removed", F.lit(0), lambda n, s: n + s["stop"] - s["start"]),
    )


def op2_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """All turns, sent as mail that quotes the two before, linked again and freed of quotes."""
    turns = read_table(spark, folder, "conversations")
    mail = quotes.as_mail(turns, "conv_id", "turn", "text")
    return quotes.reply_order(mail, "conv_id", "turn", "text").select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.col("reply_to.conv").alias("reply_conv_id"),
        F.col("reply_to.turn").alias("reply_turn"),
        F.col("thread.conv").alias("thread_conv_id"),
        F.col("thread.turn").alias("thread_turn"),
        "depth",
        F.size("quoted").alias("quoted_passages"),
    )


# The same from the turns themselves: a turn quotes the one before it, cut by thirds, and the
# one before that. What counts as said first is the earliest turn of the conversation with
# those words as its text, a paragraph or a line; a cut quote counts by its longest line.
OP2_SQL = r"""
WITH RECURSIVE said AS (
  SELECT conv_id, turn, role, text, regexp_replace(text, '^\s+|\s+$', '', 'g') AS own,
         trim(regexp_replace(lower(text), '\s+', ' ', 'g')) AS even,
         string_split(text, chr(10)) AS lines
  FROM conversations),
units AS (
  SELECT conv_id, turn, text AS unit FROM said
  UNION ALL SELECT conv_id, turn, unnest(regexp_split_to_array(text, '\n\s*\n')) FROM said
  UNION ALL SELECT conv_id, turn, unnest(lines) FROM said),
first_here AS (
  SELECT conv_id, trim(regexp_replace(lower(unit), '\s+', ' ', 'g')) AS even, min(turn) AS turn
  FROM units GROUP BY ALL HAVING even <> ''),
kept AS (
  SELECT s.conv_id, s.turn,
         CASE WHEN s.turn % 3 = 2 THEN p.lines[1]
              WHEN s.turn % 3 = 1 AND len(p.lines) > 2 THEN p.lines[1] || chr(10) || p.lines[-1]
              ELSE p.text END AS quote
  FROM said s JOIN said p ON p.conv_id = s.conv_id AND p.turn = s.turn - 1),
tries AS (
  SELECT conv_id, turn, 0 AS part, quote AS piece FROM kept
  UNION ALL
  SELECT conv_id, turn, unnest(range(1, len(string_split(quote, chr(10))) + 1)),
         unnest(string_split(quote, chr(10)))
  FROM kept),
ranked AS (
  SELECT t.conv_id, t.turn, f.turn AS up,
         row_number() OVER (PARTITION BY t.conv_id, t.turn
                            ORDER BY t.part > 0, length(f.even) DESC, t.part) AS best
  FROM tries t
  JOIN first_here f ON f.conv_id = t.conv_id AND f.turn < t.turn
   AND f.even = trim(regexp_replace(lower(t.piece), '\s+', ' ', 'g'))),
linked AS (
  SELECT s.conv_id, s.turn, s.role, s.own AS text, coalesce(f1.up, f2.turn) AS up,
         (trim(regexp_replace(k.quote, '\s+', ' ', 'g')) <> '')::INT AS n1, (p2.even <> '')::INT AS n2
  FROM said s
  LEFT JOIN kept k ON k.conv_id = s.conv_id AND k.turn = s.turn
  LEFT JOIN ranked f1 ON f1.conv_id = s.conv_id AND f1.turn = s.turn AND f1.best = 1
  LEFT JOIN said p2 ON p2.conv_id = s.conv_id AND p2.turn = s.turn - 2
  LEFT JOIN first_here f2 ON f2.conv_id = s.conv_id AND f2.even = p2.even),
chain AS (
  SELECT conv_id, turn, turn AS root, 0 AS depth FROM linked WHERE up IS NULL
  UNION ALL
  SELECT l.conv_id, l.turn, c.root, c.depth + 1
  FROM linked l JOIN chain c ON c.conv_id = l.conv_id AND c.turn = l.up)
SELECT l.conv_id, l.turn, l.role, l.text,
       CASE WHEN l.up IS NOT NULL THEN l.conv_id END AS reply_conv_id, l.up AS reply_turn,
       l.conv_id AS thread_conv_id, c.root AS thread_turn, c.depth,
       CAST(coalesce(n1, 0) + coalesce(n2, 0) AS INTEGER) AS quoted_passages
FROM linked l JOIN chain c USING (conv_id, turn)
"""


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and the benchmark texts they overlap."""
    documents = read_table(spark, folder, "documents")
    benchmark = read_table(spark, folder, "benchmark")
    return seeds.overlaps(documents, "doc_id", "text", benchmark, "item_id", "text")


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of the source, the language and every line of the text of all documents."""
    documents = read_table(spark, folder, "documents")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return attribution.token_counts(documents, "doc_id", ["source", "lang", "text"], tokenizer)


def op5_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """The second captures of all pages, resolved to the first."""
    records = revisit.capture_records(read_table(spark, folder, "pages"))
    headers = F.array_sort(F.map_entries("headers"))
    lines = F.transform(headers, lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return revisit.resolve_revisits(records).withColumn("headers", F.array_join(lines, "\n"))


def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_table(spark, folder, "documents")
    return simhash.simhash_groups(documents, "doc_id", "text")


def op7_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return pstable.vector_groups(read_table(spark, folder, "embeddings"), "vec_id", "embedding")


#: Shortest piece that the queries cut from a longer document, in ids.
LEAST_PACKET = 128


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_pieces(read_table(spark, folder, "documents"))


def packed_pieces(documents: DataFrame) -> DataFrame:
    """Pieces of the packed documents with the checksum of their ids in place of the ids."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = mixture.pack(
        documents, "doc_id", "text", "source", tokenizer, least=LEAST_PACKET
    )
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "source",
    )


def op9_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo.score_texts(read_table(spark, folder, "documents"), "doc_id", "text")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the probability of each category and whether it is toxic."""
    documents = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    labels = read_table(spark, folder, "labels")
    model = chain.fit(documents, labels, "doc_id", "text", chain.corpus_categories())
    scores = chain.scored(documents.select("doc_id", "text"), "text", model)
    return scores.select(
        "doc_id",
        F.col("categories.poor").alias("p_poor"),
        F.col("categories.toxic").alias("p_toxic"),
        F.col("categories.toxic_foreign").alias("p_toxic_foreign"),
        (F.col("categories.toxic") >= chain.REJECT_FROM).alias("toxic"),
    )


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every document encoded and decoded again, with digests in place of ids and bytes."""
    documents = read_table(spark, folder, "documents")
    ranks = replay.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    ids = replay.encoded(documents, "doc_id", "text", ranks, public_tokenizers.PATTERN)
    return replay.decoded(ids, "doc_id", "ids", ranks).select(
        "doc_id",
        (F.octet_length("ids") / replay.ID.itemsize).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("octets", 256).alias("decoded_sha256"),
    )


def op12_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged and repaired: their faults, edits and a digest of the result."""
    turns = read_table(spark, folder, "conversations")
    names = ["conv_id", "turn", "role", "text"]
    edits = repair.edited(repair.damaged(turns, *names), "conv", "turn", "role", "text")
    every = turns.select("conv_id").distinct()
    found = repair.reports(edits)
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    return joined.select(
        "conv_id",
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in repair.COUNTS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op13_permuterm(spark: SparkSession, folder: str) -> DataFrame:
    """Words of five letters or more that occur three times or more, and the form each varies."""
    documents = read_table(spark, folder, "documents")
    counts = permuterm.word_counts(documents, "doc_id", "text", shortest=5)
    return permuterm.variants(counts.filter("n >= 3")).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )


CORPUS_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring": op1_substring,
    "op2_quotes": op2_quotes,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_revisits": op5_revisits,
    "op6_simhash": op6_simhash,
    "op7_embeddings": op7_embeddings,
    "op8_packing": op8_packing,
    "op9_pseudo_likelihood": op9_pseudo_likelihood,
    "op10_toxicity": op10_toxicity,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_repair": op12_repair,
    "op13_permuterm": op13_permuterm,
}

CORPUS_SQL: dict[str, str] = {
    "op2_quotes": OP2_SQL,
}
