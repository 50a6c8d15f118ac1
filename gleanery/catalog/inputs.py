"""The observation feed the queries run on, derived from the given tables.

Every document is one observation of a posting. Copies of a text are repeated
observations of the same posting; the language, source and labels supply
spellings, padding, gaps and packed lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.functions.text import WORD, WORD_OR_UNDERSCORE
from gleanery.operators.vocabulary import vocabulary
from gleanery.plans.curation import Feed
from gleanery.sources.tables import read_table, spread

# Vocabulary of words, phrases and marks that occur in the texts.
ALIASES = (
    ("en", "English"),
    ("english", "English"),
    ("fr", "French"),
    ("french", "French"),
    ("de", "German"),
    ("german", "German"),
    ("es", "Spanish"),
    ("spanish", "Spanish"),
    ("src1", "Preferred source"),
    ("src2", "Preferred source"),
    ("Src3", "Preferred source"),
    ("license", "License"),
    ("licensed", "License"),
    ("licensed under", "License"),
    ("mit", "MIT License"),
    ("mit license", "MIT License"),
    ("gnu", "GNU License"),
    ("gnu general public license", "GNU License"),
    ("apache", "Apache License"),
    ("apache license", "Apache License"),
    ("cc by-nc", "CC License"),
    ("by-nc 4.0", "CC License"),
    ("2.0", "Version 2"),
    ("4.0.", "Version 4"),
    ("r", "R"),
    ("c", "C"),
    ("c++", "C++"),
    ("on the", "On the"),
    ("THE", "Article"),
    ("the", "Article"),
    ("example.com", "Mail"),
    ("@", "Mail"),
    ("+1 (", "Telephone"),
    ("***", "Noise"),
    ("$$$", "Noise"),
    ("tion", "Syllable"),
    ("é", "Accent"),
    ("token = ", "Secret"),
)

FEED = Feed(
    key="posting_id",
    newest="observed",
    tie_break=("row_no",),
    name="company_name",
    text="description",
    packed="description_tokens",
    kinds={"row_no": "bigint", "observed": "int", "remote": "boolean", "salary": "numeric"},
    trim=("location",),
    fact_columns=("posting_id", "title", "company_id", "location", "remote", "description"),
)


def aliases(spark: SparkSession) -> DataFrame:
    return vocabulary(spark, ALIASES)


def observations(spark: SparkSession, folder: str, heavy: bool = False) -> DataFrame:
    """All-text feed, one row per document; `heavy` where the texts are to be searched."""
    documents = read_table(spark, folder, "documents")
    documents = spread(documents) if heavy else documents
    labels = read_table(spark, folder, "labels")
    lang, source, toxic, quality = (F.col(c) for c in ("lang", "source", "toxic", "quality"))

    def listed(separator: str):
        return F.concat(F.lit("['"), lang, F.lit(separator), source, F.lit("']"))

    return documents.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("row_no"),
        F.concat(F.lit("posting-"), F.md5(F.col("text").cast("binary"))).alias("posting_id"),
        lang.alias("title"),
        F.when(toxic == 1, None)
        .when(lang == "fr", F.upper(source))
        .when(lang == "de", F.replace(source, F.lit("src"), F.lit("Src")))
        .otherwise(source)
        .alias("company_name"),
        F.when(lang == "es", None)
        .when(toxic == 1, "   ")
        .when(quality == 0, "")
        .when(quality == 1, F.concat(F.lit(" "), source, F.lit("  ")))
        .otherwise(source)
        .alias("location"),
        F.col("text").alias("description"),
        F.col("doc_id").cast("string").alias("observed"),
        F.when(toxic == 1, "True").when(toxic == 0, "False").alias("remote"),
        F.col("n_chars").cast("string").alias("salary"),
        F.when(toxic == 1, None)
        .when(quality == 1, listed("', '"))
        .when(quality == 0, listed("','"))
        .otherwise("[]")
        .alias("description_tokens"),
    )


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OBSERVATIONS_SQL = """observations AS (
  SELECT
    CAST(doc_id AS VARCHAR) AS row_no,
    'posting-' || md5(text) AS posting_id,
    lang AS title,
    CASE WHEN toxic = 1 THEN NULL WHEN lang = 'fr' THEN upper(source)
         WHEN lang = 'de' THEN replace(source, 'src', 'Src') ELSE source END AS company_name,
    CASE WHEN lang = 'es' THEN NULL WHEN toxic = 1 THEN '   ' WHEN quality = 0 THEN ''
         WHEN quality = 1 THEN ' ' || source || '  ' ELSE source END AS location,
    text AS description,
    CAST(doc_id AS VARCHAR) AS observed,
    CASE toxic WHEN 1 THEN 'True' WHEN 0 THEN 'False' END AS remote,
    CAST(n_chars AS VARCHAR) AS salary,
    CASE WHEN toxic = 1 THEN NULL
         WHEN quality = 1 THEN '[''' || lang || ''', ''' || source || ''']'
         WHEN quality = 0 THEN '[''' || lang || ''',''' || source || ''']'
         ELSE '[]' END AS description_tokens
  FROM documents LEFT JOIN labels USING (doc_id))"""

VOCABULARY_SQL = (
    "vocabulary(source_name, standard_name) AS (VALUES "
    + ", ".join(f"({_sql_text(a)}, {_sql_text(b)})" for a, b in ALIASES)
    + ")"
)


def matches_sql(word: str = WORD, rows: str = "observations") -> str:
    """CTE with every observation with an empty list and the terms that stand in its text."""
    return f"""{found_sql("searched", f"(SELECT * FROM {rows} WHERE description_tokens = '[]')",
                           "row_no", "description", word)},
matched AS (
  SELECT o.row_no, o.posting_id, o.title, f.source_name, f.standard_name
  FROM {rows} o JOIN searched f USING (row_no))"""


def found_sql(name: str, rows: str, key: str, text: str, word: str = WORD) -> str:
    """CTE `name` with `key` and the vocabulary rows whose term stands in the text.

    Word characters are made `w` and all others kept in a copy of the text; an
    occurrence counts if the copy has no `w` on either side of it. The copy has
    the length of the text, so places in one are places in the other. Cutting
    the text at the term leaves out occurrences that overlap the one before;
    they are tried by shifting.
    """
    inside = "[a-z0-9_]" if word == WORD_OR_UNDERSCORE else "[a-z0-9]"
    return f"""{name}_lines AS (
  SELECT {key}, ' ' || lower({text}) || ' ' AS low,
         regexp_replace(' ' || lower({text}) || ' ', '{inside}', 'w', 'g') AS shape FROM {rows}),
{name}_places AS (
  SELECT {key}, source_name, standard_name, low, shape, length(source_name) AS n,
         string_split(low, lower(source_name)) AS pieces
  FROM {name}_lines JOIN vocabulary ON contains(low, lower(source_name))),
{name}_steps AS (
  SELECT {key}, source_name, standard_name, low, shape, n, unnest(range(1, len(pieces))) AS step,
         pieces FROM {name}_places),
{name}_starts AS (
  SELECT {key}, source_name, standard_name, low, shape, n, unnest(range(0, n)) AS shift,
         CAST((step - 1) * n + 1 + list_sum(list_transform(
           list_slice(pieces, 1, step), lambda x: length(x))) AS BIGINT) AS start
  FROM {name}_steps),
{name} AS (
  SELECT DISTINCT {key}, source_name, standard_name FROM {name}_starts
  WHERE shape[start + shift - 1] <> 'w' AND shape[start + shift + n] <> 'w'
    AND (shift = 0 OR substring(low, start + shift, n) = lower(source_name)))"""


RECOVERED_SQL = """filled AS (
  SELECT row_no, list_transform(list_sort(list(DISTINCT source_name)),
         lambda x: concat('''', x, '''')) AS names
  FROM matched GROUP BY row_no),
recovered AS (
  SELECT o.* REPLACE (CASE WHEN len(names) > 0
    THEN concat('[', array_to_string(names, ', '), ']') ELSE description_tokens END
    AS description_tokens)
  FROM {rows} o LEFT JOIN filled USING (row_no))"""

# Stored tokens of the packed lists of a table, with their standard names.
JUNCTION_SQL = """tokens AS (
  SELECT {key}, trim(unnest(string_split(
    trim(nullif(description_tokens, '[]'), '[]'), ', ')), '''') AS source_name
  FROM {rows}),
pairs AS (
  SELECT DISTINCT {key}, standard_name AS skill FROM tokens JOIN vocabulary USING (source_name))"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
