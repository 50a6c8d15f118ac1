"""CSV files loaded as text only, so that no odd value can fail the load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gleanery.sources.csv_blocks import LONGEST_RECORD, records

# The columns of the observation feed, in file order.
OBSERVATION_COLUMNS = (
    "Unnamed: 0",
    "index_col",
    "title",
    "company_name",
    "location",
    "via",
    "description",
    "extensions",
    "job_id",
    "thumbnail",
    "posted_at",
    "schedule_type",
    "work_from_home",
    "salary",
    "search_term",
    "date_time",
    "search_location",
    "commute_time",
    "salary_pay",
    "salary_rate",
    "salary_avg",
    "salary_min",
    "salary_max",
    "salary_hourly",
    "salary_yearly",
    "salary_standardized",
    "description_tokens",
)

# Text no file holds, so that an empty field reads as NULL and "" as empty text.
UNUSED_NULL_TEXT = "\x01"


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def read_text_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = OBSERVATION_COLUMNS,
    line_breaks_in_fields: bool = True,
    mode: str = "FAILFAST",
    longest_record: int = LONGEST_RECORD,
) -> DataFrame:
    """Comma-separated UTF-8 files with a header; columns go by position.

    Doubled quotes stand for a quote, an empty field is NULL, "" is empty text,
    blank lines are no records. Lines end at `\\n`, `\\r\\n` or `\\r`; within
    quotes these stay as they are. A record with too few or too many fields
    fails the job; `mode="PERMISSIVE"` fills or cuts it instead. A quoted field
    that never ends, a quote inside an unquoted field and a record of more than
    `longest_record` bytes fail in any mode, by the name of the file.

    All tasks work on all files, however large (`csv_blocks`), and the size
    of the files changes nothing. Pass `line_breaks_in_fields=False` where no
    field has any: such files are read in one pass, a line a record, and a
    quote inside an unquoted field stands for itself.
    """
    options = {
        "quote": '"',
        "escape": '"',
        "nullValue": UNUSED_NULL_TEXT,
        "multiLine": str(line_breaks_in_fields).lower(),
        "mode": mode,
    }
    if line_breaks_in_fields:
        ddl = ", ".join(f"`{c}` string" for c in columns)
        parsed = F.from_csv("record", ddl, options)
        return records(spark, path, longest_record).select(parsed.alias("r")).select(
            *[F.col("r").getField(c).alias(c) for c in columns]
        )
    return spark.read.options(**options).csv(
        path, schema=text_schema(columns), header=True, enforceSchema=True, encoding="UTF-8"
    )


def write_text_csv(df: DataFrame, path: str) -> None:
    """Files that `read_text_csv` reads back to the same text."""
    df.write.csv(
        path,
        header=True,
        escape='"',
        emptyValue='""',
        nullValue="",
        encoding="UTF-8",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
