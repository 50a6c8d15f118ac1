"""The whole way from raw text observations to a checked model of three tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.operators import checks, clean, dedup, model, recovery, typing
from gleanery.operators.vocabulary import checked_vocabulary, unmapped_tokens
from gleanery.scale import scratch_removed
from gleanery.sources.tables import read_table, save_table


# Column that numbers the landed observations.
ROW = "_row"

TABLES = ("observations", "records", "companies", "jobs", "job_skills")


@dataclass(frozen=True)
class Feed:
    """Which column of a feed plays which part."""

    key: str
    newest: str
    tie_break: Sequence[str]
    name: str
    text: str
    packed: str
    kinds: Mapping[str, str]
    fact_columns: Sequence[str]
    trim: Sequence[str] = ()
    name_id: str = "company_id"
    junction_id: str = "job_skill_id"
    term: str = "skill"


# The feed of job postings, as `sources.csv_text` reads it.
JOB_POSTINGS = Feed(
    key="job_id",
    newest="date_time",
    tie_break=("index_col",),
    name="company_name",
    text="description",
    packed="description_tokens",
    kinds={
        "index_col": "int",
        "work_from_home": "boolean",
        "date_time": "timestamp",
        "salary_avg": "numeric",
        "salary_min": "numeric",
        "salary_max": "numeric",
        "salary_hourly": "numeric",
        "salary_yearly": "numeric",
        "salary_standardized": "numeric",
    },
    trim=("location",),
    fact_columns=(
        "job_id",
        "title",
        "company_id",
        "location",
        "date_time",
        "schedule_type",
        "work_from_home",
        "salary",
        "salary_pay",
        "salary_rate",
        "salary_avg",
        "salary_min",
        "salary_max",
        "salary_hourly",
        "salary_yearly",
        "salary_standardized",
        "description",
        "via",
    ),
)


@dataclass(frozen=True)
class Model:
    """The tables of a finished run; each is read from its files."""

    records: DataFrame
    companies: DataFrame
    jobs: DataFrame
    job_skills: DataFrame
    unmapped: DataFrame
    unmatched: DataFrame
    constraints: DataFrame = field(repr=False)


def landed(raw: DataFrame, folder: str) -> DataFrame:
    """The observations as they came, in Parquet, each with a number of its own."""
    return save_table(raw.withColumn(ROW, F.monotonically_increasing_id()), folder, "observations")


def cleaned_records(observations: DataFrame, feed: Feed) -> DataFrame:
    """One row per key, typed, trimmed and case-folded.

    The columns that decide which row is the latest get their types first, so
    that times are compared and not their texts; the others only have to fit
    in the rows that are kept.
    """
    first = (feed.key, feed.newest, *feed.tie_break)
    deciding = {c: kind for c, kind in feed.kinds.items() if c in first}
    others = {c: kind for c, kind in feed.kinds.items() if c not in first}
    latest = dedup.keep_latest_wide(
        typing.typed(observations, deciding),
        [feed.key],
        feed.newest,
        feed.tie_break,
        ROW,
        check=False,
    )
    rows = clean.trimmed(typing.typed(latest.drop(ROW), others), *feed.trim)
    return clean.case_folded(rows, feed.name)


def curate(
    raw: DataFrame, vocab: DataFrame, feed: Feed, folder: str, strict: bool = True
) -> Model:
    """Runs all stages, each written to `folder` and read back by the next.

    With `strict` the run fails if the tables break a constraint of the model;
    without, the report is there to be looked at. A run that fails can start
    again: every table is overwritten whole.
    """
    with scratch_removed(raw.sparkSession):
        return _curated(raw, checked_vocabulary(vocab), feed, folder, strict)


def _curated(
    raw: DataFrame, vocab: DataFrame, feed: Feed, folder: str, strict: bool
) -> Model:
    cleaned = cleaned_records(landed(raw, folder), feed)
    records = save_table(
        recovery.recover(cleaned, feed.text, feed.packed, vocab, feed.key), folder, "records"
    )
    companies = save_table(
        model.extract_dimension(records, feed.name, feed.name_id), folder, "companies"
    )
    linked = model.attach_dimension(records, companies, feed.name, [feed.key])
    jobs = save_table(model.fact_table(linked, feed.name_id, feed.fact_columns), folder, "jobs")
    job_skills = save_table(
        model.junction_table(records, feed.key, feed.packed, vocab, feed.junction_id, feed.term),
        folder,
        "job_skills",
    )
    constraints = save_table(
        model_constraints(jobs, companies, job_skills, feed), folder, "constraints"
    )
    if strict:
        checks.require(constraints)
    unmapped = unmapped_tokens(records, feed.key, feed.packed, vocab)
    return Model(
        records=records,
        companies=companies,
        jobs=jobs,
        job_skills=job_skills,
        unmapped=save_table(unmapped, folder, "unmapped_tokens"),
        unmatched=save_table(model.left_out(records, jobs), folder, "unmatched_rows"),
        constraints=constraints,
    )


def model_constraints(
    jobs: DataFrame, companies: DataFrame, job_skills: DataFrame, feed: Feed
) -> DataFrame:
    return checks.report(
        checks.primary_key(companies, "companies", [feed.name_id]),
        checks.unique(companies, "companies", [feed.name]),
        checks.primary_key(jobs, "jobs", [feed.key]),
        checks.foreign_key(jobs, companies, "jobs", feed.name_id, feed.name_id),
        checks.primary_key(job_skills, "job_skills", [feed.junction_id]),
        checks.not_nulls(job_skills, "job_skills", [[feed.key], [feed.term]]),
        checks.unique(job_skills, "job_skills", [feed.key, feed.term]),
        checks.foreign_key(job_skills, jobs, "job_skills", feed.key, feed.key),
    )


def load_model(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tables of an earlier run."""
    return {name: read_table(spark, folder, name) for name in TABLES}
