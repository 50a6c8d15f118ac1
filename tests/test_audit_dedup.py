import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from gleanery.functions.text import trim_spaces
from gleanery.operators import audit, clean, dedup, typing


def test_repeat_baseline_counts_surplus_rows(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(audit.repeat_baseline(df, "k")) == [(3, 2, 2)]


def test_missing(spark):
    df = spark.createDataFrame([("a", None), ("", "x"), ("b", "y")], "k string, t string")
    assert rows(audit.missing_rows(df, ["k", "t"])) == [("", "x"), ("a", None)]
    assert rows(audit.missing_counts(df, ["k", "t"])) == [(1, 1)]


def test_exact_duplicates(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (2, "a", None), (3, None, "a"), (4, "a", ""), (5, "b", "c"), (6, "b", "c"), (7, "b", "c")],
        "id int, x string, y string",
    )
    assert rows(audit.exact_duplicates(df)) == [(0, 0)]
    assert rows(audit.exact_duplicates(df, exclude=["id"])) == [(2, 3)]
    zeros = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert rows(audit.exact_duplicates(zeros)) == [(1, 1)]


def test_frequency_and_span(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("b", 2), (None, 5)], "k string, t int")
    assert rows(audit.value_frequency(df, "k", "k")) == [("a", 2), ("b", 1), (None, 1)]
    assert rows(audit.value_frequency(df, "k", "k", min_rows=2)) == [("a", 2)]
    assert rows(audit.repeat_span(df, "k", "t")) == [("a", 2, 1, 3)]


def test_case_variants(spark):
    names = ["Acme", "ACME", "acme", "Acme", "Beta", None, None]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    assert rows(audit.case_variants(df, "v")) == [("acme", 3)]
    assert rows(audit.case_variant_list(df, "v")) == [("acme", "ACME | Acme | acme")]
    assert rows(audit.case_variants(clean.case_folded(df, "v"), "v")) == []


def test_list_counts(spark):
    df = spark.createDataFrame(
        [("[]", "x"), ("['a']", ""), (None, None), ("[]", None), ("[]", "")], "p string, t string"
    )
    assert rows(audit.list_counts(df, "p", "[]")) == [(5, 1, 3)]
    assert rows(audit.empty_list_text_counts(df, "p", "t", "[]")) == [(1, 2)]


def test_residual_rows(spark):
    df = spark.createDataFrame([(" a",), ("b",), (None,)], "v string")
    before = audit.residual_rows(df, left=("v", trim_spaces("v")))
    after = audit.residual_rows(clean.trimmed(df, "v"), left=("v", trim_spaces("v")))
    assert (rows(before), rows(after)) == ([(1,)], [(0,)])


def test_duplicate_pairs_group_by_the_whole_key(spark):
    df = spark.createDataFrame(
        [("a-0123456789", "x"), ("b-0123456789", "x"), ("c", "y"), ("c", "y")], "k string, v string"
    )
    assert rows(audit.duplicate_pairs(df, "k", "v")) == [("c", "y", 2)]


OBSERVED = [
    ("k1", "2023-01-02", 1),
    ("k1", "2023-01-10", 2),
    ("k2", "2023-1-2", 3),
    ("k2", "2023-01-10", 4),
    ("k3", "2023-05-05", 5),
    ("k3", "2023-05-05", 6),
    ("k4", "2023-05-05", 7),
    ("k5", None, 8),
    ("k5", "2023-05-05", 9),
    (None, "2023-05-05", 10),
    (None, "2023-05-06", 11),
]


def observed(spark):
    return spark.createDataFrame(OBSERVED, "k string, t string, id int")


def test_latest_is_by_time_not_by_text(spark):
    typed = typing.typed(observed(spark), {"t": "timestamp"})
    kept = dedup.keep_latest(typed, ["k"], "t", ["id"])
    assert rows(kept, "id") == [(11,), (2,), (4,), (6,), (7,), (8,)]
    by_text = dedup.keep_latest(observed(spark), ["k"], "t", ["id"])
    assert (3,) in rows(by_text, "id")


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_wide_rows_keep_the_same(spark, broadcast_bytes):
    typed = typing.typed(observed(spark), {"t": "timestamp"})
    wide = dedup.keep_latest_wide(typed, ["k"], "t", ["id"], "id", broadcast_bytes)
    assert rows(wide) == rows(dedup.keep_latest(typed, ["k"], "t", ["id"]))


def test_wide_rows_need_an_identity(spark):
    twice = observed(spark).unionByName(observed(spark))
    with pytest.raises(ValueError, match="does not identify"):
        dedup.keep_latest_wide(twice, ["k"], "t", ["id"], "id")


def test_undecided_keys(spark):
    typed = typing.typed(observed(spark), {"t": "timestamp"})
    open_keys = dedup.undecided_keys(typed, ["k"], "t", [])
    assert rows(open_keys, "k", "rows") == [("k3", 2)]
    assert rows(dedup.undecided_keys(typed, ["k"], "t", ["id"])) == []


def test_keeping_the_latest_settles(spark):
    df = spark.range(5000).select(
        (F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 101).alias("t"), "id"
    )
    once = dedup.keep_latest(df, ["k"], "t", ["id"])
    assert once.count() == 7
    assert rows(dedup.keep_latest(once, ["k"], "t", ["id"])) == rows(once)
    assert rows(dedup.keep_latest(df.repartition(13, "t"), ["k"], "t", ["id"])) == rows(once)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("t"))
    plan = dedup.keep_latest(df, ["k"], "t", [])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_strict_typing_fails_on_a_misfit(spark):
    df = spark.createDataFrame([("7", "True"), ("1.0", "on")], "n string, b string")
    with pytest.raises(Exception, match="n is not int: 1.0"):
        typing.typed(df, {"n": "int", "b": "boolean"}).collect()


def test_lenient_typing_reports_misfits(spark):
    df = spark.createDataFrame([("7", "True"), ("1.0", "maybe"), (None, "on")], "n string, b string")
    kinds = {"n": "int", "b": "boolean"}
    assert rows(typing.typed_or_null(df, kinds)) == [
        (7, True, []), (None, None, ["n", "b"]), (None, True, []),
    ]
    assert rows(typing.quarantine(df, kinds)) == [("1.0", "maybe", ["n", "b"])]


def test_typed_times_have_no_zone(spark):
    df = spark.createDataFrame([("2023-01-02 03:04:05",)], "t string")
    assert typing.typed(df, {"t": "timestamp"}).first().t == dt.datetime(2023, 1, 2, 3, 4, 5)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_update_leaves_other_rows(spark, broadcast_bytes):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4)], "k string, v int")
    new = spark.createDataFrame([("a", 10), ("b", None), ("z", 30)], "k string, v int")
    got = clean.updated_from(df, new, "k", ["v"], broadcast_bytes)
    assert rows(got) == [("a", 10), ("b", None), ("c", 3), (None, 4)]


def test_duplicates_are_exact_in_every_type(spark):
    """Pairs of unlike values, and pairs of equal ones, of types whose short form would lose something."""
    def groups(first, second):
        df = spark.sql(f"SELECT {first} AS v UNION ALL SELECT {second}")
        return audit.exact_duplicates(df).first().duplicate_groups

    unlike = [
        ("TIMESTAMP'2024-01-01 00:00:00.000001'", "TIMESTAMP'2024-01-01 00:00:00.000002'"),
        ("TIMESTAMP_NTZ'2024-01-01 00:00:00.000001'", "TIMESTAMP_NTZ'2024-01-01 00:00:00.000002'"),
        ("1.0000000000000002D", "1.0D"), ("X'00'", "X'0000'"), ("NULL", "''"), ("'a'", "'A'"),
        ("array(TIMESTAMP'2024-01-01 00:00:00.000001')", "array(TIMESTAMP'2024-01-01 00:00:00.000002')"),
        ("named_struct('a', 1.5D)", "named_struct('a', 1.25D)"), ("map('a', 1)", "map('a', 2)"),
        ("array('a,b')", "array('a', 'b')"), ("CAST(1.10 AS DECIMAL(10,2))", "CAST(1.11 AS DECIMAL(10,2))"),
        ("array(NULL, 'a')", "array('a', NULL)"),
    ]
    alike = [
        ("0.0D", "-0.0D"), ("array(0.0D)", "array(-0.0D)"), ("CAST('NaN' AS DOUBLE)", "CAST('NaN' AS DOUBLE)"),
        ("map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)"), ("CAST(NULL AS STRING)", "NULL"),
    ]
    assert [groups(*pair) for pair in unlike] == [0] * len(unlike)
    assert [groups(*pair) for pair in alike] == [1] * len(alike)


def test_numbers_that_would_lose_digits_do_not_fit(spark):
    texts = ["1.1234567890", "1.12345678901", "1.12345678900", "1e-10", "1e-11", "100e-12", "12.5e-9", "12.5e-10",
             "-0.00000000001", "7", "1e3", " 1.5 ", "0.0", "NaN", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = {r.t: r.v for r in typing.typed_or_null(df.withColumn("t", F.col("v")), {"v": "numeric"}).collect()}
    assert [t for t in texts if got[t] is None] == ["1.12345678901", "1e-11", "12.5e-10", "-0.00000000001", "NaN", "x"]
    with pytest.raises(Exception, match="v is not numeric: 1.123456789012"):
        typing.typed(spark.createDataFrame([("1.123456789012",)], "v string"), {"v": "numeric"}).collect()
    short = typing.typed_or_null(spark.createDataFrame([("1.25",), ("1.2",)], "v string"), {"v": "decimal(10,1)"})
    assert [r.cast_errors for r in short.collect()] == [["v"], []]


def test_updates_with_repeated_keys_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    with pytest.raises(ValueError, match="several updates for the same k: 1"):
        clean.updated_from(df, spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), "k", ["v"])
    updates = spark.createDataFrame([(1, "x"), (None, "y"), (None, "z")], "k int, v string")
    got = clean.updated_from(df, updates, "k", ["v"]).collect()
    assert sorted(r.v for r in got) == ["b", "c", "x"]
