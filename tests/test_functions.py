import pytest
from conftest import rows
from pyspark.sql import functions as F

from gleanery.functions import packed, text, typing


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        (None, "NULL"),
        ("", "Empty string"),
        ("  ", "Whitespace only"),
        (" a", "Leading/trailing whitespace"),
        ("a b", "No formatting issue"),
        ("a\t", "No formatting issue"),
    ],
)
def test_format_class(spark, value, expected):
    assert one(spark, value, text.format_class("v")) == expected


def test_trim_takes_spaces_only_unless_asked(spark):
    assert one(spark, " \ta  ", text.trim_spaces("v")) == "\ta "
    assert one(spark, " \ta  ", text.trim_blanks("v")) == "a"
    assert one(spark, None, text.trim_spaces("v")) is None


def test_differs_is_unknown_for_null(spark):
    assert one(spark, None, text.differs("v", text.trim_spaces("v"))) is None
    assert one(spark, " a", text.differs("v", text.trim_spaces("v"))) is True


def test_last_characters(spark):
    assert one(spark, "abcdefghijkl", text.last_characters("v", 10)) == "cdefghijkl"
    assert one(spark, "abc", text.last_characters("v", 10)) == "abc"


def test_boundary_pattern_takes_the_term_literally(spark):
    term = r"A.b\c+(x)[y]{z}^$|?*"
    pattern = one(spark, term, text.boundary_pattern("v"))
    df = spark.createDataFrame([(term.lower(), pattern), ("a" + term.lower(), pattern)], "t string, p string")
    assert [r[0] for r in df.select(F.rlike("t", "p")).collect()] == [True, False]


def test_contains_ignoring_case_keeps_wildcards(spark):
    assert one(spark, "ASP.NET core", text.contains_ignoring_case("v", "net")) is True
    assert one(spark, "a1b", text.contains_ignoring_case("v", "A_B")) is True
    assert one(spark, "ab", text.contains_ignoring_case("v", "a_b")) is False


LISTS = [
    ("['sql', 'r']", ["r", "sql"], ["r", "sql"]),
    ("['sql','r']", ["r", "sql"], ["sql','r"]),
    ("['js', 'javascript']", ["javascript", "js"], ["javascript", "js"]),
    ("[\"it's\"]", ['"its"'], ["\"it's\""]),
    ("['SQL']", ["SQL"], ["SQL"]),
]


@pytest.mark.parametrize("value, inspected, stored", LISTS)
def test_both_ways_to_split_a_list(spark, value, inspected, stored):
    assert sorted(one(spark, value, packed.inspect_tokens("v"))) == inspected
    assert sorted(one(spark, value, packed.list_tokens(packed.unwrap("v")))) == stored


def test_unwrap(spark):
    assert one(spark, "[]", packed.unwrap("v")) is None
    assert one(spark, None, packed.unwrap("v")) is None
    assert one(spark, "", packed.unwrap("v")) == ""
    assert one(spark, "", packed.list_tokens(packed.unwrap("v"))) == []


def test_pack_is_read_back(spark):
    df = spark.createDataFrame([(["a", "b c"],), ([],)], "v array<string>")
    assert rows(df.select(packed.pack("v"))) == [("['a', 'b c']",), ("[]",)]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("True", True), (" yes ", True), ("on", True), ("1", True), ("tru", True), ("T", True),
        ("off", False), ("of", False), ("N", False), ("0", False), ("fal", False),
        ("o", None), ("", None), ("2", None), (None, None),
    ],
)
def test_boolean_texts(spark, value, expected):
    assert one(spark, value, typing.to_boolean("v")) is expected


@pytest.mark.parametrize(
    "value, kind, expected",
    [
        ("7", "int", "7"), (" 7 ", "int", "7"), ("1.0", "int", None), ("", "int", None),
        ("12.5", "numeric", "12.5000000000"), ("x", "numeric", None),
        ("2023-1-2", "timestamp", "2023-01-02 00:00:00"),
        ("2023-01-02 03:04:05.6", "timestamp", "2023-01-02 03:04:05.6"),
        ("yesterday noon", "timestamp", None),
    ],
)
def test_read_as(spark, value, kind, expected):
    assert one(spark, value, typing.read_as("v", kind).cast("string")) == expected
