import random

import pytest
from pyspark.sql import functions as F

from gleanery.llm import revisit

SCHEMA = (
    "record_id long, kind string, url string, time long, etag string, last_modified string, "
    "headers map<string,string>, digest string, entry int"
)


@pytest.mark.parametrize(
    ("url", "page"),
    [
        ("http://www.A.com:80/x/?b=2&a=1&utm_source=q#f", "a.com/x?a=1&b=2"),
        ("https://a.com/x?a=1&b=2", "a.com/x?a=1&b=2"),
        ("HTTPS://user:pw@m.a.com/X", "a.com/X"),
        ("http://h", "h"), ("http://h/", "h"), ("http://h?ref=1", "h"), ("ftp://z/#q", "ftp://z/"),
        (" http://h/a ", "h/a"), ("", ""), (None, None),
    ],
)
def test_canonical_url(spark, url, page):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(revisit.canonical_url("u")).first()[0] == page


def row(record, kind, url, time, etag=None, modified=None, headers=None, digest=None):
    return (record, kind, url, time, etag, modified, headers, digest, 0)


def run(spark, rows):
    found = revisit.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r.record_id: r for r in found}


def test_outcomes_and_headers(spark):
    u = "http://a.com/x"
    found = run(spark, [
        row(1, "response", u, 10, '"t1"', "m1", {"ETag": "t1", "Content-Type": "html", "DATE": "d1"}, "dg1"),
        row(2, "response", "https://A.com/x/", 20, None, "m2", {"date": "d2"}, "dg2"),
        row(3, "revisit", u, 10, '"t1"'),
        row(4, "revisit", u, 11, 'W/"t1"', "other", {"Date": "d4", "Content-Type": "gone", "Expires": "e"}),
        row(5, "revisit", u, 20, '"t2"'),
        row(6, "revisit", u + "#z", 21, '"t1"', "m2"),
        row(7, "revisit", u, 22, None, "m1"),
        row(8, "revisit", u, 23),
        row(9, "revisit", None, 23), row(10, "revisit", u, None), row(11, "other", u, 30),
        row(12, "response", u, None, None, None, None, "never"),
    ])
    assert {k: (r.response, r.outcome, r.digest) for k, r in found.items()} == {
        3: (None, "missing", None), 4: (1, "resolved", "dg1"), 5: (1, "changed", None),
        6: (2, "resolved", "dg2"), 7: (2, "changed", None), 8: (2, "unchecked", "dg2"),
        9: (None, "missing", None), 10: (None, "missing", None),
    }
    assert found[4].headers == {"etag": "t1", "content-type": "html", "date": "d4", "expires": "e"}
    assert found[8].headers == {"date": "d2"} and found[5].headers is None


def test_as_of_join_with_a_hot_page(spark):
    rng = random.Random(8)
    rows = []
    for n in range(1500):
        url = "http://hot.com/" if rng.random() < 0.6 else f"http://h.com/{rng.randrange(40)}"
        kind = "response" if rng.random() < 0.05 else "revisit"
        rows.append(row(n, kind, url, rng.randrange(400), digest=str(n)))
    found = run(spark, rows)
    for record, kind, url, time, *_ in rows:
        if kind == "revisit":
            earlier = [(r[3], r[0]) for r in rows if r[1] == "response" and r[2] == url and r[3] < time]
            assert found[record].response == (max(earlier)[1] if earlier else None)


def test_repeated_records_and_empty_table(spark):
    rows = [row(1, "response", "http://a/", 1), row(2, "revisit", "http://a/", 2)] * 2
    found = revisit.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.record_id, r.response) for r in found] == [(2, 1), (2, 1)]
    assert revisit.resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pages_resolve_to_themselves(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = revisit.resolve_revisits(revisit.capture_records(pages))
    assert found.count() == pages.count()
    late = found.filter(F.pmod((F.col("record_id") - 1) / 2, F.lit(13)) != 0)
    assert late.filter("outcome = 'missing'").count() == 0
