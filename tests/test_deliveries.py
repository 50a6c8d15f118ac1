import os

import pytest
from conftest import rows

from gleanery.operators import audit
from gleanery.sources import deliveries

SCHEMA = "id long, v string, parent string"


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def files(folder):
    return sorted(
        os.path.join(base, f) for base, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    )


def test_deliveries_are_checked_and_committed_once(spark, tmp_path):
    folder = str(tmp_path)
    parents = spark.createDataFrame([("p",)], "name string")
    rules = {"key": ["id"], "required": ["v"], "references": {"parent": (parents, "name")}}
    first = frame(spark, (1, "a", "p"), (2, "b", None))
    assert rows(deliveries.read_deliveries(spark, folder, "t", first.schema)) == []
    assert deliveries.append_checked(first, folder, "t", "one", **rules)
    stored = files(folder)
    assert not deliveries.append_checked(first, folder, "t", "one", **rules)
    for name, bad, error in [
        ("known", frame(spark, (2, "x", "p"), (3, "y", "p")), r"STORED KEY \(id\): 1"),
        ("twice", frame(spark, (3, "x", "p"), (3, "y", "p")), r"PRIMARY KEY \(id\): 1"),
        ("null-key", frame(spark, (None, "x", "p")), r"PRIMARY KEY \(id\): 1"),
        ("missing", frame(spark, (3, None, "p"), (4, None, "p")), r"NOT NULL \(v\): 2"),
        ("lost", frame(spark, (3, "x", "q")), r"FOREIGN KEY \(parent\): 1"),
    ]:
        with pytest.raises(ValueError, match=error):
            deliveries.append_checked(bad, folder, "t", name, **rules)
        assert files(folder) == stored
    assert deliveries.append_checked(frame(spark, (3, "x", "p")), folder, "t", "two", **rules)
    assert deliveries.append_checked(frame(spark), folder, "t", "empty", **rules)
    assert rows(deliveries.read_deliveries(spark, folder, "t", first.schema)) == [
        (1, "a", "p"), (2, "b", None), (3, "x", "p"),
    ]
    with pytest.raises(ValueError, match="name of a delivery"):
        deliveries.append_checked(first, folder, "t", "../x", **rules)


def test_a_run_that_broke_off_is_repeated(spark, tmp_path):
    left = frame(spark, (9, "half", "p"))
    left.write.parquet(str(tmp_path / "t.parquet" / "_staged-one"))
    assert rows(deliveries.read_deliveries(spark, str(tmp_path), "t", left.schema)) == []
    good = frame(spark, (1, "a", "p"))
    assert deliveries.append_checked(good, str(tmp_path), "t", "one", ["id"])
    assert rows(deliveries.read_deliveries(spark, str(tmp_path), "t", good.schema)) == [(1, "a", "p")]


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    folder = str(tmp_path)
    table = spark.range(200).selectExpr("id", "cast(id as string) as v", "'p' as parent")
    table = table.unionByName(frame(spark, (None, "none", None)).select(*table.columns))
    deliveries.save_bucketed(table, folder, "t", "id", 16)
    before = set(files(folder))
    changes = spark.createDataFrame([(5, "new"), (17, None), (999, "no row")], "id long, v string")
    hit = deliveries.update_touched(changes, folder, "t", table.schema, "id", 16)
    assert 1 <= len(hit) <= 3
    after = set(files(folder))
    kept = {f for f in before if not any(f"{deliveries.BUCKET}={n}/" in f for n in hit)}
    assert kept and kept <= after and not (before - kept) & after
    expected = [(n, {5: "new", 17: None}.get(n, str(n)), "p") for n in range(200)] + [(None, "none", None)]
    for _ in range(2):
        assert rows(deliveries.read_bucketed(spark, folder, "t", table.schema)) == sorted(expected, key=repr)
        deliveries.update_touched(changes, folder, "t", table.schema, "id", 16)
    assert deliveries.update_touched(changes.limit(0), folder, "t", table.schema, "id", 16) == []
    with pytest.raises(ValueError, match="PRIMARY KEY"):
        deliveries.update_touched(changes.unionByName(changes), folder, "t", table.schema, "id", 16)


def test_sketches_of_parts_make_that_of_the_whole(spark):
    df = spark.range(60_000).selectExpr("id % 40000 as key", "id % 7 as part")
    parts = audit.key_sketches(df, "key", "part")
    estimate = audit.repeat_estimate(parts).first()
    assert estimate.total_rows == 60_000
    assert abs(estimate.unique_keys - 40_000) <= audit.SKETCH_ERROR * 40_000
    assert estimate.surplus_rows == 60_000 - estimate.unique_keys
    stored = audit.united_sketch(parts.filter("part < 3")).selectExpr("total_rows as rows", "sketch")
    later = stored.unionByName(parts.filter("part >= 3").select("rows", "sketch"))
    assert audit.repeat_estimate(later).first() == estimate
