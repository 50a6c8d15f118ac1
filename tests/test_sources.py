import random

import pytest
from conftest import rows

from gleanery.sources import csv_blocks, csv_text, tables

COLUMNS = ("id", "a", "b")


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("block", ["40", "128m"])
def test_csv_fields(spark, tmp_path, end, block):
    path = write(
        tmp_path / "f.csv",
        end.join(
            ['\ufeffother,"names ""here""\n",x', '1,"say ""hi"", then\nleave",z', "", '2,,""',
             '3,é,"a\r\nb"', '4,"\r","\n\r\r\n"', '"5",",",""""']
        ),
    )
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = rows(csv_text.read_text_csv(spark, path, COLUMNS))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [
        ("1", 'say "hi", then\nleave', "z"),
        ("2", None, ""),
        ("3", "é", "a\r\nb"),
        ("4", "\r", "\n\r\r\n"),
        ("5", ",", '"'),
    ]


def test_ragged_records_fail(spark, tmp_path):
    path = write(tmp_path / "f.csv", "id,a,b\n1,x,y\n2,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        csv_text.read_text_csv(spark, path, COLUMNS).collect()
    filled = csv_text.read_text_csv(spark, path, COLUMNS, mode="PERMISSIVE")
    assert rows(filled) == [("1", "x", "y"), ("2", "x", None)]


@pytest.mark.parametrize("mode", ["FAILFAST", "PERMISSIVE"])
@pytest.mark.parametrize(
    ("text", "error"),
    [
        ('1,"x,y\n2,x,z\n', "never ends"),
        ('1,5" pipe,y\n2,x,z\n', "never ends"),
        ('1,5" pipe,y\n2,6" pipe,z\n', "inside an unquoted field"),
        ('1,5" by 6",y\n', "inside an unquoted field"),
        ('1,"x"y,z\n', "inside an unquoted field"),
    ],
)
def test_quotes_out_of_place_fail_in_any_mode(spark, tmp_path, text, error, mode):
    path = write(tmp_path / "f.csv", "id,a,b\n" + text)
    with pytest.raises(Exception, match=error):
        csv_text.read_text_csv(spark, path, COLUMNS, mode=mode).collect()


def test_files_without_line_breaks_are_split(spark, tmp_path):
    path = write(tmp_path / "f.csv", "id,a,b\n" + "".join(f"{i},x,y\n" for i in range(2000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = csv_text.read_text_csv(spark, path, COLUMNS, line_breaks_in_fields=False)
        assert df.rdd.getNumPartitions() > 1
        assert df.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.fixture
def parts_of(spark):
    name = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, old)


def test_a_record_over_the_limit_fails_by_name(spark, tmp_path, parts_of):
    text = "id,a,b\n1,x,y\n" + '2,"' + "word\n" * 100 + '",z\n3,x,y\n'
    path = write(tmp_path / "long.csv", text)
    for size in ("128m", 300):
        parts_of(size)
        with pytest.raises(Exception, match="more than 400 bytes in .*long.csv"):
            csv_text.read_text_csv(spark, path, COLUMNS, longest_record=400).count()
        assert csv_text.read_text_csv(spark, path, COLUMNS, longest_record=600).count() == 3


def test_a_header_over_many_blocks(spark, tmp_path, parts_of):
    path = write(tmp_path / "f.csv", 'id,"' + "a\n" * 200 + '",b\n1,"p\nq",r\n')
    for size in (100, 500):
        parts_of(size)
        assert rows(csv_text.read_text_csv(spark, path, COLUMNS)) == [("1", "p\nq", "r")]


def test_stray_quotes_far_apart(spark, tmp_path, parts_of):
    lines = [f"{i},x,y" for i in range(500)]
    lines[3], lines[400] = '3,5" pipe,y', '400,6" pipe,y'
    path = write(tmp_path / "f.csv", "id,a,b\n" + "\n".join(lines))
    for size in (200, 1000, "128m"):
        parts_of(size)
        with pytest.raises(ValueError, match="inside an unquoted field in .*f.csv"):
            csv_text.read_text_csv(spark, path, COLUMNS)


def test_blocks_cut_anew_are_refused(spark, tmp_path, parts_of):
    path = write(tmp_path / "f.csv", "id,a,b\n" + "".join(f"{i},x,y\n" for i in range(900)))
    parts_of(2000)
    df = csv_text.read_text_csv(spark, path, COLUMNS)
    assert df.count() == 900
    again = csv_text.read_text_csv(spark, path, COLUMNS)
    parts_of(700)
    with pytest.raises(Exception, match="changed since they were counted"):
        again.select("id").collect()


def test_lines_stay_where_they_are(spark, tmp_path):
    path = write(tmp_path / "f.csv", 'id,a,b\n1,"x\ny",z\n')
    plan = csv_text.read_text_csv(spark, path, COLUMNS)._jdf.queryExecution().toString()
    assert "value" in plan and "Sort [value" not in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "value" in line]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_blocks_beyond_the_broadcast(spark, tmp_path, parts_of, broadcast_bytes):
    want = sorted(f'{i},"a\n{"w" * (i % 90)}",b' for i in range(800))
    path = write(tmp_path / "f.csv", "id,a,b\n" + "\n".join(want))
    parts_of(1500)
    got = csv_blocks.records(spark, path, broadcast_bytes=broadcast_bytes)
    assert sorted(r.record for r in got.collect()) == want


def test_odd_files(spark, tmp_path):
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "header.csv", "id,a,b")
    write(tmp_path / "blank.csv", "\n\n1,x,y\n\n\n")
    assert rows(csv_text.read_text_csv(spark, str(tmp_path), COLUMNS)) == [("1", "x", "y")]


def test_records_across_many_blocks(spark, tmp_path):
    made = random.Random(7)

    def field():
        if made.random() < 0.1:
            return None
        return "".join(made.choice('ab ,"\n\r\n\\é;') for _ in range(made.randint(0, 60)))

    want = [(f"id{i}", field(), field()) for i in range(1500)]

    def coded(value):
        return "" if value is None else '"' + value.replace('"', '""') + '"'

    for n in range(2):
        lines = [",".join(map(coded, row)) for row in want[n::2]]
        write(tmp_path / f"f{n}.csv", "id,a,b\n" + "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = csv_text.read_text_csv(spark, str(tmp_path), COLUMNS)
        assert rows(got) == sorted(want, key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_written_csv_is_read_back(spark, tmp_path):
    df = spark.createDataFrame(
        [("1", ' x ,"\n', None), ("2", "", "é\\n"), ("3", "\\", '"'), ("4", "a\rb", "\r\n")],
        "id string, a string, b string",
    )
    csv_text.write_text_csv(df, str(tmp_path / "out"))
    assert rows(csv_text.read_text_csv(spark, str(tmp_path / "out"), COLUMNS)) == rows(df)


def test_feed_schema_is_all_text():
    schema = csv_text.text_schema(csv_text.OBSERVATION_COLUMNS)
    assert len(schema) == 27
    assert {f.dataType.simpleString() for f in schema} == {"string"}


def test_tables_are_saved_and_appended(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    saved = tables.save_table(df, str(tmp_path), "t")
    assert rows(saved) == [(1, "a")]
    tables.append_rows(df, str(tmp_path), "t")
    assert tables.read_table(spark, str(tmp_path), "t").count() == 2


def test_schema_report(spark):
    df = spark.createDataFrame([(1, ""), (None, "x")], "`Unnamed: 0` int, v string")
    assert [tuple(r) for r in tables.schema_report(df).collect()] == [
        (1, "Unnamed: 0", "int", 1, 1),
        (2, "v", "string", 1, 1),
    ]


def test_sample_rows(spark):
    df = spark.range(100)
    assert tables.sample_rows(df).count() == 10
    assert [r.id for r in tables.sample_rows(df, 2, ["id"]).collect()] == [0, 1]


def test_spread_deals_out_small_tables_only(spark):
    assert tables.spread(spark.range(100).coalesce(1)).rdd.getNumPartitions() == 8
    assert tables.spread(spark.range(100, numPartitions=20)).rdd.getNumPartitions() == 20


def test_unknown_counts_as_greatest_in_order(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (2, "c")], "n int, v string")
    up = [tuple(r) for r in tables.in_order(df, "n", "v").collect()]
    assert up == [(1, "a"), (2, "c"), (2, None), (None, "b")]
    down = [tuple(r) for r in tables.in_order(df, "-n", "-v").collect()]
    assert down == [(None, "b"), (2, None), (2, "c"), (1, "a")]


def test_created_table_keeps_its_types(spark, tmp_path):
    made = tables.create_table(spark, str(tmp_path), "t", "id bigint, v string")
    assert made.count() == 0
    assert tables.read_table(spark, str(tmp_path), "t").dtypes == [("id", "bigint"), ("v", "string")]


def test_split_feed_has_more_files_for_larger_tables(spark, tmp_path, monkeypatch):
    from gleanery.catalog import queries

    documents = [(n, f"text, {n}\n", "en", "src1", 8) for n in range(60)]
    df = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string, n_chars long")
    files = []

    def counting(rows, path):
        files.append(rows.rdd.getNumPartitions())
        write(rows, path)

    write = queries.write_text_csv
    monkeypatch.setattr(queries, "write_text_csv", counting)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        for parts in (1, 12):
            df.repartition(parts).write.parquet(f"{tmp_path}/{parts}/documents.parquet")
            found = queries.csv_text_load_split(spark, f"{tmp_path}/{parts}").collect()
            assert sorted((int(r.doc_id), r.text) for r in found) == [d[:2] for d in documents]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert files[0] >= 4 and files[1] >= 12
