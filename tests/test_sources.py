import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidemark.sources import readers, sinks


def test_csv_folder(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,x\n3,c\n4,\"two\nlines, \"\"quoted\"\"\"\n")
    (tmp_path / "a.csv").write_text("id,x\n1,a\n2,NULL\n")
    (tmp_path / "c.csv").write_text("id,y\n5,z\n")
    for name in ("dim_x.csv", "x_clean.csv", "fct_.csv"):
        (tmp_path / name).write_text("id,x\n99,z\n")
    df = readers.read_csv_folder(spark, str(tmp_path), ordered=True)
    got = [(r.id, r.x, r.y) for r in df.orderBy(*readers.ORDER).collect()]
    assert got == [("1", "a", None), ("2", "NULL", None), ("3", "c", None), ("4", 'two\nlines, "quoted"', None),
                   ("5", None, "z")]
    nulls = readers.read_csv_folder(spark, str(tmp_path), null_value="NULL")
    assert nulls.filter("id = '2'").first().x is None
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        readers.read_csv_folder(spark, str(empty))


def test_keyed_json(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"A": {"n": 1, "s": "x"}, "B": {"n": None, "s": None}}, indent=2))
    df = readers.read_keyed_json(spark, str(path), "name", "n LONG, s STRING")
    assert values(df) == [("A", 1, "x"), ("B", None, None)]


def test_keyed_json_of_many_lines(spark, tmp_path):
    for name, text in (("a", '{"A": {"n": 1}, "B": {"n": 2}}\n{"C": {"n": 3}}\n'), ("b", '{"D": null}\n')):
        (tmp_path / name).write_text(text)
    df = readers.read_keyed_json(spark, str(tmp_path), "name", "n LONG", lines=True)
    assert values(df) == [("A", 1), ("B", 2), ("C", 3), ("D", None)]


def test_folders_of_csv_files(spark, tmp_path):
    """Tables that Spark wrote are folders; outputs are known by the names of these, also where
    the folder that holds them all has such a name."""
    root = f"{tmp_path}/view_raw"
    df = spark.createDataFrame([(" a ", "\tx"), ("b", "two\n lines ")], "id STRING, x STRING")
    sinks.write_table(df, f"{root}/one", "csv")
    sinks.write_table(df.select("x", "id"), f"{root}/two words", "csv")
    for name in ("fct_one", "one_clean.csv"):
        sinks.write_table(df.withColumn("x", F.lit("output")), f"{root}/{name}", "csv")
    got = readers.read_csv_folder(spark, f"{root}/*")
    assert values(got, "id", "x") == sorted([(" a ", "\tx"), ("b", "two\n lines ")] * 2)
    assert values(readers.read_csv_folder(spark, f"file://{root}/one")) == values(df)


def test_required_columns(spark):
    df = spark.createDataFrame([(1,)], "a INT")
    assert readers.require_columns(df, ["a"]) is df
    with pytest.raises(readers.MissingColumns, match="b, c"):
        readers.require_columns(df, ["c", "a", "b"])


def test_json_lines_and_typed_csv(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text('{"a": "1", "b": 2.5}\n\n{"a": "3"}\n')
    df = readers.read_json_lines(spark, str(tmp_path / "e.jsonl"), ["a", "b"], ordered=True)
    assert [(r.a, r.b) for r in df.orderBy(*readers.ORDER).collect()] == [("1", "2.5"), ("3", None)]
    (tmp_path / "t.csv").write_text("a,b\n1,x\nbad,NULL\n")
    assert values(readers.read_typed_csv(spark, str(tmp_path / "t.csv"), "a INT, b STRING")) == [(1, "x"), (None, "NULL")]
    assert values(readers.read_typed_csv(spark, str(tmp_path / "t.csv"), "a INT, b STRING", "NULL"))[1] == (None, None)


def test_read_or_empty_and_sql_names(spark, tmp_path):
    gone = readers.read_or_empty(spark, str(tmp_path / "gone"), "a INT")
    assert gone.columns == ["a"] and gone.isEmpty()
    sinks.write_table(spark.range(3).select(F.col("id").cast("int").alias("a")), str(tmp_path / "t"))
    readers.register({"numbers_table": readers.read_or_empty(spark, str(tmp_path / "t"), "a INT"), "gone_table": gone})
    assert spark.sql("SELECT sum(a) FROM numbers_table").first()[0] == 3
    assert spark.sql("SELECT count(*) FROM gone_table").first()[0] == 0
    assert values(readers.empty_as_null(spark.createDataFrame([("", "x")], "a STRING, b STRING"))) == [(None, "x")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc')], "i INT, s STRING")
    paths = sinks.write_bundle({"one": df, "two": df.limit(0)}, str(tmp_path / "out"), "csv")
    assert values(readers.read_csv(spark, paths["one"], ["i", "s"])) == [("1", 'a "b"\nc')]
    sinks.write_report(df, str(tmp_path / "report"))
    assert values(spark.read.json(str(tmp_path / "report")), "i") == [(1,)]
    vectors = spark.createDataFrame([(1, [0.5, 1.0])], "i INT, embedding ARRAY<DOUBLE>")
    sinks.write_vectors(vectors, str(tmp_path / "v"))
    stored = spark.read.parquet(str(tmp_path / "v"))
    assert stored.schema["embedding"].dataType.simpleString() == "array<float>"
    letters = spark.createDataFrame([("r", "{}")], "failure_reason STRING, raw_payload STRING").withColumn(
        "quarantined_at", F.current_timestamp())
    for _ in range(2):
        sinks.append_dead_letters(letters, str(tmp_path / "dlq"))
    assert spark.read.json(str(tmp_path / "dlq")).count() == 2


def test_write_if_changed(spark, tmp_path):
    path = str(tmp_path / "snap")
    a = spark.createDataFrame([(1, None), (2, "x")], "i INT, s STRING")
    assert sinks.write_if_changed(a.limit(0), path) == (True, 0)
    assert sinks.write_if_changed(a, path) == (True, 2)
    assert sinks.write_if_changed(a.orderBy(F.desc("i")), path) == (False, 2)
    assert sinks.write_if_changed(a.filter("i = 1"), path) == (True, 1)
