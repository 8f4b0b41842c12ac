from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import types as T

from sparkmart.session import workspace
from sparkmart.sources import files, loads



def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_directory(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write(source / "Calendar.CSV", ' "Date "\n2020-01-01\nnot a date\n2020-01-03 10:30:00\n')
    write(source / "territories.csv", 'Sales_Territory_Key, Region\n1,Northwest\n2,"North, East"\n')
    write(source / "notes.txt", "not a table")
    schemas = {
        "calendar": T.StructType([T.StructField("date", T.TimestampNTZType())]),
        "territories": T.StructType(
            [T.StructField("sales_territory_key", T.LongType()), T.StructField("region", T.StringType())]
        ),
    }
    out = str(tmp_path / "out")
    report = files.load_csv_dir(spark, str(source), out, schemas, ["date"])
    assert rows(report) == [("calendar", 3), ("territories", 2)]
    assert rows(spark.read.parquet(f"{out}/calendar")) == [
        (None,), (datetime(2020, 1, 1),), (datetime(2020, 1, 3, 10, 30),),
    ]
    assert rows(spark.read.parquet(f"{out}/territories")) == [(1, "Northwest"), (2, "North, East")]
    # Types are inferred where no schema is given.
    files.load_csv_dir(spark, str(source), out, {"calendar": schemas["calendar"]}, ["date"])
    assert spark.read.parquet(f"{out}/territories").dtypes == [
        ("sales_territory_key", "int"), ("region", "string"),
    ]
    # Loading again replaces.
    files.load_csv_dir(spark, str(source), out, schemas, ["date"])
    assert spark.read.parquet(f"{out}/territories").count() == 2


def test_csv_with_a_bad_number_fails(spark, tmp_path):
    write(tmp_path / "t.csv", "k\nx\n")
    schema = T.StructType([T.StructField("k", T.LongType())])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.read_csv(spark, str(tmp_path / "t.csv"), schema).collect()


def test_csv_by_name_with_standard_quoting(spark, tmp_path):
    write(tmp_path / "t.csv", 'Name , K\n"a ""big"" one",1\n"a ""big"", one",2\n"two\nlines",3\n')
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType())])
    got = files.read_csv(spark, str(tmp_path / "t.csv"), schema, multi_line=True)
    assert rows(got) == [(1, 'a "big" one'), (2, 'a "big", one'), (3, "two\nlines")]
    other = T.StructType([T.StructField("other", T.StringType())])
    with pytest.raises(ValueError, match="no column other"):
        files.read_csv(spark, str(tmp_path / "t.csv"), other)


def test_empty_directory(spark, tmp_path):
    assert rows(files.load_csv_dir(spark, str(tmp_path), str(tmp_path / "out"), {})) == []


def test_read_source_with_schema(spark, table):
    path = table()
    spark.range(3).write.json(path)
    assert rows(files.read_source(spark, "json", path, schema="id int")) == [(0,), (1,), (2,)]


def test_read_source_passes_database_options_on(spark):
    # There is no database here: what can be seen is that Spark looks for its driver.
    with pytest.raises(Exception, match="No suitable driver"):
        files.read_source(
            spark, "jdbc", "dbo.sales", url="jdbc:none://nowhere", partition_column="order_line_item",
            bounds=(1, 100), partitions=4,
        )


def test_replace(spark, table):
    path = table()
    loads.load_replace(spark.range(5), path)
    loads.load_replace(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_append_keeps_history_and_survives_a_retry(spark, table):
    path, schema = table(), spark.range(1).schema
    loads.load_append(spark.range(2), path, "001")
    loads.load_append(spark.range(10, 12), path, "002")
    loads.load_append(spark.range(10, 12), path, "002")
    assert rows(loads.read_loads(spark, path, schema)) == [(0, "001"), (1, "001"), (10, "002"), (11, "002")]


@pytest.mark.parametrize("many", [False, True])
def test_archives_are_loaded_once(spark, table, many, monkeypatch):
    if many:
        monkeypatch.setattr("sparkmart.operators.joins.is_bounded", lambda df, n: False)
    path = table()
    schema = "id bigint, archive string"
    november = spark.createDataFrame([(1, "2022/11"), (2, "2022/11")], schema)
    both = spark.createDataFrame([(1, "2022/11"), (2, "2022/11"), (3, "2022/12")], schema)
    loads.append_unseen(november, path, "archive", "a")
    for _ in range(2):
        loads.append_unseen(both, path, "archive", "b")
    assert rows(loads.read_loads(spark, path), "id", "load_id") == [(1, "a"), (2, "a"), (3, "b")]


def test_audit(spark, table):
    path = table()
    first, second = spark.range(3), spark.range(4).withColumnRenamed("id", "key")
    for _ in range(2):
        loads.audit(path, "load-1", "loaded", {"a": first, "b": second})
    loads.audit(path, "load-2", "loaded", {"a": spark.range(9)})
    audited = loads.read_loads(spark, path)
    assert rows(audited, "load_id", "schema_name", "status", "row_count") == [
        ("load-1", "a", "loaded", 3), ("load-1", "b", "loaded", 4), ("load-2", "a", "loaded", 9),
    ]
    hashes = {(r["load_id"], r["schema_name"]): r["schema_version_hash"] for r in audited.collect()}
    assert hashes["load-1", "a"] == hashes["load-2", "a"] != hashes["load-1", "b"]


def test_layer_names():
    assert loads.table_path("/root/", None, "T") == "/root/main/t"
    assert loads.table_path("/root", " QUARANTINE ", "products") == "/root/QUARANTINE/products"


def test_workspace_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = workspace(spark, "x"), workspace(spark, "x")
    assert a.startswith(shared) and a != b
