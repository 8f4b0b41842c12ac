"""Reading source tables."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on whichever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and all below it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def children(spark: SparkSession, directory: str) -> dict[str, str]:
    """Paths of what lies directly in ``directory``, by name; none if it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return {}
    return {s.getPath().getName(): s.getPath().toString() for s in fs.listStatus(hadoop_path)}


def tables_in(spark: SparkSession, directory: str, suffix: str = ".csv") -> dict[str, str]:
    """Paths of the tables in ``directory`` by lower-cased name."""
    return {
        name[: -len(suffix)].lower(): path
        for name, path in sorted(children(spark, directory).items())
        if name.lower().endswith(suffix)
    }


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    date_columns: Collection[str] = (),
    *,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV file with header, columns lower-cased and stripped, dates coerced.

    Quotes inside a quoted value are doubled. ``multi_line`` allows line breaks in quoted
    values, at the price of one task per file. Columns are taken by name: those of ``schema``, in
    its order, and a missing one fails the load; without a schema the types are inferred, which
    reads the file once more. What does not parse as a date becomes NULL; any other value
    at odds with the schema fails the load.
    """
    dates = {c.strip().lower() for c in date_columns}
    reader = spark.read.options(
        header=True, mode="FAILFAST", quote='"', escape='"', multiLine=multi_line
    )
    raw = reader.option("inferSchema", schema is None).csv(path)
    clean = raw.toDF(*[c.strip().strip('"').strip().lower() for c in raw.columns])
    if schema is not None:
        wanted = {f.name.strip().lower(): f.dataType for f in schema.fields}
        missing = sorted(wanted.keys() - set(clean.columns))
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        clean = clean.select(
            *[
                F.col(f"`{name}`").cast("string" if name in dates else kind).alias(name)
                for name, kind in wanted.items()
            ]
        )

    def coerced(f: T.StructField) -> Column:
        if f.name not in dates:
            return F.col(f"`{f.name}`")
        text = F.col(f"`{f.name}`").cast("string")
        return F.try_to_timestamp(text).cast("timestamp_ntz").alias(f.name)

    return clean.select(*[coerced(f) for f in clean.schema.fields])


def load_csv_dir(
    spark: SparkSession,
    directory: str,
    target: str,
    schemas: Mapping[str, T.StructType] | None = None,
    date_columns: Collection[str] = (),
    *,
    multi_line: bool = False,
) -> DataFrame:
    """Load every CSV of ``directory`` into a parquet table of its name, replacing it.

    Tables without an entry in ``schemas`` have their types inferred. Gives one row per
    table with its row count.
    """
    reports = []
    for name, path in tables_in(spark, directory).items():
        out = f"{target.rstrip('/')}/{name}"
        loaded = read_csv(spark, path, (schemas or {}).get(name), date_columns, multi_line=multi_line)
        loaded.write.mode("overwrite").parquet(out)
        reports.append(
            spark.read.schema(loaded.schema)
            .parquet(out)
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), "row_count")
        )
    if not reports:
        return spark.createDataFrame([], "table_name string, row_count bigint")
    return reduce(DataFrame.unionByName, reports)


def read_source(
    spark: SparkSession,
    fmt: str,
    location: str,
    *,
    schema: T.StructType | str | None = None,
    partition_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 64,
    **options: str,
) -> DataFrame:
    """Read a whole source table.

    ``fmt`` is any Spark format. For ``jdbc`` the location is the table; give a
    ``partition_column`` with its ``bounds`` so that many tasks read disjoint ranges
    instead of one task reading everything.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None and fmt != "jdbc":
        reader = reader.schema(schema)
    if fmt == "jdbc":
        reader = reader.option("dbtable", location)
        if partition_column is not None:
            low, high = bounds
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", str(low))
                .option("upperBound", str(high))
                .option("numPartitions", partitions)
            )
        return reader.load()
    return reader.load(location)
