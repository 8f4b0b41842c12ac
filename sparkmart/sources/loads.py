"""Loading the raw layer: replace, append, load-once, audit."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.operators.joins import lookup_join
from sparkmart.session import STORED
from sparkmart.sources.files import exists

def table_path(root: str, layer: str | None, name: str, default_layer: str = "main") -> str:
    """Where a table lives: the layer name is used as it is, trimmed, or the default one."""
    return f"{root.rstrip('/')}/{(layer or default_layer).strip()}/{name.lower()}"


def load_replace(df: DataFrame, path: str) -> None:
    """Full load: the table afterwards holds exactly ``df``."""
    df.write.mode("overwrite").options(**STORED).parquet(path)


def load_append(df: DataFrame, path: str, load_id: str) -> None:
    """Append a load to an append-only table.

    Each load owns the partition of its ``load_id``, so running a failed load again
    replaces its leftovers instead of doubling them.
    """
    (
        df.withColumn("load_id", F.lit(load_id))
        .write.mode("overwrite")
        .options(**STORED)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("load_id")
        .parquet(path)
    )


def read_loads(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """An append-only table, all loads, with ``load_id`` as the string it was written as."""
    if schema is None:
        schema = spark.read.parquet(path).drop("load_id").schema
    with_load = T.StructType([*schema.fields, T.StructField("load_id", T.StringType())])
    return spark.read.schema(with_load).parquet(path)


def append_unseen(df: DataFrame, path: str, archive_col: str, load_id: str) -> None:
    """Append the rows of archives that no other load has brought yet.

    The archives already there are reduced to their distinct ids before the anti join. The
    load's own partition does not count, so running a failed load again is harmless.
    """
    fresh = df
    if exists(df.sparkSession, path):
        seen = (
            read_loads(df.sparkSession, path, df.schema)
            .where(F.col("load_id") != load_id)
            .select(archive_col)
            .distinct()
        )
        fresh = lookup_join(df, seen, [archive_col], "left_anti")
    load_append(fresh, path, load_id)


def schema_hash(schema: T.StructType) -> str:
    """SHA-256 of a schema: changes exactly when the schema does."""
    return hashlib.sha256(schema.json().encode()).hexdigest()


def audit(path: str, load_id: str, status: str, loaded: Mapping[str, DataFrame]) -> None:
    """Append one audit row per table of a load, with its row count and schema hash.

    Auditing the same load again replaces its rows.
    """
    rows = [
        table.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("schema_name"),
            F.lit(status).alias("status"),
            F.lit(schema_hash(table.schema)).alias("schema_version_hash"),
            "row_count",
        )
        for name, table in loaded.items()
    ]
    load_append(reduce(DataFrame.unionByName, rows).coalesce(1), path, load_id)
