"""Micro-batches from a change log into the sales fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkmart.operators.merge import KeyedTable
from sparkmart.operators.staging import staged
from sparkmart.plans.facts import sales_increment


def read_log_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    max_files_per_trigger: int | None = None,
    glob: str = "*.parquet",
) -> DataFrame:
    """The raw change log as a stream of newly arrived parquet files."""
    reader = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def cdc_to_fact(
    log: DataFrame,
    dim_products: Callable[[SparkSession], DataFrame],
    table: KeyedTable,
    checkpoint_location: str,
) -> StreamingQuery:
    """Merge what has arrived since the last run into the fact, then stop.

    Each batch is reduced to its last event per key, resolved against the product versions
    as they are then, and upserted. A batch repeated after a failure, or events out of order
    between batches, change nothing: the upsert applies only what is newer than the fact.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        events = staged("sales_log", batch)
        table.upsert(sales_increment(events, dim_products(batch.sparkSession)), keys_from=events)

    return (
        log.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
