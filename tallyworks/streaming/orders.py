"""The scheduled bronze-to-silver step as a Structured Streaming query."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyworks.contracts import conform_to_contract
from tallyworks.plans.lake import STORED_ORDERS, STORED_SILVER, Lake
from tallyworks.plans.silver import place_orders, stage_orders
from tallyworks.session import staged_tables_dropped


def stream_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    return spark.readStream.schema(STORED_ORDERS.schema).parquet(lake.bronze_orders.root)


def redelivered_dropped(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """Drop repeated deliveries of an order within ``delay``; state older than that is let go."""
    return stream.withWatermark("_ingestion_ts", delay).dropDuplicatesWithinWatermark(["order_id"])


def stream_into_silver(
    spark: SparkSession,
    lake: Lake,
    fx: DataFrame,
    checkpoint: str,
    clock: Callable[[], datetime],
) -> StreamingQuery:
    """Merge all bronze files that arrived since the last call, then stop.

    Rates are those of the day of ``clock()``. A micro-batch replayed after a crash finds its orders
    unchanged and merges to nothing.
    """

    def merge(batch: DataFrame, _: int) -> None:
        now = clock()
        staged = conform_to_contract(stage_orders(batch, fx, now.date(), now), STORED_SILVER)
        with staged_tables_dropped(spark):
            if lake.silver_orders.exists(spark):
                place_orders(spark, lake, staged, now)  # files may come in any order
            else:
                lake.silver_orders.overwrite(staged)

    writer = stream_bronze(spark, lake).writeStream.option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).foreachBatch(merge).start()
