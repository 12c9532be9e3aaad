"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str] = "order_id",
    ts_col: str = "_ingestion_ts",
    tie_breakers: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per key: the highest timestamp, then the highest tie breakers; nulls come last.

    The rank filter is pushed below the shuffle (window group limit), so each map task sends at
    most one row per key and a key that is delivered very often does not pile up in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (ts_col, *tie_breakers)])
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
