"""Type 2 history: staging, merging, change feed and point-in-time reads.

A merge takes a table snapshot and a batch with unique keys and yields the whole next snapshot as
one plan, so a single write moves the table from one state to the next. Only current rows take part
in the shuffle; history passes through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions import row_hash

# The order columns whose change makes a new version.
ORDER_HASH_COLUMNS = ("customer_id", "product_id", "quantity", "unit_price", "status", "region")


@dataclass(frozen=True)
class HistoryColumns:
    """How a table spells its history columns."""

    valid_from: str
    valid_to: str
    is_current: str
    updated_ts: str
    source_hash: str


SILVER_HISTORY = HistoryColumns("_valid_from", "_valid_to", "_is_current", "_updated_ts", "_source_hash")
DIM_HISTORY = HistoryColumns("valid_from", "valid_to", "is_current", "updated_ts", "source_hash")


def utc_literal(moment: datetime) -> Column:
    """A timestamp literal that does not depend on the driver's own time zone."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(UTC).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


def stage(
    df: DataFrame,
    run_ts: datetime,
    hash_cols: Sequence[str] | None = ORDER_HASH_COLUMNS,
    cols: HistoryColumns = SILVER_HISTORY,
) -> DataFrame:
    """Mark every row as a version that opens at ``run_ts``.

    ``hash_cols=None`` keeps a hash the frame already has, for hashes taken before a conversion
    drops some of their columns.
    """
    added = {
        cols.valid_from: utc_literal(run_ts),
        cols.valid_to: F.lit(None).cast("timestamp"),
        cols.is_current: F.lit(True),
        cols.updated_ts: utc_literal(run_ts),
    }
    if hash_cols is not None:
        added[cols.source_hash] = row_hash(hash_cols)
    return df.withColumns(added)


def _known(keys: Sequence[str]) -> Column:
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return known


def classify(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str] = ("order_id",),
    cols: HistoryColumns = SILVER_HISTORY,
) -> DataFrame:
    """Current target rows and staged rows, each with what the merge does to it.

    ``_action`` is ``keep`` or ``expire`` for target rows and ``insert`` or ``discard`` for staged
    ones; ``_closes_at`` is the time at which an expired row ends. Both sides are shuffled once, on
    the key. A current row without a hash is neither expired nor replaced.
    """
    keys = list(keys)
    both = (
        target.where(F.col(cols.is_current))
        .withColumn("_staged", F.lit(False))
        .unionByName(staged.withColumn("_staged", F.lit(True)), allowMissingColumns=True)
    )
    same_key = Window.partitionBy(*keys)
    is_new, h, known = F.col("_staged"), F.col(cols.source_hash), _known(keys)
    seen = both.withColumns(
        {
            "_n_new": F.count_if(is_new).over(same_key),
            "_new_hash": F.max(F.when(is_new, h)).over(same_key),
            "_closes_at": F.max(F.when(is_new, F.col(cols.valid_from))).over(same_key),
        }
    )
    stays = ~is_new & F.coalesce(h == F.col("_new_hash"), F.lit(True))
    judged = seen.withColumn("_has_kept", known & F.bool_or(stays).over(same_key))
    repeated = F.raise_error(F.lit("staged keys are not unique")).cast("string")
    action = (
        F.when(is_new & known & (F.col("_n_new") > 1), repeated)
        .when(is_new, F.when(F.col("_has_kept"), "discard").otherwise("insert"))
        .when(known & F.coalesce(h != F.col("_new_hash"), F.lit(False)), "expire")
        .otherwise("keep")
    )
    return judged.withColumn("_action", action).drop("_staged", "_n_new", "_new_hash", "_has_kept")


def _close(df: DataFrame, closing: Column, run_ts: datetime, cols: HistoryColumns) -> DataFrame:
    return df.withColumns(
        {
            cols.valid_to: F.when(closing, F.col("_closes_at")).otherwise(F.col(cols.valid_to)),
            cols.is_current: F.when(closing, F.lit(False)).otherwise(F.col(cols.is_current)),
            cols.updated_ts: F.when(closing, utc_literal(run_ts)).otherwise(F.col(cols.updated_ts)),
        }
    )


def next_rows(classified: DataFrame, run_ts: datetime, cols: HistoryColumns = SILVER_HISTORY) -> DataFrame:
    """The rows that classified rows turn into in the next snapshot."""
    kept = classified.where("_action <> 'discard'")
    return _close(kept, F.col("_action") == "expire", run_ts, cols).drop("_action", "_closes_at")


def merge(
    target: DataFrame,
    staged: DataFrame,
    run_ts: datetime,
    keys: Sequence[str] = ("order_id",),
    cols: HistoryColumns = SILVER_HISTORY,
) -> DataFrame:
    """The next snapshot of ``target``."""
    history = target.where(~F.coalesce(F.col(cols.is_current), F.lit(False)))
    return history.unionByName(next_rows(classify(target, staged, keys, cols), run_ts, cols))


def effective_changes(
    target: DataFrame,
    staged: DataFrame,
    keys: Sequence[str] = ("order_id",),
    cols: HistoryColumns = SILVER_HISTORY,
) -> DataFrame:
    """The staged rows that are new or changed; the merge of these equals the merge of all.

    Only keys and hashes of the target are read, and those of the batch's keys are kept; whether that takes a shuffle
    of the target is for run-time sizes to say.
    """
    keys = list(keys)
    held = target.where(F.col(cols.is_current)).select(*keys, cols.source_hash)
    held = held.join(staged.select(*keys), keys, "left_semi")
    # One row per key already, unless the table is damaged: then every current row must agree.
    agreed = held.groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys]).agg(
        F.min(cols.source_hash).alias("_lo"), F.max(cols.source_hash).alias("_hi")
    )
    h = F.col(cols.source_hash)
    same = F.coalesce((F.col("_lo") == h) & (F.col("_hi") == h), F.lit(True))
    for k in keys:
        same = same & (F.col(k) == F.col(f"_t_{k}"))
    return staged.join(agreed, same, "left_anti")


def change_feed(classified: DataFrame, run_ts: datetime, cols: HistoryColumns = SILVER_HISTORY) -> DataFrame:
    """Row changes of one merge: insert, and before and after images of every expired row."""
    kinds = F.when(F.col("_action") == "insert", F.array(F.lit("insert"))).otherwise(
        F.array(F.lit("update_preimage"), F.lit("update_postimage"))
    )
    changes = classified.where(F.col("_action").isin("insert", "expire")).withColumn("_change_type", F.explode(kinds))
    closed = _close(changes, F.col("_change_type") == "update_postimage", run_ts, cols)
    return closed.withColumn("_commit_ts", utc_literal(run_ts)).drop("_action", "_closes_at")


def as_of(df: DataFrame, moment: datetime | Column, cols: HistoryColumns = SILVER_HISTORY) -> DataFrame:
    """The versions that were valid at ``moment``."""
    t = utc_literal(moment) if isinstance(moment, datetime) else moment
    return df.where((F.col(cols.valid_from) <= t) & (F.col(cols.valid_to).isNull() | (t < F.col(cols.valid_to))))


def as_of_join(
    left: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    ts_col: str,
    cols: HistoryColumns = SILVER_HISTORY,
    how: str = "left",
) -> DataFrame:
    """Join each left row to the version of its key that was valid at the row's own time."""
    keys = list(keys)
    right = versions.select(
        *[F.col(c).alias(f"_v_{c}") if c in keys else F.col(c) for c in versions.columns]
    )
    cond = (F.col(cols.valid_from) <= F.col(ts_col)) & (
        F.col(cols.valid_to).isNull() | (F.col(ts_col) < F.col(cols.valid_to))
    )
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_v_{k}"))
    return left.join(right, cond, how).drop(*[f"_v_{k}" for k in keys])


def current_count(df: DataFrame, cols: HistoryColumns = SILVER_HISTORY) -> DataFrame:
    return df.where(F.col(cols.is_current)).agg(F.count(F.lit(1)).alias("active_rows"))
