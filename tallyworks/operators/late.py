"""Type 2 merge by the time of delivery: a late version goes between the versions that are held.

Where deliveries are worked in order, a batch only ever follows what is held and ``scd2.merge`` is enough. Here each key's
versions are ordered by the time they were delivered. A delivery that comes in late cuts the interval of the version
before it: that version ends where the late one opens, and is taken up again (as a row of its own) where a later delivery
is known to have confirmed it. The newest version stays current whatever order the days are run in.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.operators.scd2 import SILVER_HISTORY, HistoryColumns, _known, utc_literal

# When a version was delivered first, and (of a staged row) when the key's next delivery came that is known of.
DELIVERED = "_delivered_ts"
NEXT_DELIVERY = "_next_delivery_ts"


def with_next_delivery(
    staged: DataFrame, deliveries: DataFrame, key: str = "order_id", at: str = "_ingestion_ts", batch: str = "ingestion_date"
) -> DataFrame:
    """Add when each staged row's key was delivered next, out of ``deliveries``; ``staged`` has one row per key.

    Of a batch only a key's last delivery counts, as in the merges before. Partial aggregation leaves few rows a key: a time
    for each batch that held it, which are searched beside the staged row, so that ``staged`` is worked out once.
    """
    last = deliveries.groupBy(F.col(key).alias("_key"), batch).agg(F.max(at).alias("_at"))
    times = last.groupBy("_key").agg(F.collect_set("_at").alias("_times"))
    later = F.array_min(F.filter("_times", lambda t: t > F.col(DELIVERED)))
    return staged.join(times, F.col(key) == F.col("_key"), "left").withColumn(NEXT_DELIVERY, later).drop("_key", "_times")


def place(
    target: DataFrame,
    staged: DataFrame,
    run_ts: datetime,
    keys: Sequence[str] = ("order_id",),
    cols: HistoryColumns = SILVER_HISTORY,
) -> DataFrame:
    """All versions, after the merge, of the keys that ``staged`` holds.

    ``staged`` has one row per key with ``DELIVERED``; ``NEXT_DELIVERY`` may be absent. A row that follows everything held
    opens at its ``valid_from``, a late one at its delivery. Like the version before it, a row is dropped; like the version
    after it, that version opens earlier instead. Equal delivery times count as following. Held rows without a delivery
    time count as delivered when they open. A key whose version before has no hash stays as it is, and null keys match
    nothing. What the merge changed carries ``run_ts`` as its update time.
    """
    keys = list(keys)
    held = target.join(staged.where(_known(keys)).select(*keys), keys, "left_semi")
    return _placed(held, staged, run_ts, keys, cols)


def _placed(held: DataFrame, staged: DataFrame, run_ts: datetime, keys: list[str], cols: HistoryColumns) -> DataFrame:
    """``held`` and ``staged`` in one line per key; held rows of a key that nothing was staged for come out as they are."""
    target, known = held, _known(keys)
    if NEXT_DELIVERY not in staged.columns:
        staged = staged.withColumn(NEXT_DELIVERY, F.lit(None).cast("timestamp"))
    both = held.withColumn("_staged", F.lit(False)).unionByName(staged.where(known).withColumn("_staged", F.lit(True)), allowMissingColumns=True)
    at = F.coalesce(F.col(DELIVERED), F.col(cols.valid_from))
    line = Window.partitionBy(*keys).orderBy("_at", "_staged", cols.valid_from)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # one sort serves both
    opens, h, new = F.col(cols.valid_from), F.col(cols.source_hash), F.col("_staged")
    seen = both.withColumn("_at", at).withColumns(
        {
            "_n_new": F.count_if(new).over(whole),
            "_before_hash": F.lag(h).over(line), "_before_opens": F.lag(opens).over(line), "_has_before": F.lag(F.lit(True), 1, False).over(line),
            "_after_hash": F.lead(h).over(line), "_after_opens": F.lead(opens).over(line), "_after_at": F.lead("_at").over(line),
        }
    )
    repeated = F.raise_error(F.lit("staged keys are not unique")).cast("boolean")
    seen = seen.where(F.when(new & (F.col("_n_new") > 1), repeated).otherwise(F.lit(True)))
    late = F.col("_after_opens").isNotNull() | F.col(NEXT_DELIVERY).isNotNull()
    start = F.when(late, F.least(F.greatest(F.col("_at"), F.col("_before_opens")), F.col("_after_opens"))).otherwise(opens)
    # A delivery before that of the next version left no version: it confirmed the one before.
    confirmed = F.col("_after_at").isNull() | (F.col(NEXT_DELIVERY) < F.col("_after_at"))
    end = F.greatest(F.when(confirmed, F.least(F.col(NEXT_DELIVERY), F.col("_after_opens"))).otherwise(F.col("_after_opens")), start)
    like_before = F.col("_has_before") & F.coalesce(F.col("_before_hash") == h, F.lit(True))
    like_after = (F.col("_after_hash") == h) & (end == F.col("_after_opens"))
    fate = F.when(~new, F.lit(None)).when(like_before, "drop").when(F.coalesce(like_after, F.lit(False)), "move").otherwise("put")
    judged = seen.withColumns({"_start": F.when(new, start), "_end": F.when(new & late, end), "_fate": fate})
    judged = judged.withColumns(
        {
            "_next_fate": F.lead("_fate").over(line), "_next_start": F.lead("_start").over(line), "_next_end": F.lead("_end").over(line),
            "_last_fate": F.lag("_fate").over(line), "_last_start": F.lag("_start").over(line), "_last_at": F.lag("_at").over(line),
        }
    )

    closes, current, now = F.col(cols.valid_to), F.col(cols.is_current), utc_literal(run_ts)
    moved = F.coalesce(F.col("_last_fate") == "move", F.lit(False))
    cut = F.coalesce(F.col("_next_fate").isin("put", "move"), F.lit(False))
    resumed = F.coalesce(F.col("_next_fate") == "put", F.lit(False)) & F.col("_next_end").isNotNull() & (closes.isNull() | (F.col("_next_end") < closes))

    def piece(start, end, is_current, updated, delivered):
        return F.struct(
            start.alias(cols.valid_from), end.alias(cols.valid_to), is_current.alias(cols.is_current), updated.alias(cols.updated_ts), delivered.alias(DELIVERED)
        )

    own = piece(
        F.when(moved, F.col("_last_start")).otherwise(opens), F.when(cut, F.col("_next_start")).otherwise(closes), current & ~cut,
        F.when(moved | cut, now).otherwise(F.col(cols.updated_ts)), F.when(moved, F.col("_last_at")).otherwise(F.col(DELIVERED)),
    )
    rest = F.when(resumed, piece(F.col("_next_end"), closes, current, now, F.col("_next_end")))
    put = F.when(F.col("_fate") == "put", piece(F.col("_start"), F.col("_end"), F.col("_end").isNull(), now, F.col("_at")))
    pieces = F.array_compact(F.when(new, F.array(put)).otherwise(F.array(own, rest)))
    history = (cols.valid_from, cols.valid_to, cols.is_current, cols.updated_ts, DELIVERED)
    kept = [c for c in target.columns if c not in history]
    placed = judged.select(*kept, F.explode(pieces).alias("_piece")).select(*kept, "_piece.*").select(*target.columns)
    unknown = staged.where(~known).select(*[F.col(c) if c in staged.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns])
    return placed.unionByName(unknown)


def merge_by_delivery(
    target: DataFrame,
    staged: DataFrame,
    run_ts: datetime,
    keys: Sequence[str] = ("order_id",),
    cols: HistoryColumns = SILVER_HISTORY,
) -> DataFrame:
    """The next snapshot of ``target``; see ``place``.

    Rows of keys that nothing was staged for pass through their line, so that the table is shuffled once; those of null keys
    take no part in it.
    """
    known = _known(keys)
    return target.where(~known).unionByName(_placed(target.where(known), staged, run_ts, list(keys), cols))


def changes_of(
    before: DataFrame, placed: DataFrame, run_ts: datetime, keys: Sequence[str] = ("order_id",), cols: HistoryColumns = SILVER_HISTORY
) -> DataFrame:
    """The change feed of ``place``: ``before`` holds all versions of the same keys as they were.

    A row that went is a preimage. One that came is a postimage where its key held a version with its hash, else an insert.
    """
    columns = placed.columns
    both = before.select(*columns, F.lit(-1).alias("_n")).unionByName(placed.select(*columns, F.lit(1).alias("_n")))
    net = both.groupBy(*columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    gone_too = F.min("_n").over(Window.partitionBy(*keys, cols.source_hash)) < 0
    kind = F.when(F.col("_n") < 0, "update_preimage").when(gone_too, "update_postimage").otherwise("insert")
    return net.withColumns({"_change_type": kind, "_commit_ts": utc_literal(run_ts)}).drop("_n")
