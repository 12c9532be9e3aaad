"""Dense surrogate keys without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyworks.functions import row_hash


def assign_surrogate_keys(
    df: DataFrame,
    sk: str,
    key_cols: Sequence[str],
    existing: DataFrame | None = None,
    digits: int = 4,
    last_key: int | None = None,
) -> DataFrame:
    """Number the rows of ``df`` 1, 2, 3, ... after ``last_key``, or else after the highest ``sk`` of ``existing``.

    A stored table knows its highest key (``SnapshotTable.highest_key``); finding it in ``existing`` takes a scan.
    Rows are numbered in the order of the hash of their key. Its first hex digits cut them into
    16**digits groups of like size, whatever the keys look like: each group is ranked on its own,
    and starts where the groups before it end. The starts are a table of at most 16**digits rows,
    which bounds both the single-task running sum and the broadcast. The numbers depend on the
    data alone, so retried tasks agree. ``df`` is read twice: hand in a stored table if it is dear.
    """
    keys = list(key_cols)
    digest = row_hash(keys)
    marked = df.drop(sk).withColumn("_group", F.substring(digest, 1, digits))

    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sizes = marked.groupBy("_group").agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.select("_group", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))

    within = Window.partitionBy("_group").orderBy("_digest", *keys)
    # digests do not compress: they are worked out again after the shuffle
    dealt = marked.repartition("_group").withColumn("_digest", digest)
    ranked = dealt.withColumn("_place", F.row_number().over(within))
    number = (F.col("_start") + F.col("_place")).cast("long")
    if last_key is not None:
        number = number + F.lit(last_key).cast("long")
    elif existing is not None:
        number = number + existing.agg(F.coalesce(F.max(sk), F.lit(0))).scalar()
    out = ranked.join(F.broadcast(starts), "_group").withColumn(sk, number)
    return out.drop("_digest", "_group", "_place", "_start")
