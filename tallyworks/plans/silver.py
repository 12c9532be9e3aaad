"""Silver job: bronze orders to the versioned, USD-valued order table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.contracts import SILVER_ORDERS, conform_to_contract
from tallyworks.functions import default_processing_date, row_hash, standardise_status
from tallyworks.operators import control, late, quality, scd2
from tallyworks.operators.cleanse import cleanse, with_date_parts
from tallyworks.operators.fx import convert_to_usd, usable_rates
from tallyworks.operators.latest import latest_per_key
from tallyworks.operators.star import enrich_orders
from tallyworks.plans.ingest import read_bronze_orders
from tallyworks.plans.lake import STORED_SILVER, Lake
from tallyworks.plans.runlog import RunResult, log, run_logged
from tallyworks.session import stage
from tallyworks.sources.layout import cluster_rewrite, files_for
from tallyworks.sources.tables import incremental_scan

TRANSFORM_SILVER = "transform_silver_sales"

# Columns that settle equal ingestion times, so that a re-run keeps the same delivery.
TIE_BREAKERS = ("total_amount", "product_id", "status", "quantity", "sales_rep_id")
CLUSTER_BY = ("order_date", "customer_id", "product_id", "order_id")


def stage_orders(
    bronze: DataFrame,
    fx: DataFrame,
    rate_date: date | str,
    run_ts: datetime,
    status_rule: Callable[[Column], Column] = standardise_status,
    tie_breakers: tuple[str, ...] = TIE_BREAKERS,
    enrich: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Cleanse, keep the latest delivery per order, hash, convert to USD and open a version.

    The hash is taken in source currency: conversion drops the price it covers, and a new rate
    alone is no change of the order. ``enrich`` adds columns the hash does not cover. It comes before the hash, since
    digests do not compress and large dimensions take a shuffle each; for the same reason the parts of the date are taken
    again after it instead of being shuffled beside the date.
    """
    clean = cleanse(bronze, status_rule).drop("order_year", "order_month")
    latest = enrich(latest_per_key(clean, "order_id", "_ingestion_ts", tie_breakers))
    hashed = with_date_parts(latest).withColumns({"_source_hash": row_hash(scd2.ORDER_HASH_COLUMNS), late.DELIVERED: F.col("_ingestion_ts")})
    return scd2.stage(convert_to_usd(hashed, usable_rates(fx, rate_date)), run_ts, hash_cols=None)


def build_silver(
    spark: SparkSession,
    lake: Lake,
    fx: DataFrame,
    processing_date: date | None,
    run_ts: datetime,
    full_refresh: bool = False,
    bronze: DataFrame | None = None,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    optimize: bool = False,
) -> RunResult:
    """Merge one ingestion date (by default yesterday's) into silver, or rebuild it from everything.

    Only the current rows of months that hold a new or changed order are rewritten, once; closed rows are added to the
    history. ``optimize`` clusters the rewritten partitions afterwards, see ``cluster_silver``. Days may be run in any order
    and again: once a later day has been run, an earlier day's versions go between those held. Names come from
    ``customers`` and ``products``, by default from the stored dimensions once there are any.
    """
    processing_date = processing_date or default_processing_date(run_ts)

    def work(run_id: str, _: datetime) -> RunResult:
        raw = read_bronze_orders(spark, lake) if bronze is None else bronze
        scanned = incremental_scan(raw, processing_date, full_refresh)
        named = [given if given is not None else table.read(spark) if table.exists(spark) else None
                 for given, table in ((customers, lake.customers), (products, lake.products))]
        names = {"enrich": lambda df: enrich_orders(df, *named)} if all(n is not None for n in named) else {}
        staged = conform_to_contract(stage_orders(scanned, fx, processing_date, run_ts, **names), STORED_SILVER)
        table = lake.silver_orders
        if full_refresh or not table.exists(spark):
            table.overwrite(staged)
            changed = table.read(spark).count()
        else:
            last = last_day_seen(spark, lake)
            if last is not None and last > processing_date:
                d = F.col("ingestion_date")
                later = raw.where((d > F.lit(processing_date)) & (d <= F.lit(last)))
                changed = place_orders(spark, lake, late.with_next_delivery(staged, later), run_ts)
            else:
                changed = merge_orders(spark, lake, staged, run_ts)
        quality.require_active_rows(table.read(spark))
        if optimize and changed:
            cluster_silver(spark, lake)
        return RunResult(run_id, changed, run_ts)

    return run_logged(spark, lake, TRANSFORM_SILVER, run_ts, work, processing_date)


def check_silver(spark: SparkSession, lake: Lake, skip: bool = False) -> list:
    """The gate over the stored current rows: standard, contract and dictionary rules in one scan, and unique keys.

    Raises when one fails, unless ``skip`` overrides it; returns all outcomes. History is not read.
    """
    current = lake.silver_orders.read(spark).where("_is_current")
    rules = [*quality.CORE_CHECKS, *quality.contract_rules(SILVER_ORDERS), *quality.DICTIONARY_CHECKS]
    found = quality.evaluate(current, rules, non_empty=True)
    return quality.gate(found.unionByName(quality.uniqueness_check(current, SILVER_ORDERS)), skip)


def last_day_seen(spark: SparkSession, lake: Lake) -> date | None:
    """The latest day whose deliveries silver reflects: by the run log, or by a held version (a full refresh sees all)."""
    current = lake.silver_orders.read(spark).where("_is_current")  # no closed row was delivered after its key's current one
    held = current.agg(F.max(F.to_date(late.DELIVERED)).alias("d")).first().d
    return max((d for d in (held, control.last_success(log(spark, lake), TRANSFORM_SILVER)) if d is not None), default=None)


def merge_orders(spark: SparkSession, lake: Lake, staged: DataFrame, run_ts: datetime) -> int:
    """Merge staged versions into the current rows; returns how many orders were new or changed.

    What the merge closes is added to the history, which is neither read nor rewritten. The changes are stored in the feed.
    """
    table = lake.silver_orders
    months = list(STORED_SILVER.partition_by)
    current = table.read(spark).where("_is_current")  # a partition filter
    # The batch is computed once. Redelivered, unchanged orders leave here and cost no rewrite.
    batch = stage(staged, "silver-batch")
    changes = stage(scd2.effective_changes(current, batch), "silver-changes")
    n = changes.count()
    if n == 0:
        return 0
    ids = changes.select("order_id")
    held_in = current.select("order_id", *months).join(ids, "order_id", "left_semi").select(*months)
    affected = [(True, *r) for r in held_in.unionByName(changes.select(*months)).distinct().collect()]
    part = table.read(spark, affected)
    held = part.join(ids, "order_id", "left_semi")
    judged = stage(scd2.classify(held, changes), "silver-judged")
    merged = part.join(ids, "order_id", "left_anti").unionByName(scd2.next_rows(judged, run_ts))
    commit(spark, lake, merged, affected, scd2.change_feed(judged, run_ts))
    return n


def place_orders(spark: SparkSession, lake: Lake, staged: DataFrame, run_ts: datetime) -> int:
    """Merge staged versions that may be older than those held; returns how many orders changed.

    Only the partitions, history among them, that hold one of the batch's orders are read, and of these only the changed
    ones are rewritten.
    """
    table = lake.silver_orders
    parts = list(table.partition_by)
    batch = stage(staged, "silver-batch")
    ids = batch.select("order_id")
    held_in = table.read(spark).select("order_id", *parts).join(ids, "order_id", "left_semi").select(*parts).distinct()
    held = stage(table.read(spark, [tuple(r) for r in held_in.collect()]).join(ids, "order_id", "left_semi"), "silver-held")
    placed = stage(late.place(held, batch, run_ts), "silver-placed")
    feed = stage(late.changes_of(held, placed, run_ts), "silver-feed")
    affected = [tuple(r) for r in feed.select(*parts).distinct().collect()]
    if not affected:
        return 0
    here = F.struct(*parts).isin([F.struct(*[F.lit(v) for v in p]) for p in affected])
    others = table.read(spark, affected).join(ids, "order_id", "left_anti")
    commit(spark, lake, others.unionByName(placed.where(here)), affected, feed)
    return feed.select("order_id").distinct().count()


def commit(spark: SparkSession, lake: Lake, rows: DataFrame, replaced: list[tuple], changes: DataFrame) -> None:
    """One write of the table: its new state and, before that shows, the changes that make it."""
    table = lake.silver_orders
    lake.silver_changes.write(table.next_version(spark), changes)
    table.apply(rows, replaced)


def cluster_silver(spark: SparkSession, lake: Lake, partitions: list[tuple] | None = None) -> None:
    """Range-cluster partitions (by default those that several writes hold, and the last written) in target-sized files.

    A step of its own: it changes no row, and the feed says so. Long histories of small additions become few files by it.
    """
    table = lake.silver_orders
    version = table.versions(spark)[-1]
    held = table.manifest(spark)
    if partitions is None:
        folders = [p for p, vs in held.items() if len(vs) > 1 or vs[-1] == version]
        partitions = [tuple(part.split("=", 1)[1] for part in p.split("/")) for p in folders]
    if not partitions:
        return
    rows = table.read(spark, partitions)
    lake.silver_changes.write(table.next_version(spark), spark.createDataFrame([], lake.silver_changes.stored))
    by = [*table.partition_by, *CLUSTER_BY]
    table.adopt(cluster_rewrite(rows, by, files_for(table.stored_bytes(spark, partitions))), partitions)
