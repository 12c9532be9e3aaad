"""Every operator as a query over the sample tables.

``OUTPUT`` fixes, per query, the columns and plain types both sides of a comparison return:
s text, b boolean, l integer, d number, t timestamp, a date.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyworks import functions as fn
from tallyworks.contracts import (
    BRONZE_ORDERS,
    MONEY,
    SILVER_ORDERS,
    TableContract,
    columns,
    conform_strict,
    conform_to_contract,
    STR,
    DATE,
    BOOL,
)
from tallyworks.operators import cleanse as cl
from tallyworks.operators import control, fx, late, quality, reports, scd2, star, summary
from tallyworks.operators.latest import latest_per_key
from tallyworks.plans import gold, runlog, silver
from tallyworks.plans.ingest import archive_dates
from tallyworks.plans.lake import STORED_ORDERS, Lake
from tallyworks.plans.silver import CLUSTER_BY, TIE_BREAKERS
from tallyworks.sources import (
    SnapshotTable,
    cluster_rewrite,
    crm_accounts,
    incremental_scan,
    max_watermark,
    recently_modified,
    retention_tiers,
    stored_bytes,
    unpack_records,
    window_extract,
)
from tallyworks.session import stage, staging_root
from tallyworks.sources.feed import ChangeFeed, replay
from tallyworks.sources.files import CATALOGUE_JSON, CRM_JSON, ORDERS_CSV
from tallyworks.sources.landing import Landing, not_held, page_sets, parse_json_checked, read_csv_checked, split_corrupt
from tallyworks.sources.layout import files_for
from testbed import tables as tb

Query = Callable[[SparkSession, str], DataFrame]

SPARK_TYPES = {"s": "string", "b": "boolean", "l": "bigint", "d": "double", "t": "timestamp", "a": "date"}

STAGED = (
    "order_id:s order_date:a customer_id:s product_id:s quantity:d unit_price_usd:d total_amount_usd:d "
    "original_currency:s fx_rate_to_usd:d status:s region:s sales_rep_id:s _valid_from:t _valid_to:t "
    "_is_current:b _updated_ts:t _source_hash:s"
)
CUSTOMER = (
    "customer_sk:l customer_id:s customer_name:s account_type:s industry:s country:s city:s region:s email:s "
    "account_manager_id:s credit_limit:d currency:s is_active:b valid_from:t valid_to:t is_current:b created_ts:t "
    "updated_ts:t source_hash:s"
)
FACT = (
    "sales_order_sk:l order_id:s customer_sk:l product_sk:l sales_rep_sk:l date_sk:l order_date:a status:s region:s "
    "quantity:d unit_price_usd:d total_amount_usd:d original_currency:s fx_rate_to_usd:d gross_margin_usd:d "
    "cost_amount_usd:d created_ts:t updated_ts:t pipeline_run_id:s"
)
SUMMARY = (
    "order_date:a order_year:l order_month:l order_quarter:l region:s category:s status:s order_count:l "
    "customer_count:l total_quantity:d total_revenue_usd:d total_cost_usd:d gross_margin_usd:d "
    "avg_order_value_usd:d refreshed_ts:t"
)
OVERVIEW = (
    "order_date:a order_year:l year_month:s year_quarter:s customer_id:s customer_name:s industry:s country:s "
    "account_type:s product_id:s product_name:s category:s subcategory:s region:s sales_rep_name:s sales_team:s "
    "order_id:s status:s quantity:d unit_price_usd:d revenue_usd:d cost_amount_usd:d gross_margin_usd:d "
    "gross_margin_pct:d original_currency:s fx_rate_to_usd:d"
)
CHECKS = "check_name:s passed:b failed_rows:l total_rows:l detail:s"
RUNS = "pipeline_name:s run_id:s status:s rows_processed:l last_watermark:t run_date:t error_message:s"

OUTPUT: dict[str, str] = {}
QUERIES: dict[str, Query] = {}


def query(output: str):
    def register(f: Query) -> Query:
        OUTPUT[f.__name__] = output

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            picked = [c.split(":") for c in output.split()]
            return df.select(*[F.col(n).cast(SPARK_TYPES[k]).alias(n) for n, k in picked])

        run.__name__ = f.__name__
        run.__doc__ = f.__doc__
        QUERIES[f.__name__] = run
        return f

    return register


# Cleansing


@query("order_id:s status:s")
def status_standardise(spark, sf):
    return cl.with_status(tb.bronze_orders(spark, sf))


@query("order_id:s status:s")
def status_strict(spark, sf):
    return cl.with_status(tb.bronze_orders(spark, sf), fn.standardise_status_strict)


@query("order_id:s order_date:a order_year:l order_month:l quantity:d unit_price:d total_amount:d")
def typed_cleanse(spark, sf):
    return cl.with_date_parts(cl.parse_types(tb.text_orders(spark, sf)))


@query("order_id:s region:s sales_rep_id:s")
def default_fill(spark, sf):
    return cl.fill_defaults(tb.bronze_orders(spark, sf))


@query("order_id:s order_date:a customer_id:s product_id:s quantity:d status:s region:s sales_rep_id:s")
def required_not_null(spark, sf):
    return cl.cleanse(tb.text_orders(spark, sf))


@query("order_id:s order_year:l order_month:l order_quarter:l year_month:s year_quarter:s date_sk:l")
def date_parts(spark, sf):
    return cl.with_date_parts(tb.bronze_orders(spark, sf)).withColumns(
        {
            "order_quarter": F.quarter("order_date"),
            "year_month": fn.year_month("order_date"),
            "year_quarter": fn.year_quarter("order_date"),
            "date_sk": fn.date_key("order_date"),
        }
    )


@query("order_id:s _source_hash:s")
def row_hash(spark, sf):
    orders = cl.cleanse(tb.bronze_orders(spark, sf))
    return orders.withColumn("_source_hash", fn.row_hash(scd2.ORDER_HASH_COLUMNS))


@query("order_id:s unit_price_usd:d total_amount_usd:d original_currency:s fx_rate_to_usd:d")
def fx_convert(spark, sf):
    return fx.convert_to_usd(tb.bronze_orders(spark, sf), fx.usable_rates(tb.fx_rates(spark), tb.RATE_DATE))


@query("original_currency:s order_count:l missing_fx_rate:l")
def fx_missing_rate(spark, sf):
    rates = fx.usable_rates(tb.fx_rates(spark), tb.RATE_DATE)
    converted = fx.convert_to_usd(tb.bronze_orders(spark, sf), rates, flag_missing=True)
    return converted.groupBy("original_currency").agg(
        F.count(F.lit(1)).alias("order_count"), F.count_if("fx_rate_missing").alias("missing_fx_rate")
    )


@query("order_id:s customer_id:s product_id:s quantity:d total_amount:d status:s sales_rep_id:s _ingestion_ts:t")
def dedup_latest(spark, sf):
    return latest_per_key(tb.bronze_orders(spark, sf), "order_id", "_ingestion_ts", TIE_BREAKERS)


# Incremental reads


@query("order_id:s customer_id:s total_amount:d ingestion_date:a")
def incremental_scan_day(spark, sf):
    return incremental_scan(tb.bronze_orders(spark, sf), "1998-06-02")


@query("l_orderkey:l l_linenumber:l l_shipdate:t _ingestion_ts:t _source_file:s _is_deleted:b")
def watermark_window(spark, sf):
    source = tb.load(spark, sf, "lineitem")
    lower, upper = datetime(1996, 1, 1), datetime(1997, 1, 1)
    return window_extract(source, "l_shipdate", lower, upper, fn.new_run_id(tb.RUN_1), tb.RUN_1)


@query("max_watermark:s")
def max_watermark_value(spark, sf):
    return max_watermark(tb.load(spark, sf, "lineitem"), "l_shipdate")


# History


@query(STAGED)
def scd2_stage(spark, sf):
    return tb.silver_batches(spark, sf)[0]


@query(STAGED)
def scd2_merge(spark, sf):
    return tb.merged_silver(spark, sf)


@query(STAGED + " _delivered_ts:t")
def scd2_merge_late(spark, sf):
    """The batch in between comes last and takes its place between the versions of the other two."""
    early, between, after = tb.late_batches(spark, sf)
    held = stage(late.merge_by_delivery(early, after, tb.LATE_RUNS[2]), "held")
    return late.merge_by_delivery(held, between, tb.LATE_RUNS[1])


@query(STAGED + " _change_type:s _commit_ts:t")
def scd2_change_feed(spark, sf):
    first, second = tb.silver_batches(spark, sf)
    return scd2.change_feed(scd2.classify(first, second), tb.RUN_2)


@query(STAGED)
def feed_replay(spark, sf):
    """The first state of a stored table and the changes kept since: its second state."""
    first, second = tb.silver_batches(spark, sf)
    root, judged = f"{staging_root(spark)}/staged/feed-{uuid.uuid4().hex}", stage(scd2.classify(first, second), "judged")
    table, feed = SnapshotTable(f"{root}/table", first.schema, ("_is_current",)), ChangeFeed(f"{root}/changes", first.schema)
    table.overwrite(first)
    feed.write(table.next_version(spark), scd2.change_feed(judged, tb.RUN_2))
    current = table.read(spark).where("_is_current")
    kept = current.join(judged.select("order_id").distinct(), "order_id", "left_anti")
    version = table.apply(kept.unionByName(scd2.next_rows(judged, tb.RUN_2)), [(True,)])
    return replay(table.read(spark, version=1), feed.between(spark, 1, version))


@query("order_id:s _source_hash:s")
def scd2_effective_changes(spark, sf):
    first, second = tb.silver_batches(spark, sf)
    return scd2.effective_changes(first, second)


@query(STAGED)
def scd2_as_of(spark, sf):
    return scd2.as_of(tb.silver_versions(spark, sf), datetime(2002, 1, 1, 12))


@query("order_id:s _ingestion_ts:t seen_at:t _source_hash:s _valid_from:t")
def scd2_as_of_join(spark, sf):
    """Every delivery next to the version that was valid at a time of its own."""
    noon, later = F.lit("2002-01-01 12:00:00").cast("timestamp"), F.lit("2002-01-03 00:00:00").cast("timestamp")
    asked = tb.bronze_orders(spark, sf).select(
        "order_id", "_ingestion_ts", F.when(F.col("quantity") > 25, noon).otherwise(later).alias("seen_at")
    )
    versions = tb.silver_versions(spark, sf).select("order_id", "_source_hash", "_valid_from", "_valid_to")
    return scd2.as_of_join(asked, versions, ["order_id"], "seen_at")


@query("active_rows:l")
def scd2_current_count(spark, sf):
    return scd2.current_count(tb.silver_versions(spark, sf))


# Star schema


@query(CUSTOMER)
def dim_customer(spark, sf):
    first, later = tb.customer_deliveries(spark, sf)
    held = stage(star.dim_customer(first, tb.RUN_1), "customer")
    return star.dim_customer(later, tb.RUN_2, held, store=lambda df: stage(df, "tagged"))


@query(
    "product_sk:l product_id:s sku:s product_name:s category:s subcategory:s unit_price:d cost_price:d currency:s uom:s supplier_id:s "
    "is_active:b valid_from:t valid_to:t is_current:b created_ts:t updated_ts:t source_hash:s"
)
def dim_product(spark, sf):
    return star.dim_product(tb.products(spark, sf), tb.RUN_1)


@query(
    "employee_sk:l employee_id:s full_name:s team:s valid_from:t valid_to:t is_current:b created_ts:t updated_ts:t source_hash:s"
)
def dim_employee(spark, sf):
    return star.dim_employee(tb.representatives(spark, sf), tb.RUN_1)


@query("date_sk:l date:a year:l quarter:l month:l year_month:s")
def dim_date(spark, sf):
    return star.dim_date(tb.bronze_orders(spark, sf))


@query(STAGED + " customer_name:s product_name:s category:s order_year:l order_month:l")
def silver_enriched(spark, sf):
    return tb.enriched_orders(spark, sf)


@query(FACT)
def fact_sales_orders(spark, sf):
    """The rows of resolved orders are stored, since numbering reads them twice."""
    resolved = star.resolve_keys(tb.silver_orders(spark, sf), *tb.dimensions(spark, sf))
    return star.fact_orders(resolved, tb.RUN_1, fn.new_run_id(tb.RUN_1), store=lambda df: stage(df, "resolved"))


@query("order_id:s customer_id:s product_id:s unresolved:s")
def fact_unresolved(spark, sf):
    first, _ = tb.customer_deliveries(spark, sf)
    dims = stage(star.dim_customer(first, tb.RUN_1), "customer"), *tb.dimensions(spark, sf)[1:]
    return star.unresolved_orders(star.resolve_keys(tb.silver_orders(spark, sf), *dims))


@query(FACT)
def fact_upsert(spark, sf):
    """Facts of the first batch, then the second batch replacing them by order."""
    second = tb.silver_batches(spark, sf)[1]
    rows = stage(star.fact_rows(star.resolve_keys(second, *tb.dimensions(spark, sf)), tb.RUN_2, "RUN-2"), "rows")
    return star.upsert_fact(tb.early_fact(spark, sf), rows, lambda df: stage(df, "matched"))


# Summary and reports


def _summary(spark, sf):
    return summary.daily_summary(tb.fact_orders(spark, sf), tb.dimensions(spark, sf)[1], tb.RUN_1)


@query(SUMMARY)
def daily_summary_full(spark, sf):
    return _summary(spark, sf)


@query(SUMMARY)
def daily_summary_replace_date(spark, sf):
    """A summary of the first batch's facts, one date of which is redone from all facts."""
    products, day = tb.dimensions(spark, sf)[1], "1998-03-02"
    old = summary.daily_summary(tb.early_fact(spark, sf), products, tb.RUN_1)
    return summary.replace_date(old, summary.daily_summary(tb.fact_orders(spark, sf), products, tb.RUN_2, day), day)


@query("summary_sk:l order_date:a region:s category:s status:s")
def daily_summary_keys(spark, sf):
    return summary.number_summary(stage(_summary(spark, sf), "summary"))


def _overview(spark, sf):
    return reports.sales_overview(tb.fact_orders(spark, sf), *tb.dimensions(spark, sf))


@query(OVERVIEW)
def sales_overview(spark, sf):
    return _overview(spark, sf)


@query(OVERVIEW)
def sales_overview_secured(spark, sf):
    return reports.secured(_overview(spark, sf), tb.entitlements(spark, sf), "NATION_3")


@query(
    "order_id:s order_date:a order_year:l order_month:l customer_id:s customer_name:s product_id:s product_name:s category:s "
    "region:s sales_rep_id:s quantity:d unit_price_usd:d total_amount_usd:d"
)
def completed_orders(spark, sf):
    return reports.completed_orders(tb.silver_orders(spark, sf))


@query("year_month:s revenue_usd:d")
def monthly_revenue(spark, sf):
    """From the deliveries on: latest record per order, in USD, completed orders by month."""
    silver = conform_to_contract(tb.staged_orders(spark, sf), SILVER_ORDERS)
    return reports.monthly_revenue(reports.completed_orders(silver))


@query("customer_name:s revenue_usd:d")
def top_customers(spark, sf):
    return reports.top_customers(reports.completed_orders(tb.silver_orders(spark, sf)))


@query("region:s category:s revenue_usd:d")
def region_category_matrix(spark, sf):
    return reports.region_category_matrix(reports.completed_orders(tb.silver_orders(spark, sf)))


@query(
    "total_revenue_usd:d order_count:l customer_count:l product_count:l avg_order_value_usd:d first_date:a last_date:a"
)
def sales_totals(spark, sf):
    return reports.sales_totals(reports.completed_orders(tb.silver_orders(spark, sf)))


# Quality


@query(CHECKS)
def dq_core_checks(spark, sf):
    return quality.core_checks(tb.silver_orders(spark, sf))


@query(CHECKS)
def dq_contract_checks(spark, sf):
    return quality.contract_checks(cl.parse_types(tb.text_orders(spark, sf)), BRONZE_ORDERS)


@query("order_id:s ingestion_date:a row_count:l")
def dq_duplicate_keys(spark, sf):
    return quality.duplicate_keys(tb.bronze_orders(spark, sf), BRONZE_ORDERS.primary_key)


@query(CHECKS)
def dq_uniqueness(spark, sf):
    """Bronze and current silver rows against their primary keys."""
    bronze = quality.uniqueness_check(tb.bronze_orders(spark, sf), BRONZE_ORDERS)
    return bronze.unionByName(quality.uniqueness_check(tb.silver_versions(spark, sf), SILVER_ORDERS, "_is_current"))


@query(CHECKS)
def dq_dictionary(spark, sf):
    return quality.dictionary_checks(tb.silver_orders(spark, sf))


STRICT_ORDERS = TableContract(
    name="strict orders",
    schema=columns(
        ("order_id", STR, True, 9),
        ("order_date", DATE),
        ("quantity", MONEY),
        ("unit_price", MONEY),
        ("_is_deleted", BOOL),
    ),
)


@query("order_id:s order_date:a quantity:d unit_price:d conform_errors:s")
def strict_conform(spark, sf):
    rows = tb.text_orders(spark, sf).select("order_id", "order_date", "quantity", "unit_price", "_is_deleted")
    return conform_strict(rows, STRICT_ORDERS).withColumn("conform_errors", F.array_join("_conform_errors", ","))


# Run control


@query("pipeline_name:s watermark:t")
def control_last_watermark(spark, sf):
    return control.last_watermarks(tb.control_log(spark, sf))


@query("success_count:l")
def control_ready(spark, sf):
    return control.successes(tb.control_log(spark, sf), "transform_silver_sales", "2024-01-15")


@query(RUNS)
def control_recent_failures(spark, sf):
    return control.recent_failures(tb.control_log(spark, sf))


@query(RUNS)
def control_failures_since(spark, sf):
    return control.failures_since(tb.control_log(spark, sf), datetime(2024, 1, 20, 12))


@query(RUNS)
def control_repair(spark, sf):
    log = tb.control_log(spark, sf)
    return control.repair(log, "ingest_sales_orders", "2024-01-23", datetime(2024, 1, 22))


# Jobs


def _job_lake(spark: SparkSession, sf: str) -> Lake:
    """A lake after one full run of the silver and the gold job over all deliveries."""
    lake = Lake(f"{staging_root(spark)}/staged/lake-{uuid.uuid4().hex}")
    day = datetime.fromisoformat(tb.RATE_DATE).date()
    master = tb.master_data(spark, sf)
    silver.build_silver(spark, lake, tb.fx_rates(spark), day, tb.RUN_1, full_refresh=True, bronze=tb.bronze_orders(spark, sf))
    gold.build_gold(spark, lake, master, day, tb.RUN_1, full_refresh=True)
    return lake


@query(STAGED)
def job_silver_refresh(spark, sf):
    lake = Lake(f"{staging_root(spark)}/staged/lake-{uuid.uuid4().hex}")
    day = datetime.fromisoformat(tb.RATE_DATE).date()
    silver.build_silver(spark, lake, tb.fx_rates(spark), day, tb.RUN_1, full_refresh=True, bronze=tb.bronze_orders(spark, sf))
    return lake.silver_orders.read(spark)


@query(FACT)
def job_gold_refresh(spark, sf):
    return _job_lake(spark, sf).fact_orders.read(spark)


@query("pipeline_name:s status:s rows_processed:l run_date:t")
def job_run_log(spark, sf):
    """What the two jobs wrote into the run log."""
    return runlog.log(spark, _job_lake(spark, sf))


# Layout and envelopes


@query("tier:s ingestion_date:a row_count:l")
def retention_split(spark, sf):
    tiers = retention_tiers(tb.bronze_orders(spark, sf), datetime(2002, 12, 1).date(), hot_days=720, archive_years=5)
    first, *rest = [df.select(F.lit(t).alias("tier"), "ingestion_date") for t, df in tiers.items()]
    for df in rest:
        first = first.unionByName(df)
    return first.groupBy("tier", "ingestion_date").agg(F.count(F.lit(1)).alias("row_count"))


@query("ingestion_date:a row_count:l")
def archive_ledger(spark, sf):
    """What the archive holds by month after two runs some years apart; the second copies new months and drops old ones."""
    month = F.to_date(F.date_trunc("month", "ingestion_date"))
    rows = tb.bronze_orders(spark, sf).select(*STORED_ORDERS.names).withColumn("ingestion_date", month)
    table = SnapshotTable(f"{staging_root(spark)}/staged/archive-{uuid.uuid4().hex}", STORED_ORDERS.schema, ("ingestion_date",))
    for today in (date(2000, 12, 1), date(2002, 12, 1)):
        archive_dates(rows, table, today, hot_days=720, archive_years=5)
    return table.read(spark).groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "order_id:s order_date:a customer_id:s product_id:s quantity:d unit_price:d total_amount:d currency:s status:s region:s "
    "sales_rep_id:s _ingestion_ts:t _source_file:s _is_deleted:b ingestion_date:a"
)
def cluster_rewrite_orders(spark, sf):
    files = files_for(stored_bytes(tb.load(spark, sf, "lineitem")))
    return cluster_rewrite(tb.bronze_orders(spark, sf), CLUSTER_BY, files)


@query("product_id:s product_name:s category:s subcategory:s unit_price:d min_order_qty:l last_modified:a")
def catalog_explode(spark, sf):
    docs = tb.catalogue_documents(spark, sf).select(F.from_json("doc", CATALOGUE_JSON).alias("d")).select("d.*")
    return unpack_records(docs, "products")


@query("order_id:s quantity:l unit_price:d status:s reason:s")
def csv_quarantine(spark, sf):
    """Lines that read, and those that do not by the id they start with."""
    parsed = stage(read_csv_checked(spark, tb.orders_csv(spark, sf), ORDERS_CSV), "csv")
    clean, bad = split_corrupt(parsed)
    lines = bad.select(F.split_part("raw", F.lit(","), F.lit(1)).alias("order_id"), "reason")
    return clean.withColumn("reason", F.lit(None).cast("string")).unionByName(lines, allowMissingColumns=True)


@query("product_id:s unit_price:d reason:s")
def catalog_quarantine(spark, sf):
    """Products of documents that read; of the others the first product's id."""
    parsed = parse_json_checked(tb.cut_catalogue(spark, sf), "doc", CATALOGUE_JSON)
    clean, bad = split_corrupt(stage(parsed, "catalogue"))
    products = unpack_records(clean, "products").select("product_id", "unit_price", F.lit(None).cast("string").alias("reason"))
    first = F.regexp_extract("raw", '"product_id":"([^"]*)"', 1)
    return products.unionByName(bad.select(first.alias("product_id"), "reason"), allowMissingColumns=True)


@query("query:s pages:l records:l announced:l last_pages:l complete:b")
def crm_page_sets(spark, sf):
    docs = tb.crm_pages(spark, sf).select(F.from_json("doc", CRM_JSON).alias("d")).select("d.*")
    return page_sets(docs)


@query("Id:s LastModifiedDate:t Name:s")
def crm_merge_windows(spark, sf):
    """Two windows of seven days, three days apart: what the second adds."""
    accounts = _accounts(spark, sf)
    first, second = (recently_modified(accounts, datetime(2024, 1, d, 12)).where(f"LastModifiedDate <= '2024-01-{d} 12:00:00'") for d in (21, 24))
    return not_held(second, first, ["Id", "LastModifiedDate"])


@query("order_id:s ingestion_date:a quantity:d _source_file:s")
def bronze_landing(spark, sf):
    """Deliveries of two runs, the first of them repeated after a failed one."""
    rows = tb.bronze_orders(spark, sf).select(*STORED_ORDERS.names)
    table = Landing(f"{staging_root(spark)}/staged/landing-{uuid.uuid4().hex}", STORED_ORDERS.schema, ("_source_file",))
    early = F.col("ingestion_date") < "1998-06-01"
    checks = quality.contract_rules(BRONZE_ORDERS)
    for run, part in (("RUN-1", rows.where(early)), ("RUN-2", rows.where(~early)), ("RUN-1", rows.where(early))):
        table.append(part, run, checks)
    try:
        table.append(rows.withColumn("quantity", -F.col("quantity")), "RUN-3", checks)
    except quality.DataQualityError:
        return table.read(spark)
    raise AssertionError("negative quantities passed the gate")


@query("check_name:s passed:b failed_rows:l total_rows:l detail:s")
def dq_observed(spark, sf):
    """The contract's checks out of counts that were observed while the rows were written."""
    rows, checks, counts = cl.parse_types(tb.text_orders(spark, sf)), quality.contract_rules(BRONZE_ORDERS), Observation()
    stage(rows.observe(counts, *quality.counts_of(checks)), "observed")
    found = quality.outcomes(counts.get, checks)[1:]
    return spark.createDataFrame([dataclasses.astuple(o) for o in found], "check_name string, passed boolean, failed_rows long, total_rows long, detail string")


def _accounts(spark, sf):
    docs = tb.crm_responses(spark, sf).select(F.from_json("doc", CRM_JSON).alias("d")).select("d.*")
    return crm_accounts(docs)


CRM = "record_type:s record_url:s Id:s Name:s Industry:s AnnualRevenue:d LastModifiedDate:t"


@query(CRM)
def crm_explode(spark, sf):
    return _accounts(spark, sf)


@query(CRM)
def crm_recent(spark, sf):
    return recently_modified(_accounts(spark, sf), datetime(2024, 1, 24, 12))
