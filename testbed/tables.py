"""Maps the sample tables (lineitem, orders, customer, ...) to order deliveries and master data."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyworks.contracts import CREDIT, MONEY, SILVER_ORDERS, conform_to_contract
from tallyworks.functions import new_run_id
from tallyworks.operators import late, scd2, star
from tallyworks.plans.gold import MasterData
from tallyworks.plans.lake import STORED_SILVER
from tallyworks.plans.silver import stage_orders
from tallyworks.sources.files import ORDERS_CSV
from tallyworks.session import folder_exists, spread_if_few, stage, staging_root, use_utc, write_and_read

RATE_DATE = "2002-01-01"
RUN_1 = datetime(2002, 1, 1, 4)
RUN_2 = datetime(2002, 1, 2, 4)
BATCH_CUT = "1998-06-01"
# Three batches, the middle one of which is run last.
LATE_CUTS = ("1997-01-01", "1999-01-01")
LATE_RUNS = (datetime(1997, 1, 1, 4), datetime(2003, 1, 2, 4), datetime(2003, 1, 1, 4))


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def currency_of(nation_key: str) -> Column:
    k = F.col(nation_key) % 5
    return (
        F.when(k == 0, "USD").when(k == 1, "EUR").when(k == 2, "GBP").when(k == 3, "CAD").otherwise("JPY")
    )


def region_of(name: str) -> Column:
    r = F.col(name)
    return F.when(r == "AMERICA", "AMER").when(r.isin("EUROPE", "AFRICA"), "EMEA").when(r == "ASIA", "APAC")


def raw_status() -> Column:
    return (
        F.when(F.col("l_suppkey") % 50 == 0, "??")
        .when(F.col("l_returnflag") == "R", "REFD")
        .when(F.col("o_orderstatus") == "F", " comp ")
        .when(F.col("o_orderstatus") == "O", "PEND")
        .otherwise("x")
    )


_paths: dict[tuple[str, str, str], str] = {}
_built: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def built_once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A layer the queries start from, written to the shared folder on first use in an application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path, df = _built.get(key, (None, None))
    if df is None or not folder_exists(spark, path):
        path = f"{staging_root(spark)}/layers/{name}-{uuid.uuid4().hex}"
        df = write_and_read(build(), path)
        _built[key] = path, df
    return df


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built_once(spark, sf_dir, "bronze", lambda: derive_bronze(spark, sf_dir))


def derive_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as one delivery of an order; line keys repeat, so orders are redelivered.

    The line items are shuffled for their parts while they are narrow, then for their orders, which have met their customers
    by then. So the deliveries of an order lie together.
    """
    money = {c: F.col(c).cast(MONEY) for c in ("l_quantity", "l_extendedprice")}  # shorter than doubles once compressed
    part = load(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast(MONEY).alias("p_retailprice"))
    lines = spread_if_few(load(spark, sf_dir, "lineitem")).withColumns(money).join(part, F.col("l_partkey") == F.col("p_partkey"))
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    bought = load(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = (
        lines.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.concat(F.lit("ORD-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.concat(F.lit("CUST-"), F.col("o_custkey")).alias("customer_id"),
        F.concat(F.lit("PROD-"), F.col("l_partkey")).alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        currency_of("n_nationkey").alias("currency"),
        raw_status().alias("status"),
        region_of("r_name").alias("region"),
        F.when(F.col("l_suppkey") % 10 != 0, F.concat(F.lit("REP-"), F.col("l_suppkey"))).alias("sales_rep_id"),
        F.col("l_shipdate").cast("timestamp").alias("_ingestion_ts"),
        F.concat(F.lit("BATCH-"), F.date_format("l_shipdate", "yyyyMM")).alias("_source_file"),
        F.lit(False).alias("_is_deleted"),
        F.to_date("l_shipdate").alias("ingestion_date"),
    )


def text_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as text, some of it unreadable: what a loosely typed source sends."""
    n = F.split_part("order_id", F.lit("-"), F.lit(2)).cast("long")
    day = F.date_format("order_date", "yyyy-MM-dd")
    return bronze_orders(spark, sf_dir).withColumns(
        {
            "order_date": F.when(n % 41 == 0, "2024-13-01")
            .when(n % 43 == 0, F.concat(day, F.lit(" 10:00:00")))
            .otherwise(day),
            "quantity": F.when(n % 37 == 0, "n/a").otherwise(F.col("quantity").cast("string")),
            "unit_price": F.when(n % 31 == 0, F.concat(F.col("unit_price").cast("string"), F.lit("56")))
            .otherwise(F.col("unit_price").cast("string")),
            "total_amount": F.col("total_amount").cast("string"),
            "customer_id": F.when(n % 47 != 0, F.col("customer_id")),
        }
    )


def fx_rates(spark: SparkSession) -> DataFrame:
    """Rates of two days; one of them lists USD as well."""
    return spark.sql(
        f"""SELECT cast(d AS date) AS rate_date, c AS from_currency, r AS rate_to_usd FROM VALUES
            ('{RATE_DATE}', 'EUR', 1.085), ('{RATE_DATE}', 'GBP', 1.270), ('{RATE_DATE}', 'CAD', 0.741),
            ('{RATE_DATE}', 'USD', 1.0), ('2001-12-31', 'EUR', 1.5) AS t(d, c, r)"""
    )


def staged_orders(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """All deliveries as one staged silver batch."""
    return stage_orders(bronze_orders(spark, sf_dir), fx_rates(spark), RATE_DATE, RUN_1, **kw)


def enriched_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged batch with the names from the dimensions."""
    customer, product, _ = dimensions(spark, sf_dir)
    staged = staged_orders(spark, sf_dir, enrich=lambda df: star.enrich_orders(df, customer, product))
    return conform_to_contract(staged, SILVER_ORDERS)


def silver_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two staged batches: before the cut, and after it together with all earlier non-AMER deliveries.

    Like the job's, they have the columns that silver stores, and carry no others through their merge.
    """
    bronze = bronze_orders(spark, sf_dir)
    cut = F.lit(BATCH_CUT).cast("timestamp")
    again = F.coalesce(F.col("region") != "AMER", F.lit(True))
    first = bronze.where(F.col("_ingestion_ts") < cut)
    second = bronze.where((F.col("_ingestion_ts") >= cut) | again)
    rates = fx_rates(spark)
    staged = stage_orders(first, rates, RATE_DATE, RUN_1), stage_orders(second, rates, RATE_DATE, RUN_2)
    return conform_to_contract(staged[0], STORED_SILVER), conform_to_contract(staged[1], STORED_SILVER)


def merged_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = silver_batches(spark, sf_dir)
    return scd2.merge(first, second, RUN_2)


def late_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Staged batches of before, between and after the cuts; those in between know when they were delivered next."""
    bronze, rates = bronze_orders(spark, sf_dir), fx_rates(spark)
    t, (lo, hi) = F.col("_ingestion_ts"), [F.lit(c).cast("timestamp") for c in LATE_CUTS]
    cuts = (bronze.where(t < lo), bronze.where((t >= lo) & (t < hi)), bronze.where(t >= hi))
    batches = [stage_orders(b, rates, RATE_DATE, run) for b, run in zip(cuts, LATE_RUNS, strict=True)]
    early, between, after = [conform_to_contract(b, STORED_SILVER) for b in batches]
    return early, late.with_next_delivery(between, cuts[2].withColumn("batch", F.lit(3)), batch="batch"), after


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        load(spark, sf_dir, "customer")
        .join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return rows.select(
        F.concat(F.lit("CUST-"), F.col("c_custkey")).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("c_acctbal") > 5000, "Enterprise").otherwise("Standard").alias("account_type"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("CITY-"), F.col("c_custkey") % 100).alias("city"),
        region_of("r_name").alias("region"),
        F.concat(F.lit("c"), F.col("c_custkey"), F.lit("@mail.example")).alias("email"),
        F.lit(None).cast("string").alias("account_manager_id"),
        F.col("c_acctbal").cast(CREDIT).alias("credit_limit"),
        currency_of("n_nationkey").alias("currency"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def customer_deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A first customer delivery, and a later one with new customers and changed industries."""
    rows = customers(spark, sf_dir)
    renamed = F.when(F.col("industry") == "BUILDING", "CONSTRUCTION").otherwise(F.col("industry"))
    return rows.where("credit_limit < 8000"), rows.withColumn("industry", renamed)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("p_retailprice").cast(MONEY)
    return load(spark, sf_dir, "part").select(
        F.concat(F.lit("PROD-"), F.col("p_partkey")).alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        price.alias("unit_price"),
        F.round(price * F.lit(0.6).cast("decimal(2,1)"), 4).cast(MONEY).alias("cost_price"),
        F.lit("USD").alias("currency"),
        F.lit("EA").alias("uom"),
        F.lit(None).cast("string").alias("supplier_id"),
        F.lit(True).alias("is_active"),
    )


def representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = load(spark, sf_dir, "nation")
    return load(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("REP-"), F.col("s_suppkey")).alias("employee_id"),
        F.col("s_name").alias("full_name"),
        F.col("n_name").alias("team"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customer, product and employee dimension after one load."""
    parts = [
        ("customers", star.dim_customer, customers),
        ("products", star.dim_product, products),
        ("employees", star.dim_employee, representatives),
    ]
    c, p, e = [built_once(spark, sf_dir, n, lambda b=b, f=f: b(f(spark, sf_dir), RUN_1)) for n, b, f in parts]
    return c, p, e


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table after one load of all deliveries, with the names from the dimensions."""
    return built_once(spark, sf_dir, "silver", lambda: enriched_orders(spark, sf_dir))


def silver_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table after both batches, history included."""
    return built_once(spark, sf_dir, "versions", lambda: merged_silver(spark, sf_dir))


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        resolved = star.resolve_keys(silver_orders(spark, sf_dir), *dimensions(spark, sf_dir))
        return star.fact_orders(resolved, RUN_1, new_run_id(RUN_1), store=lambda df: stage(df, "resolved"))

    return built_once(spark, sf_dir, "fact", build)


def early_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as it stood after the first batch."""

    def build() -> DataFrame:
        resolved = star.resolve_keys(silver_batches(spark, sf_dir)[0], *dimensions(spark, sf_dir))
        return star.fact_orders(resolved, RUN_1, "RUN-1", store=lambda df: stage(df, "resolved"))

    return built_once(spark, sf_dir, "early_fact", build)


def build_layers(spark: SparkSession, sf_dir: str) -> None:
    """Store everything the queries start from."""
    for layer in (silver_orders, silver_versions, fact_orders, early_fact):
        layer(spark, sf_dir)


def master_data(spark: SparkSession, sf_dir: str) -> MasterData:
    return MasterData(customers(spark, sf_dir), products(spark, sf_dir), representatives(spark, sf_dir))


def entitlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One principal per nation, entitled to the sales region the nation lies in."""
    places = load(spark, sf_dir, "nation").join(
        load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return places.select(
        F.col("n_name").alias("principal"), F.coalesce(region_of("r_name"), F.lit("UNKNOWN")).alias("region")
    )


def control_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream read as pipeline runs: errors failed, views are still running."""
    k, kind = F.col("user_id") % 4, F.col("event_type")
    return load(spark, sf_dir, "events").select(
        F.when(k == 0, "ingest_sales_orders")
        .when(k == 1, "ingest_crm_accounts")
        .when(k == 2, "transform_silver_sales")
        .otherwise("transform_gold_sales_summary")
        .alias("pipeline_name"),
        F.concat(F.lit("RUN-"), F.col("event_id")).alias("run_id"),
        F.when(kind == "error", "FAILED").when(kind == "view", "RUNNING").otherwise("SUCCESS").alias("status"),
        F.floor("value").cast("long").alias("rows_processed"),
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("last_watermark"),
        F.col("ts").cast("timestamp").alias("run_date"),
        F.when(kind == "error", F.concat(F.lit("failed with "), F.col("props"))).alias("error_message"),
    )


def catalogue_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product catalogue documents as JSON text, one per part, listing the part and its refurbished twin."""
    part = load(spark, sf_dir, "part")

    def item(suffix: str, price: Column) -> Column:
        return F.struct(
            F.concat(F.lit("PROD-"), F.col("p_partkey"), F.lit(suffix)).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("subcategory"),
            price.alias("unit_price"),
            F.col("p_size").alias("min_order_qty"),
            F.lit("2024-01-10").alias("last_modified"),
        )

    items = F.array(item("", F.col("p_retailprice")), item("-R", F.col("p_retailprice") / 2))
    return part.select(F.to_json(F.struct(F.lit("1.2").alias("schema_version"), items.alias("products"))).alias("doc"))


def orders_csv(spark: SparkSession, sf_dir: str) -> str:
    """A folder of CSV files with all deliveries, some of whose quantities do not read."""

    def write() -> str:
        n = F.split_part("order_id", F.lit("-"), F.lit(2)).cast("long")
        quantity = F.col("quantity").cast("int").cast("string")
        rows = bronze_orders(spark, sf_dir).withColumn("quantity", F.when(n % 37 == 0, F.concat(quantity, F.lit("x"))).otherwise(quantity))
        path = f"{staging_root(spark)}/layers/csv-{uuid.uuid4().hex}"
        have = [F.col(c) if c in rows.columns else F.lit(None) for c in ORDERS_CSV.names]
        texts = [c.cast("string").alias(n) for c, n in zip(have, ORDERS_CSV.names, strict=True)]
        as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.select(*texts).write.options(header=True, **as_is).csv(path)
        return path

    key = (spark.sparkContext.applicationId, sf_dir, "csv")
    if key not in _paths or not folder_exists(spark, _paths[key]):
        _paths[key] = write()
    return _paths[key]


def cut_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue documents; those of every seventeenth part break off."""
    docs = catalogue_documents(spark, sf_dir)
    broken = F.regexp_extract("doc", "PROD-([0-9]+)", 1).cast("long") % 17 == 0
    return docs.select(F.when(broken, F.substring("doc", F.lit(1), F.length("doc") - 5)).otherwise(F.col("doc")).alias("doc"))


def crm_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses of up to ten accounts in pages of up to four; each thirteenth response lacks its last page."""
    c = F.col("c_custkey")
    accounts = load(spark, sf_dir, "customer").select(
        F.floor(c / 10).alias("response"), F.floor((c % 10) / 4).alias("page"),
        F.struct(F.concat(F.lit("A"), c).alias("Id"), F.col("c_name").alias("Name")).alias("record"),
    )
    pages = accounts.groupBy("response", "page").agg(F.collect_list("record").alias("records"))
    size = F.sum(F.size("records")).over(Window.partitionBy("response"))
    last = F.max("page").over(Window.partitionBy("response")) == F.col("page")
    marked = pages.withColumns({"total_size": size.cast("int"), "done": last})
    sent = marked.where(~F.col("done") | (F.col("response") % 13 != 0))
    query = F.concat(F.lit("accounts "), F.col("response").cast("string"))
    return sent.select(F.to_json(F.struct(F.lit("v9").alias("api_version"), query.alias("query"), "total_size", "done", "records")).alias("doc"))


def crm_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM responses as JSON text, one per customer; change times spread over January 2024."""
    day = F.lpad((F.col("c_custkey") % 31 + 1).cast("string"), 2, "0")
    record = F.struct(
        F.struct(
            F.lit("Account").alias("type"), F.concat(F.lit("/Account/"), F.col("c_custkey")).alias("url")
        ).alias("attributes"),
        F.concat(F.lit("A"), F.col("c_custkey")).alias("Id"),
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Industry"),
        F.col("c_acctbal").alias("AnnualRevenue"),
        F.concat(F.lit("2024-01-"), day, F.lit("T08:30:00.000+0000")).alias("LastModifiedDate"),
    )
    envelope = F.struct(F.lit(True).alias("done"), F.lit(1).alias("total_size"), F.array(record).alias("records"))
    return load(spark, sf_dir, "customer").select(F.to_json(envelope).alias("doc"))
