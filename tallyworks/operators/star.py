"""Dimensions and the order fact of the gold layer."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.contracts import (
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_EMPLOYEE,
    DIM_PRODUCT,
    FACT_ORDERS,
    MONEY,
    TableContract,
    conform_to_contract,
)
from tallyworks.functions import date_key, year_month
from tallyworks.operators.keys import assign_surrogate_keys
from tallyworks.operators.latest import latest_per_key
from tallyworks.operators.scd2 import DIM_HISTORY, classify, next_rows, stage, utc_literal

UNASSIGNED = "UNASSIGNED"


def build_dimension(
    source: DataFrame,
    contract: TableContract,
    run_ts: datetime,
    existing: DataFrame | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
    last_key: int | None = None,
) -> DataFrame:
    """Merge unique source rows into a Type 2 dimension; every new version gets a fresh key.

    The contract's first column is the surrogate key and its second the business key; the columns up
    to ``valid_from`` are the tracked attributes. ``store`` may write intermediate rows to a table;
    ``last_key`` is the highest key given so far, where it is known.
    """
    sk, business_key = contract.names[:2]
    attributes = contract.names[2 : contract.names.index("valid_from")]
    typed = conform_to_contract(source, contract).select(business_key, *attributes)
    staged = stage(typed, run_ts, attributes, DIM_HISTORY).withColumn("created_ts", utc_literal(run_ts))
    if existing is None:
        return conform_to_contract(assign_surrogate_keys(store(staged), sk, [business_key]), contract)
    tagged = store(classify(existing, staged, [business_key], DIM_HISTORY))
    carried = next_rows(tagged.where("_action IN ('keep', 'expire')"), run_ts, DIM_HISTORY)
    inserted = next_rows(tagged.where("_action = 'insert'"), run_ts, DIM_HISTORY)
    numbered = assign_surrogate_keys(inserted, sk, [business_key], existing, last_key=last_key)
    parts = [existing.where(~F.col("is_current")), carried, numbered]
    first, *rest = [conform_to_contract(p, contract) for p in parts]
    for part in rest:
        first = first.unionByName(part)
    return first


def dim_customer(customers, run_ts, existing=None, **kw) -> DataFrame:
    """Customer master to dim.customer; of several records of a customer the last modified counts."""
    one = _one_record(customers, "customer_id", "last_modified_date")
    return build_dimension(one.withColumn("is_active", F.coalesce("is_active", F.lit(True))), DIM_CUSTOMER, run_ts,
                           existing, **kw)


def dim_product(products, run_ts, existing=None, **kw) -> DataFrame:
    """Product catalogue rows to dim.product."""
    return build_dimension(_one_record(products, "product_id", "last_modified"), DIM_PRODUCT, run_ts, existing, **kw)


def dim_employee(reps: DataFrame, run_ts: datetime, existing: DataFrame | None = None, **kw) -> DataFrame:
    """Distinct sales representatives (employee_id, full_name, team) to dim.employee."""
    named = reps.where(F.col("employee_id").isNotNull() & (F.col("employee_id") != UNASSIGNED))
    # One whole record per representative; partial aggregation leaves at most one in each map task.
    record = F.max(F.struct("full_name", "team"))
    one = named.groupBy("employee_id").agg(record.alias("r")).select("employee_id", "r.*")
    return build_dimension(one, DIM_EMPLOYEE, run_ts, existing, **kw)


def _one_record(df: DataFrame, key: str, modified: str) -> DataFrame:
    """One record of each key, the last modified (or the greatest, where no time is given); rows without a key are
    left out, see ``without_key``."""
    order = ([modified] if modified in df.columns else []) + [c for c in df.columns if c not in (key, modified)]
    if not order:
        return df.where(F.col(key).isNotNull()).distinct()
    return latest_per_key(df.where(F.col(key).isNotNull()), key, order[0], order[1:])


def without_key(df: DataFrame, key: str) -> DataFrame:
    """The master rows that no dimension can take, to be counted or set aside."""
    return df.where(F.col(key).isNull())


def dim_date(dates: DataFrame, date_col: str = "order_date") -> DataFrame:
    """One row per calendar day between the first and the last date of ``dates``."""
    span = dates.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).where("lo IS NOT NULL")
    days = span.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date"))
    full = days.select(
        date_key("date").alias("date_sk"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        year_month("date").alias("year_month"),
    )
    return conform_to_contract(full, DIM_DATE)


def enrich_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Fill customer_name, product_name and category from the current dimension rows when absent."""
    c = customers.where("is_current").select("customer_id", F.col("customer_name").alias("_customer_name"))
    p = products.where("is_current").select(
        "product_id", F.col("product_name").alias("_product_name"), F.col("category").alias("_category")
    )
    joined = orders.join(c, "customer_id", "left").join(p, "product_id", "left")
    filled = {
        name: F.coalesce(F.col(name), F.col(f"_{name}")) if name in orders.columns else F.col(f"_{name}")
        for name in ("customer_name", "product_name", "category")
    }
    return joined.withColumns(filled).drop("_customer_name", "_product_name", "_category")


def resolve_keys(orders: DataFrame, customers: DataFrame, products: DataFrame, employees: DataFrame) -> DataFrame:
    """Add customer_sk, product_sk, sales_rep_sk, date_sk and the product's cost to every order.

    Sizes decide the join strategy at run time; in a shuffle join AQE splits the partitions of
    heavy customers and products. Orders without a representative would all meet in one partition,
    so their key is spread: it cannot match anyway.
    """
    c = customers.where("is_current").select("customer_id", "customer_sk")
    p = products.where("is_current").select("product_id", "product_sk", F.col("cost_price").alias("_cost_price"))
    e = employees.where("is_current").select(
        F.col("employee_id").alias("_rep_key"), F.col("employee_sk").alias("sales_rep_sk")
    )
    nobody = F.col("sales_rep_id").isNull() | (F.col("sales_rep_id") == UNASSIGNED)
    spread = F.concat(F.lit(UNASSIGNED + "#"), F.pmod(F.xxhash64("order_id"), F.lit(1024)).cast("string"))
    return (
        orders.join(c, "customer_id", "left")
        .join(p, "product_id", "left")
        .withColumn("_rep_key", F.when(nobody, spread).otherwise(F.col("sales_rep_id")))
        .join(e, "_rep_key", "left")
        .drop("_rep_key")
        .withColumn("date_sk", date_key("order_date"))
    )


def unresolved_orders(resolved: DataFrame) -> DataFrame:
    """Orders whose customer or product has no current dimension row; kept aside, never dropped silently."""
    missing = F.array_compact(
        F.array(
            F.when(F.col("customer_sk").isNull(), F.lit("customer_id")),
            F.when(F.col("product_sk").isNull(), F.lit("product_id")),
        )
    )
    lost = resolved.where("customer_sk IS NULL OR product_sk IS NULL")
    return lost.withColumn("unresolved", F.array_join(missing, ","))


def fact_rows(resolved: DataFrame, run_ts: datetime, run_id: str | None = None) -> DataFrame:
    """Fact rows of the resolved orders, still without their own surrogate key."""
    cost = F.round(F.col("quantity") * F.col("_cost_price"), 4).cast(MONEY)
    return (
        resolved.where("customer_sk IS NOT NULL AND product_sk IS NOT NULL")
        .withColumn("cost_amount_usd", cost)
        .withColumns(
            {
                "gross_margin_usd": (F.col("total_amount_usd") - F.col("cost_amount_usd")).cast(MONEY),
                "created_ts": utc_literal(run_ts),
                "updated_ts": utc_literal(run_ts),
                "pipeline_run_id": F.lit(run_id).cast("string"),
            }
        )
        .select(*[c for c in FACT_ORDERS.names if c != "sales_order_sk"])
    )


def fact_orders(
    resolved: DataFrame,
    run_ts: datetime,
    run_id: str | None = None,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The whole fact table from resolved orders; ``store`` writes the rows that numbering reads twice."""
    return number_facts(store(fact_rows(resolved, run_ts, run_id)))


def number_facts(rows: DataFrame) -> DataFrame:
    return conform_to_contract(assign_surrogate_keys(rows, "sales_order_sk", ["order_id"]), FACT_ORDERS)


def upsert_fact(
    existing: DataFrame,
    rows: DataFrame,
    store: Callable[[DataFrame], DataFrame] = lambda df: df,
    last_key: int | None = None,
) -> DataFrame:
    """Replace facts by order_id: known orders keep their key and creation time, new ones are numbered.

    One full outer join: ``existing`` is read and shuffled once. ``store`` writes what it gives, since numbering reads the
    new orders twice. ``last_key`` is the highest key of the table that ``existing`` is a part of; without it the
    highest of ``existing`` counts.
    """
    columns = FACT_ORDERS.names
    fresh_columns = [c for c in columns if c != "sales_order_sk"]
    old = existing.select(F.col("order_id").alias("_old_id"), F.struct(*columns).alias("_old"))
    new = rows.select(F.col("order_id").alias("_new_id"), F.struct(*fresh_columns).alias("_new"))
    came = F.col("_new_id").isNotNull()
    values = {c: F.when(came, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")) for c in fresh_columns}
    values["created_ts"] = F.coalesce("_old.created_ts", "_new.created_ts")
    values["sales_order_sk"] = F.col("_old.sales_order_sk")
    merged = store(old.join(new, F.col("_old_id") == F.col("_new_id"), "full").select(*[values[c].alias(c) for c in columns]))
    known, fresh = merged.where("sales_order_sk IS NOT NULL"), merged.where("sales_order_sk IS NULL")
    numbered = assign_surrogate_keys(fresh, "sales_order_sk", ["order_id"], known, last_key=last_key)
    return conform_to_contract(known, FACT_ORDERS).unionByName(conform_to_contract(numbered, FACT_ORDERS))


def upsert_by_key(existing: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain key replacement: incoming rows win, other existing rows stay."""
    return existing.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows)
