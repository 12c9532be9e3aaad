"""Reporting views and the analysis pack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.contracts import MONEY
from tallyworks.functions import margin_percent, year_month, year_quarter
from tallyworks.operators.summary import not_cancelled
from tallyworks.session import broadcast_if_small


def sales_overview(fact: DataFrame, customers: DataFrame, products: DataFrame, employees: DataFrame) -> DataFrame:
    """The published sales view: orders that are not cancelled, with their current dimension rows.

    Each dimension is cut to its current rows before the join, so an order whose representative has
    no current row keeps its place with nulls. Orders without one get a spread key, which matches
    nothing, as keys count from 1: they would all meet in one partition.
    """
    c = customers.where("is_current").select(
        "customer_sk", "customer_id", "customer_name", "industry", "country", "account_type"
    )
    p = products.where("is_current").select("product_sk", "product_id", "product_name", "category", "subcategory")
    e = employees.where("is_current").select(
        F.col("employee_sk").alias("_rep_key"),
        F.col("full_name").alias("sales_rep_name"),
        F.col("team").alias("sales_team"),
    )
    spread = -1 - F.pmod(F.xxhash64("order_id"), F.lit(1024))
    orders = not_cancelled(fact).withColumn("_rep_key", F.coalesce("sales_rep_sk", spread))
    joined = orders.join(c, "customer_sk").join(p, "product_sk").join(e, "_rep_key", "left")
    return joined.select(
        "order_date",
        F.year("order_date").alias("order_year"),
        year_month("order_date").alias("year_month"),
        year_quarter("order_date").alias("year_quarter"),
        "customer_id",
        "customer_name",
        "industry",
        "country",
        "account_type",
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "region",
        "sales_rep_name",
        "sales_team",
        "order_id",
        "status",
        "quantity",
        "unit_price_usd",
        F.col("total_amount_usd").alias("revenue_usd"),
        "cost_amount_usd",
        "gross_margin_usd",
        margin_percent("gross_margin_usd", "total_amount_usd").alias("gross_margin_pct"),
        "original_currency",
        "fx_rate_to_usd",
    )


def secured(view: DataFrame, entitlements: DataFrame, principal: str) -> DataFrame:
    """The rows of ``view`` in regions that ``principal`` is entitled to (principal, region)."""
    mine = entitlements.where(F.col("principal") == principal).select("region").distinct()
    return view.join(broadcast_if_small(mine), "region", "left_semi").select(*view.columns)


def completed_orders(silver: DataFrame) -> DataFrame:
    """Current, completed orders with the columns the analysis reports use."""
    return silver.where("_is_current AND status = 'Completed'").select(
        "order_id",
        "order_date",
        "order_year",
        "order_month",
        "customer_id",
        "customer_name",
        "product_id",
        "product_name",
        "category",
        "region",
        "sales_rep_id",
        "quantity",
        "unit_price_usd",
        "total_amount_usd",
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    months = orders.groupBy(year_month("order_date").alias("year_month"))
    return months.agg(F.sum("total_amount_usd").alias("revenue_usd")).orderBy("year_month")


def top_customers(orders: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` customers with the highest revenue; equal revenue goes by name."""
    totals = orders.where("customer_name IS NOT NULL").groupBy("customer_name")
    ranked = totals.agg(F.sum("total_amount_usd").alias("revenue_usd"))
    return ranked.orderBy(F.desc("revenue_usd"), "customer_name").limit(n)


def region_category_matrix(orders: DataFrame) -> DataFrame:
    """Revenue per region and category that have orders, one row each; any number of categories, none left out."""
    known = orders.where("region IS NOT NULL AND category IS NOT NULL")
    return known.groupBy("region", "category").agg(F.sum("total_amount_usd").alias("revenue_usd"))


def category_columns(matrix: DataFrame, categories: Sequence[str]) -> DataFrame:
    """The matrix as a table: regions as rows, the given categories as columns, 0 where there is no revenue.

    A view for display. What other categories earned is the column ``other_categories``.
    """
    named = F.when(F.col("category").isin(list(categories)), F.col("category")).otherwise("other_categories")
    columns = [*categories, "other_categories"]
    return matrix.withColumn("category", named).groupBy("region").pivot("category", columns).agg(F.sum("revenue_usd")).fillna(0)


def sales_totals(orders: DataFrame) -> DataFrame:
    """One row: revenue, orders, customers, products, mean order value and the date range."""
    return orders.agg(
        F.sum("total_amount_usd").alias("total_revenue_usd"),
        F.count(F.lit(1)).alias("order_count"),
        F.countDistinct("customer_id").alias("customer_count"),
        F.countDistinct("product_id").alias("product_count"),
        F.avg("total_amount_usd").cast(MONEY).alias("avg_order_value_usd"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
    )


def analysis_pack(silver: DataFrame) -> dict[str, DataFrame]:
    """All analysis reports over the completed orders."""
    orders = completed_orders(silver)
    return {
        "monthly_revenue": monthly_revenue(orders),
        "top_customers": top_customers(orders),
        "region_category_matrix": region_category_matrix(orders),
        "sales_totals": sales_totals(orders),
    }
