"""Typing, defaulting and filtering of raw sales orders."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks.contracts import MONEY
from tallyworks.functions import iso_date, standardise_status

AMOUNTS = ("quantity", "unit_price", "total_amount")
REQUIRED = ("order_id", "order_date", "customer_id", "product_id")
DEFAULTS = {"region": "UNKNOWN", "sales_rep_id": "UNASSIGNED"}


def parse_types(df: DataFrame, date_col: str = "order_date", amounts: Sequence[str] = AMOUNTS) -> DataFrame:
    """Dates from ``yyyy-MM-dd`` text and amounts as DECIMAL(18,4); unreadable text becomes null."""
    parsed = (
        iso_date(date_col)
        if isinstance(df.schema[date_col].dataType, T.StringType)
        else F.col(date_col).cast("date")
    )
    return df.withColumns({date_col: parsed, **{c: F.col(c).try_cast(MONEY) for c in amounts}})


def with_status(df: DataFrame, rule: Callable[[Column], Column] = standardise_status) -> DataFrame:
    return df.withColumn("status", rule(F.col("status")))


def with_date_parts(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    return df.withColumns({"order_year": F.year(date_col), "order_month": F.month(date_col)})


def fill_defaults(df: DataFrame, defaults: Mapping[str, str] = DEFAULTS) -> DataFrame:
    """Fill nulls of the named string columns; absent and non-string columns are left alone."""
    usable = {
        c: v
        for c, v in defaults.items()
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)
    }
    return df.fillna(usable) if usable else df


def require_not_null(
    df: DataFrame, cols: Sequence[str] = REQUIRED, counts: Observation | None = None
) -> DataFrame:
    """Drop rows with a null in ``cols``. ``counts`` receives rows_in and rows_dropped as the plan runs."""
    if counts is not None:
        missing = F.lit(False)
        for c in cols:
            missing = missing | F.col(c).isNull()
        df = df.observe(
            counts, F.count(F.lit(1)).alias("rows_in"), F.count_if(missing).alias("rows_dropped")
        )
    return df.dropna(subset=list(cols))


def cleanse(
    df: DataFrame,
    status_rule: Callable[[Column], Column] = standardise_status,
    required: Sequence[str] = REQUIRED,
    defaults: Mapping[str, str] = DEFAULTS,
    counts: Observation | None = None,
) -> DataFrame:
    """Raw orders to typed, defaulted orders that have all required fields."""
    typed = with_date_parts(with_status(parse_types(df), status_rule))
    return require_not_null(fill_defaults(typed, defaults), required, counts)
