"""Declared table contracts: columns, keys, layout and data rules of every layer."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STR, DATE, TS, BOOL = T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType()
INT, SHORT, LONG, DOUBLE = T.IntegerType(), T.ShortType(), T.LongType(), T.DoubleType()
MONEY, RATE, CREDIT = T.DecimalType(18, 4), T.DecimalType(18, 6), T.DecimalType(18, 2)


def columns(*specs: tuple) -> T.StructType:
    """Build a schema from (name, type[, nullable[, max_length]]) tuples."""
    fields = []
    for name, dtype, *rest in specs:
        nullable = rest[0] if rest else True
        meta = {"max_length": rest[1]} if len(rest) > 1 else {}
        fields.append(T.StructField(name, dtype, nullable, meta))
    return T.StructType(fields)


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    row_checks: dict[str, str] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return self.schema.names


# The published table layouts, column for column.
BRONZE_ORDERS = TableContract(
    name="bronze.sales_orders_raw",
    schema=columns(
        ("order_id", STR, False),
        ("order_date", DATE),
        ("customer_id", STR),
        ("product_id", STR),
        ("quantity", MONEY),
        ("unit_price", MONEY),
        ("total_amount", MONEY),
        ("currency", STR),
        ("status", STR),
        ("region", STR),
        ("_ingestion_ts", TS, False),
        ("_source_file", STR),
        ("_is_deleted", BOOL, False),
        ("ingestion_date", DATE, False),
    ),
    primary_key=("order_id", "ingestion_date"),
    partition_by=("ingestion_date",),
    not_null=("order_id", "ingestion_date"),
    row_checks={"quantity": "quantity > 0", "total_amount": "total_amount >= 0"},
)

SILVER_ORDERS = TableContract(
    name="silver.sales_orders_cleansed",
    schema=columns(
        ("order_id", STR, False),
        ("order_date", DATE, False),
        ("order_year", INT, False),
        ("order_month", INT, False),
        ("customer_id", STR, False),
        ("customer_name", STR),
        ("product_id", STR, False),
        ("product_name", STR),
        ("category", STR),
        ("quantity", MONEY, False),
        ("unit_price_usd", MONEY, False),
        ("total_amount_usd", MONEY, False),
        ("original_currency", STR),
        ("fx_rate_to_usd", RATE),
        ("status", STR, False),
        ("region", STR),
        ("sales_rep_id", STR),
        ("_valid_from", TS, False),
        ("_valid_to", TS),
        ("_is_current", BOOL, False),
        ("_updated_ts", TS, False),
        ("_source_hash", STR, False),
    ),
    primary_key=("order_id",),
    partition_by=("order_year", "order_month"),
    not_null=("order_id", "order_date", "customer_id", "product_id", "quantity", "unit_price_usd"),
    row_checks={
        "quantity": "quantity > 0",
        "unit_price_usd": "unit_price_usd >= 0",
        "total_amount_usd": "total_amount_usd >= 0",
        "status": "status IN ('Completed', 'Pending', 'Cancelled', 'Refunded')",
    },
)

DIM_CUSTOMER = TableContract(
    name="dim.customer",
    schema=columns(
        ("customer_sk", LONG, False),
        ("customer_id", STR, False, 20),
        ("customer_name", STR, False, 200),
        ("account_type", STR, True, 50),
        ("industry", STR, True, 100),
        ("country", STR, True, 100),
        ("city", STR, True, 200),
        ("region", STR, True, 20),
        ("email", STR, True, 254),
        ("account_manager_id", STR, True, 20),
        ("credit_limit", CREDIT),
        ("currency", STR, True, 3),
        ("is_active", BOOL, False),
        ("valid_from", TS, False),
        ("valid_to", TS),
        ("is_current", BOOL, False),
        ("created_ts", TS, False),
        ("updated_ts", TS, False),
        ("source_hash", STR, True, 32),
    ),
    primary_key=("customer_sk",),
)

# The product, employee and date dimensions are only known from their use in reports and from the
# product catalogue; the history columns follow the customer dimension.
DIM_PRODUCT = TableContract(
    name="dim.product",
    schema=columns(
        ("product_sk", LONG, False),
        ("product_id", STR, False),
        ("sku", STR),
        ("product_name", STR),
        ("category", STR),
        ("subcategory", STR),
        ("unit_price", MONEY),
        ("cost_price", MONEY),
        ("currency", STR),
        ("uom", STR),
        ("supplier_id", STR),
        ("is_active", BOOL),
        ("valid_from", TS, False),
        ("valid_to", TS),
        ("is_current", BOOL, False),
        ("created_ts", TS, False),
        ("updated_ts", TS, False),
        ("source_hash", STR),
    ),
    primary_key=("product_sk",),
)

DIM_EMPLOYEE = TableContract(
    name="dim.employee",
    schema=columns(
        ("employee_sk", LONG, False),
        ("employee_id", STR, False),
        ("full_name", STR),
        ("team", STR),
        ("valid_from", TS, False),
        ("valid_to", TS),
        ("is_current", BOOL, False),
        ("created_ts", TS, False),
        ("updated_ts", TS, False),
        ("source_hash", STR),
    ),
    primary_key=("employee_sk",),
)

DIM_DATE = TableContract(
    name="dim.date",
    schema=columns(
        ("date_sk", INT, False),
        ("date", DATE, False),
        ("year", INT, False),
        ("quarter", INT, False),
        ("month", INT, False),
        ("year_month", STR, False),
    ),
    primary_key=("date_sk",),
)

FACT_ORDERS = TableContract(
    name="fact.sales_orders",
    schema=columns(
        ("sales_order_sk", LONG, False),
        ("order_id", STR, False, 30),
        ("customer_sk", LONG, False),
        ("product_sk", LONG, False),
        ("sales_rep_sk", LONG),
        ("date_sk", INT, False),
        ("order_date", DATE, False),
        ("status", STR, False, 30),
        ("region", STR, True, 20),
        ("quantity", MONEY, False),
        ("unit_price_usd", MONEY, False),
        ("total_amount_usd", MONEY, False),
        ("original_currency", STR, True, 3),
        ("fx_rate_to_usd", RATE),
        ("gross_margin_usd", MONEY),
        ("cost_amount_usd", MONEY),
        ("created_ts", TS, False),
        ("updated_ts", TS, False),
        ("pipeline_run_id", STR, True, 60),
    ),
    primary_key=("sales_order_sk",),
)

DAILY_SUMMARY = TableContract(
    name="agg.sales_daily_summary",
    schema=columns(
        ("summary_sk", LONG, False),
        ("order_date", DATE, False),
        ("order_year", SHORT, False),
        ("order_month", SHORT, False),
        ("order_quarter", SHORT, False),
        ("region", STR, False, 20),
        ("category", STR, False, 100),
        ("status", STR, False, 30),
        ("order_count", INT, False),
        ("customer_count", INT, False),
        ("total_quantity", MONEY, False),
        ("total_revenue_usd", MONEY, False),
        ("total_cost_usd", MONEY, False),
        ("gross_margin_usd", MONEY, False),
        ("avg_order_value_usd", MONEY),
        ("refreshed_ts", TS, False),
        ("pipeline_run_id", STR, True, 60),
    ),
    primary_key=("summary_sk",),
)

CONTROL_LOG = TableContract(
    name="ctrl.pipeline_control",
    schema=columns(
        ("pipeline_name", STR, False),
        ("run_id", STR, False),
        ("status", STR, False),
        ("rows_processed", LONG),
        ("last_watermark", TS),
        ("run_date", TS, False),
        ("error_message", STR),
    ),
)


def conform_to_contract(df: DataFrame, contract: TableContract) -> DataFrame:
    """Project to exactly the contract's columns, in order and typed; absent columns become null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in contract.schema
        ]
    )


def _convert(df: DataFrame, f: T.StructField) -> Column:
    """The value in the contract's type, null where that is impossible or not allowed."""
    source, target, col = df.schema[f.name].dataType, f.dataType, F.col(f.name)
    if isinstance(target, T.BooleanType) and isinstance(source, T.NumericType):
        return F.lit(None).cast(target)
    if isinstance(target, T.DateType) and isinstance(source, T.StringType):
        # the cast parses faster; the pattern and the year keep out what only one of the two takes
        plain = col.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & ~col.startswith("0000")
        return F.when(plain, col.try_cast("date")).otherwise(F.try_to_date(col, "yyyy-MM-dd"))
    return col.try_cast(target)


def _decimal_places(text: Column) -> Column:
    """How many decimal places a number written as text has, closing zeros left out; exact for any number of digits."""
    parts = F.lower(F.trim(text))
    mantissa = F.ltrim(F.split_part(parts, F.lit("e"), F.lit(1)), F.lit("+-"))
    fraction = F.split_part(mantissa, F.lit("."), F.lit(2))
    digits = F.concat(F.split_part(mantissa, F.lit("."), F.lit(1)), fraction)
    significant = F.rtrim(digits, F.lit("0"))
    shifted = F.coalesce(F.split_part(parts, F.lit("e"), F.lit(2)).try_cast("int"), F.lit(0))
    places = F.length(fraction) - (F.length(digits) - F.length(significant)) - shifted
    return F.when(F.ltrim(significant, F.lit("0")) == "", F.lit(0)).otherwise(places)


def _violates(df: DataFrame, f: T.StructField) -> Column:
    source, target, col = df.schema[f.name].dataType, f.dataType, F.col(f.name)
    converted = _convert(df, f)
    bad = converted.isNull()
    if isinstance(target, T.NumericType) and isinstance(source, T.NumericType):
        bad = bad | F.coalesce(converted.try_cast(source) != col, F.lit(True))
    elif isinstance(target, (T.IntegralType, T.DecimalType)) and isinstance(source, T.StringType):
        scale = getattr(target, "scale", 0)
        plain = col.rlike(rf"\A *[+-]?[0-9]*([.][0-9]{{0,{scale}}})? *\z")  # too few digits to count
        bad = bad | F.when(plain, F.lit(False)).otherwise(_decimal_places(col) > scale)
    elif isinstance(target, T.DateType) and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        bad = bad | (converted.cast(source) != col)
    limit = f.metadata.get("max_length")
    if limit and isinstance(target, T.StringType):
        bad = bad | (F.length(converted) > limit)
    return col.isNotNull() & F.coalesce(bad, F.lit(True))


def conform_strict(df: DataFrame, contract: TableContract) -> DataFrame:
    """Convert without loss and name, per row, the columns that could not be converted.

    Adds ``_conform_errors`` (array of column names, empty when the row is clean). Truncated
    decimals, over-long strings, times cut to dates and numbers given as booleans are errors.
    """
    have = [f for f in contract.schema if f.name in df.columns]
    errors = F.array_compact(F.array(*[F.when(_violates(df, f), F.lit(f.name)) for f in have]))
    values = [
        (_convert(df, f) if f in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in contract.schema
    ]
    return df.select(*values, errors.alias("_conform_errors"))
