"""Reads from the order database over JDBC, and the watermark rules of incremental extracts."""

from __future__ import annotations

import itertools
import re
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.operators.scd2 import utc_literal

# Rows per fetch and seconds a source query may take.
FETCH_ROWS = 50_000
QUERY_SECONDS = 7_200


def jdbc_options(
    url: str,
    table: str,
    split: tuple[str, str, str, int] | None = None,
    fetch_rows: int = FETCH_ROWS,
    query_seconds: int = QUERY_SECONDS,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the JDBC source. ``split`` is (column, lower, upper, parts) for a parallel read."""
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_rows),
        "queryTimeout": str(query_seconds),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
    }
    if split is not None:
        column, lower, upper, parts = split
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(parts),
        }
    return options | dict(properties or {})


_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$#]*(\.[A-Za-z_][A-Za-z0-9_$#]*)*")


def _named(name: str) -> str:
    """A table or column name that is safe to put into a query."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a plain name: {name!r}")
    return name


def query_options(url: str, query: str, **options) -> dict[str, str]:
    """Options of a read that the source answers as a whole."""
    made = jdbc_options(url, "", **options)
    del made["dbtable"]
    return made | {"query": query}


def max_watermark_query(table: str, column: str) -> str:
    return f"SELECT MAX({_named(column)}) AS max_watermark FROM {_named(table)}"


def bounds_query(table: str, column: str, watermark_column: str | None = None, watermark_value: datetime | None = None) -> str:
    """The source's own bounds of a column, of the rows after a watermark where one is given."""
    query = f"SELECT MIN({_named(column)}) AS lower_bound, MAX({_named(column)}) AS upper_bound FROM {_named(table)}"
    if watermark_column and watermark_value:
        query += f" WHERE {_named(watermark_column)} > '{watermark_value.isoformat(sep=' ')}'"
    return query


def range_predicates(column: str, lower, upper, parts: int) -> list[str]:
    """Conditions that part the rows of a whole-number or time column into ranges: every row meets exactly one of them.

    The outer ranges are open, so rows that come in after the bounds were asked for are read, and rows without a
    value go with the first. Without bounds (an empty source) there is one part.
    """
    name = _named(column)
    if lower is None or upper is None or parts <= 1:
        return [f"({name} IS NULL OR {name} IS NOT NULL)"]
    step = (upper - lower) / parts
    cuts = [lower + step * i for i in range(1, parts)]
    if isinstance(lower, int):
        cuts = [lower + (upper - lower) * i // parts for i in range(1, parts)]
    texts = [f"'{c.isoformat(sep=' ')}'" if isinstance(c, datetime) else str(c) for c in dict.fromkeys(cuts) if c > lower]
    if not texts:
        return [f"({name} IS NULL OR {name} IS NOT NULL)"]
    inner = [f"({name} >= {a} AND {name} < {b})" for a, b in itertools.pairwise(texts)]
    return [f"({name} < {texts[0]} OR {name} IS NULL)", *inner, f"({name} >= {texts[-1]})"]


def narrowed(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    watermark_column: str | None = None,
    watermark_value: datetime | str | None = None,
) -> DataFrame:
    """Column list and exclusive lower watermark bound; both reach the source as pushed-down parts.

    The bound applies only when column and value are both given.
    """
    if watermark_column and watermark_value:
        value = utc_literal(watermark_value) if isinstance(watermark_value, datetime) else F.lit(watermark_value)
        bound = value.cast(df.schema[watermark_column].dataType)
        df = df.where(F.col(watermark_column) > bound)
    return df.select(*columns) if columns else df


def read_database_table(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] | None = None,
    watermark_column: str | None = None,
    watermark_value: datetime | str | None = None,
    **options,
) -> DataFrame:
    """A database table as a DataFrame; executors read its parts in parallel, an empty one keeps its schema."""
    source = spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()
    return narrowed(source, columns, watermark_column, watermark_value)


def read_in_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    parts: int,
    columns: Sequence[str] | None = None,
    watermark_column: str | None = None,
    watermark_value: datetime | None = None,
    **options,
) -> DataFrame:
    """A database table read in ``parts`` ranges of a column, whose bounds the source is asked for first (one row)."""
    asked = query_options(url, bounds_query(table, column, watermark_column, watermark_value), **options)
    bounds = spark.read.format("jdbc").options(**asked).load().first()
    predicates = range_predicates(column, bounds[0], bounds[1], parts)
    properties = {k: v for k, v in jdbc_options(url, table, **options).items() if k not in ("url", "dbtable")}
    return narrowed(spark.read.jdbc(url, table, predicates=predicates, properties=properties), columns, watermark_column, watermark_value)


def source_max_watermark(spark: SparkSession, url: str, table: str, column: str, **options) -> DataFrame:
    """The highest value of a column as text: the source works it out and sends one row."""
    read = spark.read.format("jdbc").options(**query_options(url, max_watermark_query(table, column), **options)).load()
    return read.select(F.col(read.columns[0]).cast("string").alias("max_watermark"))


def max_watermark(df: DataFrame, column: str) -> DataFrame:
    """The highest value of a column as text, null for an empty table."""
    return df.agg(F.max(column).cast("string").alias("max_watermark"))


def window_extract(
    df: DataFrame,
    watermark_column: str,
    lower: datetime,
    upper: datetime,
    run_id: str,
    run_ts: datetime,
) -> DataFrame:
    """Rows with ``lower < watermark <= upper``, stamped with run time, batch and delete flag."""
    kind = df.schema[watermark_column].dataType
    wm = F.col(watermark_column)
    inside = df.where((wm > utc_literal(lower).cast(kind)) & (wm <= utc_literal(upper).cast(kind)))
    return inside.withColumns(
        {"_ingestion_ts": utc_literal(run_ts), "_source_file": F.lit(run_id), "_is_deleted": F.lit(False)}
    )
