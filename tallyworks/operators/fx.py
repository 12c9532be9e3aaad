"""Currency conversion to USD."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.contracts import MONEY, RATE
from tallyworks.functions import to_usd
from tallyworks.session import broadcast_if_small


def usable_rates(fx: DataFrame, rate_date: date | str) -> DataFrame:
    """The rates of one day as (from_currency, rate_to_usd), with USD at exactly 1.

    A USD row in the input is ignored. Two rates for a currency on a day fail the query, since
    they would double every order in that currency.
    """
    listed = fx.where(
        (F.col("rate_date").cast("date") == F.lit(str(rate_date)).cast("date"))
        & F.col("from_currency").isNotNull()
        & (F.col("from_currency") != "USD")
    )
    one_each = listed.groupBy("from_currency").agg(
        F.count(F.lit(1)).alias("n"), F.max("rate_to_usd").cast(RATE).alias("rate")
    )
    clash = F.raise_error(F.concat(F.lit("more than one rate for "), F.col("from_currency")))
    rates = one_each.select(
        "from_currency", F.when(F.col("n") == 1, F.col("rate")).otherwise(clash.cast(RATE)).alias("rate_to_usd")
    )
    usd = fx.sparkSession.range(1).select(
        F.lit("USD").alias("from_currency"), F.lit(1).cast(RATE).alias("rate_to_usd")
    )
    return rates.unionByName(usd)


def convert_to_usd(
    df: DataFrame,
    rates: DataFrame,
    price_col: str = "unit_price",
    amount_col: str = "total_amount",
    currency_col: str = "currency",
    flag_missing: bool = False,
) -> DataFrame:
    """Replace price, amount and currency by their USD columns; a currency without a rate counts as 1.

    Currency is a handful of values, so a shuffle on it would be all skew: the rates are broadcast
    once counted to be few. ``flag_missing`` adds ``fx_rate_missing`` for the quality metric.
    """
    lookup = broadcast_if_small(
        rates.select(F.col("from_currency").alias("_fx_currency"), F.col("rate_to_usd").cast(RATE).alias("_fx_rate"))
    )
    joined = df.join(lookup, F.col(currency_col) == F.col("_fx_currency"), "left")
    rate = F.coalesce(F.col("_fx_rate"), F.lit(1).cast(RATE))
    added = {
        "fx_rate_to_usd": rate,
        "unit_price_usd": to_usd(F.col(price_col).cast(MONEY), rate),
        "total_amount_usd": to_usd(F.col(amount_col).cast(MONEY), rate),
        "original_currency": F.col(currency_col),
    }
    if flag_missing:
        added["fx_rate_missing"] = F.col("_fx_rate").isNull()
    return joined.withColumns(added).drop("_fx_currency", "_fx_rate", currency_col, price_col, amount_col)
