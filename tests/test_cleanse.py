from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import by
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallyworks import contracts
from tallyworks import functions as fn
from tallyworks.operators import cleanse as cl
from tallyworks.operators.fx import convert_to_usd, usable_rates
from tallyworks.operators.latest import latest_per_key


def test_status_is_trimmed_and_case_folded(raw):
    got = {k: r.status for k, r in by(cl.cleanse(raw)).items()}
    assert got == {"A1": "Completed", "A2": "Pending", "A3": "Cancelled", "A4": "Refunded", "A5": "Unknown"}


def test_every_listed_code_maps_and_other_words_do_not(spark):
    codes = spark.createDataFrame([(c,) for c in [*fn.STATUS_BY_CODE, "REFUNDED", "", None]], "status string")
    got = [r.s for r in codes.select(fn.standardise_status("status").alias("s")).collect()]
    assert got == [*fn.STATUS_BY_CODE.values(), "Unknown", "Unknown", "Unknown"]


def test_strict_status_matches_exactly(spark):
    codes = spark.createDataFrame([(c,) for c in ["C", "comp", " C", "CANC", "R", None]], "status string")
    got = [r.s for r in codes.select(fn.standardise_status_strict("status").alias("s")).collect()]
    assert got == ["Completed", "Unknown", "Unknown", "Cancelled", "Unknown", "Unknown"]


def test_types_parts_and_defaults(raw):
    rows = by(cl.cleanse(raw.where("_source_file = 'B-07'")))
    assert rows["A1"].quantity == Decimal("4.0000")
    assert (rows["A3"].order_year, rows["A3"].order_month) == (2023, 12)
    assert (rows["A3"].region, rows["A3"].sales_rep_id) == ("UNKNOWN", "UNASSIGNED")
    assert rows["A5"].quantity is None and rows["A5"].order_date == date(2024, 1, 5)


def test_bad_dates_become_null_and_rows_are_dropped_and_counted(spark, raw):
    bad = raw.withColumn(
        "order_date",
        F.when(F.col("order_id") == "A1", "2024-02-30").when(F.col("order_id") == "A2", "2024-02-28 10:00:00")
        .when(F.col("order_id") == "A3", "2024-1-5").otherwise(F.col("order_date")),
    )
    counts = Observation()
    assert set(by(cl.cleanse(bad, counts=counts))) == {"A4", "A5"}
    assert counts.get == {"rows_in": 6, "rows_dropped": 4}


@pytest.mark.parametrize("column", cl.REQUIRED)
def test_required_fields(raw, column):
    holed = raw.withColumn(column, F.when(F.col("_source_file") == "B-11", F.col(column)))
    assert cl.cleanse(holed).count() == 1


def test_typed_input_passes_through(raw):
    typed = cl.parse_types(raw)
    assert cl.cleanse(typed).count() == 6


def test_defaults_skip_absent_and_other_types(spark):
    df = spark.createDataFrame([(1,)], "region int")
    assert cl.fill_defaults(df).collect()[0].region == 1


def test_latest_delivery_wins(raw):
    rows = by(latest_per_key(raw))
    assert len(rows) == 5 and rows["A1"]._source_file == "B-11"


def test_latest_is_idempotent_and_nulls_and_ties_are_settled(spark):
    df = spark.createDataFrame(
        [("k", None, 9), ("k", datetime(2024, 1, 1), 1), ("k", datetime(2024, 1, 1), 3), ("m", None, 2)],
        "a string, t timestamp, x int",
    )
    once = latest_per_key(df, ["a"], "t", ["x"])
    assert {r.a: r.x for r in once.collect()} == {"k": 3, "m": 2}
    assert latest_per_key(once, ["a"], "t", ["x"]).count() == 2


def test_conversion(raw, rates):
    rows = by(convert_to_usd(cl.cleanse(raw), usable_rates(rates, "2024-03-01"), flag_missing=True))
    assert rows["A1"].fx_rate_to_usd == 1 and not rows["A1"].fx_rate_missing
    assert rows["A2"].unit_price_usd == Decimal("88.0000") and rows["A2"].fx_rate_to_usd == Decimal("1.100000")
    assert rows["A3"].total_amount_usd == Decimal("31.2500")
    assert rows["A4"].fx_rate_to_usd == 1 and rows["A4"].fx_rate_missing
    assert "unit_price" not in rows["A1"].asDict() and rows["A2"].original_currency == "EUR"


def test_listed_usd_does_not_double_rows(raw, rates):
    assert convert_to_usd(cl.cleanse(raw), usable_rates(rates, date(2024, 3, 1))).count() == 6


def test_two_rates_of_a_currency_fail(raw, rates):
    doubled = rates.unionByName(rates.where("from_currency = 'EUR'"))
    with pytest.raises(Exception, match="more than one rate for EUR"):
        convert_to_usd(cl.cleanse(raw), usable_rates(doubled, "2024-03-01")).collect()


def test_many_rates_take_the_shuffle_join(raw, rates, monkeypatch):
    monkeypatch.setattr("tallyworks.operators.fx.broadcast_if_small", lambda df: df.hint("merge"))
    rows = by(convert_to_usd(cl.cleanse(raw), usable_rates(rates, "2024-03-01")))
    assert len(rows) == 5 and rows["A2"].unit_price_usd == Decimal("88.0000")


def test_rounding_is_half_up(spark):
    df = spark.sql("SELECT cast(2.00005 AS decimal(18,5)) AS a, cast(1 AS decimal(18,6)) AS r")
    assert df.select(fn.to_usd("a", "r").alias("u")).collect()[0].u == Decimal("2.0001")


def test_hash_joins_text_and_writes_null_as_empty(spark):
    import hashlib

    df = spark.sql("SELECT 'a' AS x, cast(NULL AS string) AS y, cast(1 AS decimal(18,4)) AS z")
    got = df.select(fn.row_hash(["x", "y", "z"]).alias("h")).collect()[0].h
    assert got == hashlib.md5(b"a||1.0000").hexdigest()


def test_date_and_run_helpers(spark):
    row = spark.sql("SELECT date '2024-05-09' AS d").select(
        fn.year_month("d").alias("m"), fn.year_quarter("d").alias("q"), fn.date_key("d").alias("k")
    ).collect()[0]
    assert tuple(row) == ("2024-05", "2024-Q2", 20240509)
    assert fn.default_processing_date(datetime(2024, 3, 1, 6)) == date(2024, 2, 29)
    assert fn.new_run_id(datetime(2024, 3, 1, 6, 7, 8)) == "RUN-20240301-060708"


def test_margin_percent_needs_positive_revenue(spark):
    df = spark.sql("SELECT cast(m AS decimal(18,4)) AS m, cast(r AS decimal(18,4)) AS r FROM VALUES (1, 3), (1, 0), (-1, 8) AS t(m, r)")
    got = [r.p for r in df.select(fn.margin_percent("m", "r").alias("p")).collect()]
    assert [None if p is None else float(p) for p in got] == [33.33, None, -12.5]


def test_strict_conversion_takes_the_short_way_only_where_it_is_the_same(spark):
    """plain numbers and dates are told by a pattern; whatever else there is goes the long way."""
    texts = ["1.2345", "1.23450", "1.23456", " +1.5 ", "-.5", "5.", "", ".", "1e-3", "1.2e-4", "12e1", "1.2345\n", "1.5\t", "n/a", "٣", None]
    days = ["2024-02-29", "2023-02-29", "2024-13-01", "0000-01-01", "2024-1-5", " 2024-01-05", "2024-01-05\n", "2024-01-05 10:00:00", "+12024-01-05", None]
    rows = [(t, days[i % len(days)]) for i, t in enumerate(texts)] + [(None, d) for d in days]
    contract = contracts.TableContract("t", contracts.columns(("n", contracts.MONEY), ("d", contracts.DATE)))
    df = spark.createDataFrame(rows, "n string, d string")
    n, d = F.col("n"), F.col("d")
    amount, day = n.try_cast(contracts.MONEY), F.try_to_date(d, "yyyy-MM-dd")
    plain_errors = F.array_compact(
        F.array(
            F.when(n.isNotNull() & F.coalesce(amount.isNull() | (contracts._decimal_places(n) > 4), F.lit(True)), F.lit("n")),
            F.when(d.isNotNull() & day.isNull(), F.lit("d")),
        )
    )
    strict = contracts.conform_strict(df, contract)
    got = strict.select("n", F.col("d").cast("string"), "_conform_errors").collect()  # Python has no year 0
    want = df.select(amount.alias("n"), day.cast("string").alias("d"), plain_errors.alias("_conform_errors")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert "RLIKE" in strict._jdf.queryExecution().optimizedPlan().toString()
