"""The jobs end to end: three days of deliveries, a failure, a repair and re-runs."""

from datetime import date, datetime, timedelta

import pytest
from conftest import by
from pyspark.sql import functions as F

from tallyworks.operators import star, summary
from tallyworks.operators.control import SilverNotReady
from tallyworks.operators.quality import DataQualityError
from tallyworks.plans import gold, ingest, runlog, silver
from tallyworks.plans.lake import MONTH, Lake
from tallyworks.sources import read_crm_responses
from tallyworks.streaming import redelivered_dropped, stream_into_silver

DAY1, DAY2, DAY3 = date(2024, 3, 1), date(2024, 3, 2), date(2024, 3, 3)


def at(day, hour=2):
    return datetime(day.year, day.month, day.day, hour)


def source(spark, *rows):
    """(order_id, order_date, customer, product, quantity, price, currency, status, region, rep, changed)"""
    names = "o string, d string, c string, p string, q int, price int, cur string, status string, region string, rep string, t timestamp"
    return spark.createDataFrame(list(rows), names).selectExpr(
        "o AS order_id", "d AS order_date", "c AS customer_id", "p AS product_id", "cast(q AS decimal(18,4)) AS quantity",
        "cast(price AS decimal(18,4)) AS unit_price", "cast(q * price AS decimal(18,4)) AS total_amount", "cur AS currency",
        "status", "region", "rep AS sales_rep_id", "t AS AEDAT",
    )


FIRST = [
    ("A1", "2024-02-10", "C1", "P1", 2, 10, "USD", "C", "EMEA", "R1", at(DAY1, 1)),
    ("A2", "2024-02-11", "C2", "P1", 1, 10, "EUR", "P", "APAC", "R1", at(DAY1, 1)),
    ("A3", "2024-01-05", "C1", "P2", 5, 4, "USD", "C", None, None, at(DAY1, 1)),
]
SECOND = [
    ("A2", "2024-02-11", "C2", "P1", 1, 10, "EUR", "C", "APAC", "R1", at(DAY2, 1)),  # changed status
    ("A3", "2024-01-05", "C1", "P2", 5, 4, "USD", "COMP", None, None, at(DAY2, 1)),  # redelivered, unchanged
    ("A4", "2024-02-20", "C3", "P2", 1, 4, "USD", "C", "AMER", "R2", at(DAY2, 1)),  # new, customer still unknown
]


def rates(spark):
    days = [(d, "EUR", 1.1) for d in (DAY1, DAY2, DAY3)]
    return spark.createDataFrame(days, "rate_date date, from_currency string, rate_to_usd double")


def master(spark, *customers, industry="Toys"):
    c = spark.createDataFrame([(x, f"Name {x}", industry) for x in customers], "customer_id string, customer_name string, industry string")
    for n in ("account_type", "country", "city", "region", "email", "account_manager_id", "currency"):
        c = c.withColumn(n, F.lit(None).cast("string"))
    c = c.withColumns({"credit_limit": F.lit(0), "is_active": F.lit(True)})
    p = spark.createDataFrame([("P1", "Bolt", "Parts", 6.0), ("P2", "Nut", "Parts", 1.0)],
                              "product_id string, product_name string, category string, cost_price double")
    e = spark.createDataFrame([("R1", "Ann", "North"), ("R2", "Bob", "South")], "employee_id string, full_name string, team string")
    return gold.MasterData(c, p, e)


def run_day(spark, lake, rows, day, customers, **kw):
    ingest.ingest_orders(spark, lake, source(spark, *rows), at(day))
    silver.build_silver(spark, lake, rates(spark), day, at(day, 4), **kw)
    return gold.build_gold(spark, lake, master(spark, *customers), day, at(day, 6))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Day 1 and day 2 done."""
    lake = Lake(str(tmp_path_factory.mktemp("lake")))
    run_day(spark, lake, FIRST, DAY1, ["C1", "C2"])
    run_day(spark, lake, FIRST + SECOND, DAY2, ["C1", "C2"])
    return lake


def test_only_rows_after_the_watermark_reach_bronze(spark, lake):
    bronze = ingest.read_bronze_orders(spark, lake)
    assert {(r.ingestion_date, r["count"]) for r in bronze.groupBy("ingestion_date").count().collect()} == {(DAY1, 3), (DAY2, 3)}


def test_jobs_leave_no_staged_tables(spark, lake):
    from pathlib import Path

    from tallyworks.session import staging_root

    root = Path(staging_root(spark).removeprefix("file:"))
    assert not [p.name for p in root.glob("staged/*") if p.name.startswith(("silver", "fact-", "dimension", "summary"))]


def test_silver_history(spark, lake):
    rows = lake.silver_orders.read(spark).collect()
    assert sorted((r.order_id, r.status, r._is_current) for r in rows) == [
        ("A1", "Completed", True), ("A2", "Completed", True), ("A2", "Pending", False), ("A3", "Completed", True), ("A4", "Completed", True),
    ]
    closed = [r for r in rows if not r._is_current][0]
    assert (closed._valid_from, closed._valid_to) == (at(DAY1, 4), at(DAY2, 4))
    assert {r.order_id: float(r.total_amount_usd) for r in rows}["A2"] == 11.0


def test_untouched_months_are_carried_by_name(spark, lake):
    year = "order_year=2024/order_month"
    assert lake.silver_orders.manifest(spark) == {
        f"_is_current=true/{year}=1": (1,), f"_is_current=true/{year}=2": (2,), f"_is_current=false/{year}=2": (2,),
    }


def test_gold_after_day_two(spark, lake):
    facts = by(lake.fact_orders.read(spark))
    assert set(facts) == {"A1", "A2", "A3"} and facts["A2"].status == "Completed"
    assert sorted(f.sales_order_sk for f in facts.values()) == [1, 2, 3]
    waiting = lake.unresolved.read(spark).collect()
    assert [(r.order_id, r.unresolved) for r in waiting] == [("A4", "customer_id")]


def same_as_rebuilt(spark, lake):
    """Facts and summary hold what a rebuild from the stored silver and dimensions gives, keys and run marks aside."""
    dims = [t.read(spark) for t in (lake.customers, lake.products, lake.employees)]
    resolved = star.resolve_keys(lake.silver_orders.read(spark).where("_is_current"), *dims)
    own = ["sales_order_sk", "created_ts", "updated_ts", "pipeline_run_id"]
    want = star.fact_orders(resolved, at(DAY3, 12)).drop(*own)
    held = lake.fact_orders.read(spark).drop(MONTH)
    assert sorted(map(str, held.drop(*own).collect())) == sorted(map(str, want.select(*held.drop(*own).columns).collect()))
    own = ["refreshed_ts", "pipeline_run_id"]
    want = summary.daily_summary(held, dims[1], at(DAY3, 12)).drop(*own)
    stored = lake.daily_summary.read(spark).select(*want.columns)
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))


def test_summary_holds_every_touched_date(spark, lake):
    assert lake.daily_summary.read(spark).count() == 3
    assert lake.summary_due.read(spark).count() == 0
    same_as_rebuilt(spark, lake)


def test_gold_makes_up_for_a_run_that_died_after_the_dimensions(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    run_day(spark, lake, [*FIRST, (*SECOND[2][:10], at(DAY1, 1))], DAY1, ["C1", "C2"])
    data = master(spark, "C1", "C2", "C3", industry="Games")
    with monkeypatch.context() as patch:
        patch.setattr(gold, "refresh_fact", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            gold.build_gold(spark, lake, data, DAY1, at(DAY1, 7))
    with monkeypatch.context() as patch:  # and once more between fact and summary
        patch.setattr(gold, "refresh_due_summary", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            gold.build_gold(spark, lake, data, DAY1, at(DAY1, 8))
    assert gold.build_gold(spark, lake, data, DAY1, at(DAY1, 9)).rows == 0
    assert set(by(gold.sales_overview(spark, lake))) == {"A1", "A2", "A3", "A4"}
    assert lake.unresolved.read(spark).count() == 0
    same_as_rebuilt(spark, lake)


def test_gold_sees_a_silver_day_repeated_late(spark, tmp_path):
    lake = Lake(str(tmp_path))
    run_day(spark, lake, FIRST, DAY1, ["C1", "C2", "C3"])
    run_day(spark, lake, [(*FIRST[0][:4], 7, *FIRST[0][5:10], at(DAY3, 1))], DAY3, ["C1", "C2", "C3"])
    late = source(spark, *SECOND).withColumns({"_ingestion_ts": F.lit(at(DAY2)), "ingestion_date": F.lit(DAY2),
                                                "_source_file": F.lit("late"), "_is_deleted": F.lit(False)})
    silver.build_silver(spark, lake, rates(spark), DAY2, at(DAY2, 4), bronze=late)
    gold.build_gold(spark, lake, master(spark, "C1", "C2", "C3"), DAY3, at(DAY3, 8))
    facts = by(lake.fact_orders.read(spark))
    assert set(facts) == {"A1", "A2", "A3", "A4"} and facts["A2"].status == "Completed" and facts["A1"].quantity == 7
    same_as_rebuilt(spark, lake)


def test_pipelines_that_end_together_are_all_logged(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    lake = Lake(str(tmp_path))
    with ThreadPoolExecutor(6) as pool:
        work = lambda run_id, _: runlog.RunResult(run_id, 1, at(DAY2))
        done = [pool.submit(runlog.run_logged, spark, lake, f"job {i}", at(DAY1, i), work) for i in range(6)]
        assert [d.result().rows for d in done] == [1] * 6
    assert sorted(r.pipeline_name for r in runlog.log(spark, lake).collect()) == [f"job {i}" for i in range(6)]


def test_summary_refresh_by_date_and_in_full(spark, lake, tmp_path):
    gold.refresh_summary(spark, lake, at(DAY2, 7), "RUN-F", None)
    full = lake.daily_summary.read(spark)
    assert full.count() == 3
    gold.refresh_summary(spark, lake, at(DAY2, 8), "RUN-D", date(2024, 2, 11))
    again = lake.daily_summary.read(spark)
    assert again.drop("summary_sk", "refreshed_ts", "pipeline_run_id").exceptAll(
        full.drop("summary_sk", "refreshed_ts", "pipeline_run_id")).count() == 0
    keys = sorted(r.summary_sk for r in again.collect())
    assert len(set(keys)) == 3 and max(keys) == 4
    gold.refresh_summary(spark, lake, at(DAY2, 9), "RUN-E", date(2024, 2, 28))
    assert lake.daily_summary.read(spark).count() == 3


def test_silver_run_again_is_a_no_op(spark, lake):
    before = lake.silver_orders.read(spark).collect()
    versions = lake.silver_orders.versions(spark)
    silver.build_silver(spark, lake, rates(spark), DAY2, at(DAY2, 5))
    assert sorted(map(str, lake.silver_orders.read(spark).collect())) == sorted(map(str, before))
    assert lake.silver_orders.versions(spark) == versions


def test_full_refresh_rebuilds_from_all_deliveries(spark, tmp_path):
    lake = Lake(str(tmp_path))
    ingest.ingest_orders(spark, lake, source(spark, *FIRST), at(DAY1))
    ingest.ingest_orders(spark, lake, source(spark, *FIRST, *SECOND), at(DAY2))
    dims = master(spark, "C1", "C2")
    named = dims.customers.withColumn("is_current", F.lit(True))
    goods = dims.products.withColumn("is_current", F.lit(True))
    silver.build_silver(spark, lake, rates(spark), DAY2, at(DAY2, 4), full_refresh=True, customers=named, products=goods)
    rows = by(lake.silver_orders.read(spark))
    assert len(rows) == 4 and all(r._is_current for r in rows.values())
    assert rows["A2"].customer_name == "Name C2" and rows["A4"].customer_name is None and rows["A4"].category == "Parts"


def test_a_failed_check_keeps_the_watermark_and_can_be_repaired(spark, tmp_path):
    lake = Lake(str(tmp_path))
    bad = ("A9", "2024-02-10", "C1", "P1", 0, 10, "USD", "C", "EMEA", "R1", at(DAY1, 1))
    with pytest.raises(DataQualityError, match="quantity_rule"):
        ingest.ingest_orders(spark, lake, source(spark, bad), at(DAY1))
    row = runlog.log(spark, lake).collect()[0]
    assert (row.status, row.rows_processed, row.last_watermark) == ("FAILED", 0, datetime(1900, 1, 1))
    assert "quantity_rule" in row.error_message
    runlog.repair_runs(spark, lake, ingest.INGEST_ORDERS, DAY1, at(DAY1))
    assert ingest.ingest_orders(spark, lake, source(spark, bad), at(DAY2)).rows == 0
    result = ingest.ingest_orders(spark, Lake(str(tmp_path / "b")), source(spark, bad), at(DAY1), skip_quality=True)
    assert (result.rows, result.watermark) == (1, at(DAY1))


def test_lossy_values_stop_the_extract_before_anything_is_written(spark, tmp_path):
    lake = Lake(str(tmp_path))
    lossy = source(spark, *FIRST).withColumn("quantity", F.lit("1.23456"))
    with pytest.raises(Exception, match="lossy conversion of quantity"):
        ingest.ingest_orders(spark, lake, lossy, at(DAY1))
    assert runlog.log(spark, lake).collect()[0].status == "FAILED"
    assert ingest.read_bronze_orders(spark, lake).count() == 0


def test_gold_waits_for_silver(spark, tmp_path):
    with pytest.raises(SilverNotReady):
        gold.build_gold(spark, Lake(str(tmp_path)), master(spark, "C1"), DAY1, at(DAY1, 6))


def test_reference_and_accounts_and_archive(spark, lake, tmp_path):
    table = ingest.load_reference(spark, lake, "units", spark.createDataFrame([("EA",), ("KG",)], "uom string"))
    ingest.load_reference(spark, lake, "units", spark.createDataFrame([("M",)], "uom string"))
    assert [r.uom for r in table.read(spark).collect()] == ["M"]
    doc = '{"query":"q","done":true,"total_size":2,"records":[{"Id":"x","LastModifiedDate":"2024-02-29T10:00:00.000+0000"},{"Id":"y","LastModifiedDate":"2024-01-01T10:00:00.000+0000"}]}'
    (tmp_path / "page1.json").write_text(doc)
    envelopes = read_crm_responses(spark, str(tmp_path))
    assert ingest.ingest_accounts(spark, lake, envelopes, at(DAY1)).rows == 1
    assert [r.Id for r in lake.bronze_accounts.read(spark).collect()] == ["x"]
    done = [ingest.archive_bronze(spark, lake, DAY2 + timedelta(days=90)) for _ in range(2)]
    assert [d.copied for d in done] == [[DAY1], []] and lake.archived_orders.versions(spark) == [1]
    assert lake.archived_orders.read(spark).count() == 3
    later = ingest.archive_bronze(spark, lake, date(2031, 3, 2))
    assert (later.copied, later.dropped) == ([DAY2], [DAY1])
    assert {r.ingestion_date for r in lake.archived_orders.read(spark).collect()} == {DAY2}
    assert lake.archived_orders.manifest(spark) == {f"ingestion_date={DAY2}": (2,)}


def test_streamed_silver_equals_the_batch_job(spark, tmp_path):
    lake, batch = Lake(str(tmp_path / "s")), Lake(str(tmp_path / "b"))
    days = iter([at(DAY1, 4), at(DAY2, 4)])
    for rows, day in ((FIRST, DAY1), (SECOND, DAY2)):
        for target in (lake, batch):
            ingest.ingest_orders(spark, target, source(spark, *rows), at(day))
        silver.build_silver(spark, batch, rates(spark), day, at(day, 4))
        now = next(days)
        stream_into_silver(spark, lake, rates(spark), str(tmp_path / "cp"), lambda now=now: now).awaitTermination()
    assert sorted(map(str, lake.silver_orders.read(spark).collect())) == sorted(map(str, batch.silver_orders.read(spark).collect()))


def test_streamed_redeliveries_are_dropped(spark, tmp_path):
    lake = Lake(str(tmp_path))
    ingest.ingest_orders(spark, lake, source(spark, *FIRST, *FIRST), at(DAY1))
    from tallyworks.streaming import stream_bronze

    query = redelivered_dropped(stream_bronze(spark, lake)).writeStream.format("memory").queryName("once").trigger(
        availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    query.awaitTermination()
    assert spark.table("once").count() == 3


def test_day_three(spark, lake):
    """Continues from the shared state, so it comes last: a new customer, a renamed one, an order that moves."""
    before = by(lake.fact_orders.read(spark))
    moved = ("A1", "2024-03-01", "C1", "P1", 3, 10, "USD", "C", "EMEA", "R1", at(DAY3, 1))
    ingest.ingest_orders(spark, lake, source(spark, moved), at(DAY3))
    silver.build_silver(spark, lake, rates(spark), DAY3, at(DAY3, 4))
    rows = lake.silver_orders.read(spark).where("order_id = 'A1'").collect()
    assert sorted((r.order_month, r._is_current) for r in rows) == [(2, False), (3, True)]

    data = master(spark, "C1", "C2", "C3")
    renamed = data.customers.withColumn(
        "industry", F.when(F.col("customer_id") == "C1", "Games").otherwise(F.col("industry"))
    )
    data = gold.MasterData(renamed, data.products, data.representatives)
    gold.build_gold(spark, lake, data, DAY3, at(DAY3, 6))
    same_as_rebuilt(spark, lake)
    stored = lake.fact_orders.read(spark)
    after = by(stored)
    assert stored.count() == 4
    # The order that waited for its customer arrives, the moved one exists once, in its new month.
    assert after["A4"].sales_order_sk == 4 and after["A4"].sales_rep_sk is not None
    assert (after["A1"][MONTH], after["A1"].quantity, after["A1"].sales_order_sk) == ("2024-03", 3, before["A1"].sales_order_sk)
    # A customer's new version takes its untouched orders along.
    assert after["A3"].customer_sk != before["A3"].customer_sk and after["A3"].quantity == before["A3"].quantity
    assert after["A2"] == before["A2"]
    assert set(by(gold.sales_overview(spark, lake, "sales_overview"))) == set(after)
    assert spark.table("sales_overview").count() == 4
    allowed = spark.createDataFrame([("ann", "EMEA")], "principal string, region string")
    assert set(by(gold.secured_overview(spark, lake, allowed, "ann"))) == {"A1"}
    pack = gold.analysis_pack(spark, lake)
    assert pack["sales_totals"].collect()[0].order_count == 4
    assert [r.customer_name for r in pack["top_customers"].collect()] == ["Name C1", "Name C2", "Name C3"]
    assert {r.category for r in pack["region_category_matrix"].collect()} == {"Parts"}

    # Rebuilding from nothing gives the same facts, surrogate keys aside.
    gold.build_gold(spark, lake, data, DAY3, at(DAY3, 8), full_refresh=True)
    cols = ["order_id", "status", "quantity", "total_amount_usd", "cost_amount_usd", "gross_margin_usd", "date_sk"]
    rebuilt = {tuple(r) for r in lake.fact_orders.read(spark).select(*cols).collect()}
    assert rebuilt == {tuple(r[c] for c in cols) for r in after.values()}


def test_a_full_fact_stores_what_facts_take_of_an_order_once(spark, tmp_path, monkeypatch):
    """Orders that wait are still kept whole."""
    stored, keep = {}, gold.stage
    monkeypatch.setattr(gold, "stage", lambda df, label: stored.setdefault(label, df) and keep(df, label))
    lake = Lake(str(tmp_path / "lake"))
    ingest.ingest_orders(spark, lake, source(spark, *FIRST), at(DAY1))
    silver.build_silver(spark, lake, rates(spark), DAY1, at(DAY1, 4))
    gold.build_gold(spark, lake, master(spark, "C1"), DAY1, at(DAY1, 6), full_refresh=True)
    assert not {"_source_hash", "order_year", "product_name"} & set(stored["fact-resolved"].columns) and "fact-rows" not in stored
    row = lake.unresolved.read(spark).first()
    whole = lake.silver_orders.read(spark).where("order_id = 'A2'").first()
    assert (row.order_id, row.unresolved, row._source_hash) == ("A2", "customer_id", whole._source_hash)
    assert sorted(r.order_id for r in lake.fact_orders.read(spark).collect()) == ["A1", "A3"]
