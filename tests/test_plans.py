"""What the physical plans must and must not contain."""

import pytest
from conftest import RUN
from pyspark.sql import functions as F

from tallyworks.operators import fx, quality, scd2, summary
from tallyworks.operators.keys import assign_surrogate_keys
from tallyworks.operators.latest import latest_per_key

BIG = 2_000_000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A stored silver-like table without size estimates small enough to broadcast."""
    path = str(tmp_path_factory.mktemp("plans") / "t")
    spark.range(2000).selectExpr(
        "concat('k', id) AS order_id", "timestamp '2024-01-01' AS _valid_from", "cast(NULL AS timestamp) AS _valid_to",
        "true AS _is_current", "timestamp '2024-01-01' AS _updated_ts", "md5(cast(id AS string)) AS _source_hash",
        "cast(id AS decimal(18,4)) AS total_amount", "cast(id AS decimal(18,4)) AS unit_price", "'EUR' AS currency",
        "current_date() AS order_date", "'P' AS payload",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_latest_cuts_before_the_shuffle(stored):
    text = plan(latest_per_key(stored, "order_id", "_updated_ts"))
    first_cut, exchange = text.rindex("WindowGroupLimit"), text.index("Exchange hashpartitioning")
    assert text.count("WindowGroupLimit") == 2 and text.index("WindowGroupLimit") < exchange < first_cut


def test_merge_shuffles_each_side_once(stored, spark):
    text = plan(scd2.merge(stored, stored.withColumn("_valid_from", F.lit(RUN)), RUN))
    assert text.count("Exchange hashpartitioning") <= 2 and "Join" not in text


def test_change_detection_reads_keys_and_hashes_only(stored):
    batch = stored.withColumn("payload", F.lit("Q"))
    text = scd2.effective_changes(stored, batch)._jdf.queryExecution().toString()
    narrow = [line for line in text.splitlines() if "ReadSchema" in line and "payload" not in line]
    assert any("ReadSchema: struct<order_id:string,_is_current:boolean,_source_hash:string>" in line for line in narrow)


def test_rates_are_broadcast_when_few_and_not_when_many(stored, spark, monkeypatch):
    rates = spark.sql("SELECT date '2024-01-01' AS rate_date, 'EUR' AS from_currency, 1.1 AS rate_to_usd")
    few = plan(fx.convert_to_usd(stored, fx.usable_rates(rates, "2024-01-01")))
    assert "BroadcastHashJoin" in few
    monkeypatch.setattr("tallyworks.operators.fx.broadcast_if_small", lambda df: df)
    monkeypatch.setattr("tallyworks.session.BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = plan(fx.convert_to_usd(stored, fx.usable_rates(rates, "2024-01-01")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in many


def test_filters_and_columns_reach_the_scan(stored):
    text = stored.where("_is_current").select("order_id", "_is_current")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(_is_current), EqualTo(_is_current,true)]" in text
    day = summary.of_date(stored, "2024-01-05").select("order_id")._jdf.queryExecution().toString()
    assert "EqualTo(order_date,2024-01-05)" in day and "payload" not in day[day.index("== Physical Plan"):]


def test_checks_need_one_scan(stored):
    checks = [quality.Check("a", "total_amount < 0", "x"), quality.Check("b", "order_id IS NULL", "y")]
    assert plan(quality.evaluate(stored, checks, non_empty=True)).count("FileScan") == 1


def test_key_numbering_funnels_only_the_group_sizes(stored):
    text = plan(assign_surrogate_keys(stored, "sk", ["order_id"], digits=2))
    lines = text.splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert len(single) == 1 and "HashAggregate(keys=[_group" in lines[single[0] + 1]


def test_no_python_in_any_plan(spark):
    import __spark_entry__ as entry

    for name in ("scd2_change_feed", "fact_unresolved", "strict_conform", "crm_explode"):
        assert "Python" not in plan(entry.queries()[name](spark, "/root/testdata/sf0.001")), name


def exchanged(text, key):
    """The lines under each shuffle by ``key``, the nearest projection of what it carries among them."""
    lines = text.splitlines()
    return ["\n".join(lines[i + 1 : i + 7]) for i, line in enumerate(lines) if f"Exchange hashpartitioning({key}#" in line]


def test_line_items_are_not_shuffled_for_customers(spark, tmp_path):
    """Orders meet their customers first; line items are shuffled for their parts and their orders only."""
    from testbed.tables import derive_bronze

    tables = {
        "lineitem": "SELECT 1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 5D l_quantity, 10.5D l_extendedprice, 'R' l_returnflag, timestamp '1997-01-02 03:00:00' l_shipdate",
        "orders": "SELECT 1L o_orderkey, 7L o_custkey, 'F' o_orderstatus, timestamp '1997-01-01' o_orderdate",
        "customer": "SELECT c c_custkey, 0 c_nationkey FROM VALUES (7L), (7L), (8L) AS t(c)",
        "nation": "SELECT 0 n_nationkey, 1 n_regionkey",
        "region": "SELECT 1 r_regionkey, 'ASIA' r_name",
        "part": "SELECT 2L p_partkey, 2.25D p_retailprice",
    }
    for name, sql in tables.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bronze = derive_bronze(spark, str(tmp_path))
        text = plan(bronze)
        rows = bronze.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_customer = exchanged(text, "o_custkey")
    assert len(by_customer) == 1 and "l_orderkey" not in by_customer[0]
    assert len(rows) == 2 and set(rows) == {rows[0]}  # a customer that comes twice doubles its orders, as ever
    assert (str(rows[0].unit_price), str(rows[0].total_amount), rows[0].status, rows[0].currency) == ("2.2500", "10.5000", "REFD", "USD")


def test_batches_are_shuffled_without_date_parts_and_source_columns(spark, raw, rates):
    from tallyworks.plans.silver import stage_orders

    staged = stage_orders(raw, rates, "2024-03-01", RUN)
    carried = exchanged(plan(staged), "order_id")
    assert len(carried) == 1 and "order_year" not in carried[0] and "order_month" not in carried[0]
    found = {r.order_id: (r.order_year, r.order_month) for r in staged.collect()}
    assert found["A1"] == (2024, 2) and found["A3"] == (2023, 12)
