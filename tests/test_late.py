"""Late versions go between those held, whatever the order of the runs."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from conftest import by
from pyspark.sql import functions as F
from test_jobs import DAY1, DAY2, DAY3, at, rates, source

from tallyworks.operators import late, scd2
from tallyworks.plans import ingest, silver
from tallyworks.plans.lake import Lake

SCHEMA = (
    "order_id string, note string, _valid_from timestamp, _valid_to timestamp, _is_current boolean, "
    "_updated_ts timestamp, _source_hash string, _delivered_ts timestamp"
)
DAY = datetime(2024, 5, 1)


def delivered(days):
    return DAY + timedelta(days=days)


def staged(spark, rows, day):
    """Rows (key, hash, next delivery's day or None) delivered on ``day`` and run at its noon."""
    run = delivered(day) + timedelta(hours=12)
    made = [(k, f"{k}{h}{day}", run, None, True, run, h, delivered(day), n and delivered(n)) for k, h, n in rows]
    return spark.createDataFrame(made, SCHEMA + ", _next_delivery_ts timestamp")


def test_any_order_of_days_gives_the_same_current_rows_and_a_gapless_history(spark):
    """Random deliveries of five days, run in several orders; each run knows the deliveries of the days run before it."""
    rng = random.Random(4)
    plan = {(k, d): rng.choice("ABC") for k in map(str, range(30)) for d in range(1, 6) if rng.random() < 0.6}
    newest = {k: plan[k, max(d for x, d in plan if x == k)] for k, _ in plan}
    orders = [(1, 2, 3, 4, 5), (5, 4, 3, 2, 1), (2, 4, 1, 5, 3), (3, 3, 1, 2, 5, 4, 2)]
    for order in orders:
        table, done = spark.createDataFrame([], SCHEMA), set()
        for place, day in enumerate(order):
            rows = []
            for (k, d), h in sorted(plan.items()):
                if d == day:
                    rows.append((k, h, min((x for key, x in plan if key == k and x > d and x in done), default=None)))
            run = datetime(2024, 6, 1) + timedelta(days=place)
            batch = staged(spark, rows, day).withColumns({"_valid_from": scd2.utc_literal(run), "_updated_ts": scd2.utc_literal(run)})
            # Checkpointed by hand: seven merges in one plan are slow to plan.
            table = spark.createDataFrame(late.merge_by_delivery(table, batch, run).collect(), SCHEMA)
            done.add(day)
        held = table.collect()
        current = {r.order_id: r._source_hash for r in held if r._is_current}
        assert current == newest and len([r for r in held if r._is_current]) == len(newest), order
        for key, group in itertools.groupby(sorted(held, key=lambda r: (r.order_id, r._delivered_ts)), key=lambda r: r.order_id):
            line = list(group)
            for one, two in itertools.pairwise(line):
                assert one._valid_to == two._valid_from and one._valid_from <= one._valid_to, (order, key)
                assert one._source_hash != two._source_hash, (order, key)
            assert line[-1]._is_current and line[-1]._valid_to is None
            want = [h for h, _ in itertools.groupby(plan[key, d] for d in range(1, 6) if (key, d) in plan)]
            assert [r._source_hash for r in line] == want, (order, key)


def test_in_order_it_is_the_plain_merge(spark):
    first = staged(spark, [("a", "A", None), ("b", "B", None)], 1).drop("_next_delivery_ts")
    second = staged(spark, [("a", "X", None), ("b", "B", None), ("c", "C", None)], 2).drop("_next_delivery_ts")
    run = delivered(2) + timedelta(hours=12)
    got, want = late.merge_by_delivery(first, second, run), scd2.merge(first, second, run)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_keys_that_are_null_repeated_or_without_hash(spark):
    held = staged(spark, [(None, "A", None), ("n", None, None)], 3).drop("_next_delivery_ts")
    batch = staged(spark, [(None, "B", None), ("n", "B", None)], 4)
    got = late.merge_by_delivery(held, batch, delivered(9)).collect()
    assert sorted((str(r.order_id), str(r._source_hash), r._is_current) for r in got) == [("None", "A", True), ("None", "B", True), ("n", "None", True)]
    with pytest.raises(Exception, match="staged keys are not unique"):
        late.merge_by_delivery(held, batch.unionByName(batch), delivered(9)).collect()
    assert late.merge_by_delivery(held.where("false"), batch.where("false"), delivered(9)).count() == 0
    assert late.merge_by_delivery(held.where("false"), batch, delivered(9)).count() == 2


def test_the_next_delivery_is_the_last_of_its_batch(spark):
    batch = staged(spark, [("a", "A", None), ("b", "A", None), ("c", "A", None)], 1).drop("_next_delivery_ts")
    rows = [("a", 2, 1), ("a", 2, 5), ("a", 3, 1), ("b", 1, 0), ("z", 2, 1)]
    later = spark.createDataFrame([(k, delivered(d) + timedelta(hours=h), delivered(d).date()) for k, d, h in rows],
                                  "order_id string, _ingestion_ts timestamp, ingestion_date date")
    got = by(late.with_next_delivery(batch, later))
    assert got["a"]._next_delivery_ts == delivered(2) + timedelta(hours=5)
    assert got["b"]._next_delivery_ts is None and got["c"]._next_delivery_ts is None


def order(status, day, order_date="2024-02-10", quantity=2):
    return ("A1", order_date, "C1", "P1", quantity, 10, "USD", status, "EMEA", "R1", at(day, 1))


def test_days_two_three_two(spark, tmp_path):
    """The second day run again after the third changes nothing; run late for the first time, it makes history only."""
    lake = Lake(str(tmp_path))
    for rows, day in (([order("C", DAY1)], DAY1), ([order("P", DAY2)], DAY2), ([order("C", DAY3)], DAY3)):
        ingest.ingest_orders(spark, lake, source(spark, *rows), at(day))
    for day in (DAY1, DAY2, DAY3):
        silver.build_silver(spark, lake, rates(spark), day, at(day, 4))
    before, versions = lake.silver_orders.read(spark).collect(), lake.silver_orders.versions(spark)
    assert [r.status for r in before if r._is_current] == ["Completed"]
    assert silver.build_silver(spark, lake, rates(spark), DAY2, at(DAY3, 9)).rows == 0
    assert lake.silver_orders.versions(spark) == versions

    other = Lake(str(tmp_path / "other"))
    for rows, day in (([order("C", DAY1)], DAY1), ([order("P", DAY2, "2024-01-10")], DAY2), ([order("C", DAY3)], DAY3)):
        ingest.ingest_orders(spark, other, source(spark, *rows), at(day))
    for day in (DAY1, DAY3):
        silver.build_silver(spark, other, rates(spark), day, at(day, 4))
    assert other.silver_orders.read(spark).count() == 1  # the third day confirmed the first
    assert silver.build_silver(spark, other, rates(spark), DAY2, at(DAY3, 9)).rows == 1
    line = sorted(other.silver_orders.read(spark).collect(), key=lambda r: r._valid_from)
    assert [(r.status, r.order_month, r._is_current) for r in line] == [("Completed", 2, False), ("Pending", 1, False), ("Completed", 2, True)]
    assert [r._valid_to for r in line] == [line[1]._valid_from, line[2]._valid_from, None]
    # the ingestion time counts: rows of one extract are delivered when the extract runs
    assert [r._valid_from for r in line] == [at(DAY1, 4), at(DAY2), at(DAY3)]
    assert other.silver_orders.read(spark).where(F.col("_is_current")).count() == 1


def test_a_merge_shuffles_the_table_once(spark, tmp_path):
    """Rows of other keys, of null keys and rows that come twice pass; nothing joins the table to find them."""
    run = delivered(2) + timedelta(hours=12)
    rows = [("a", "A"), ("b", "A"), ("b", "A"), (None, "A"), (None, "A"), ("c", None), ("d", "A")]
    spark.createDataFrame([(k, "n", run, None, True, run, h, delivered(2)) for k, h in rows], SCHEMA).write.parquet(str(tmp_path / "t"))
    held, batch = spark.read.parquet(str(tmp_path / "t")), staged(spark, [("a", "B", None), (None, "B", None)], 3)
    merged = late.merge_by_delivery(held, batch, delivered(9))
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1
    found = [(r.order_id, r._source_hash, r._is_current) for r in merged.collect()]
    others = [("b", "A", True)] * 2 + [(None, "A", True)] * 2 + [(None, "B", True), ("c", None, True), ("d", "A", True)]
    assert sorted(found, key=str) == sorted([("a", "A", False), ("a", "B", True), *others], key=str)


def test_the_next_delivery_takes_one_reading_of_the_batch(spark, tmp_path):
    staged(spark, [("a", "A", None), ("b", "A", None), (None, "A", None)], 1).drop("_next_delivery_ts").write.parquet(str(tmp_path / "batch"))
    later = spark.createDataFrame([("a", delivered(1), 1), ("a", delivered(3), 3), ("a", delivered(4), 3), ("a", delivered(5), 5), (None, delivered(3), 3)], "order_id string, _ingestion_ts timestamp, batch int")
    found = late.with_next_delivery(spark.read.parquet(str(tmp_path / "batch")), later, batch="batch")
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.order_id: r._next_delivery_ts for r in found.collect()} == {"a": delivered(4), "b": None, None: None}
