import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import RUN
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyworks import sources as src
from tallyworks.contracts import (
    BRONZE_ORDERS,
    MONEY,
    SILVER_ORDERS,
    STR,
    TableContract,
    columns,
    conform_strict,
    conform_to_contract,
)
from tallyworks.sources.database import bounds_query, jdbc_options, max_watermark_query, narrowed, query_options, range_predicates
from tallyworks.sources.layout import cluster_rewrite, files_for, retention_tiers, stored_bytes


def test_jdbc_options():
    plain = jdbc_options("jdbc:x:y", "dbo.SalesOrders")
    assert plain["fetchsize"] == "50000" and plain["queryTimeout"] == "7200" and "numPartitions" not in plain
    split = jdbc_options("jdbc:x:y", "t", ("ID", "1", "900", 8), fetch_rows=10, properties={"user": "u"})
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("ID", "1", "900", "8")
    assert split["fetchsize"] == "10" and split["user"] == "u"


def test_ranges_from_the_sources_own_bounds(spark):
    asked = query_options("jdbc:x:y", bounds_query("dbo.Orders", "ID", "AEDAT", datetime(2024, 1, 1)), fetch_rows=10)
    assert asked["query"] == "SELECT MIN(ID) AS lower_bound, MAX(ID) AS upper_bound FROM dbo.Orders WHERE AEDAT > '2024-01-01 00:00:00'"
    assert "dbtable" not in asked and asked["fetchsize"] == "10"
    assert max_watermark_query("dbo.Orders", "AEDAT") == "SELECT MAX(AEDAT) AS max_watermark FROM dbo.Orders"
    for bad in ("x; drop", "a b", "1a", "", "a.", "a--"):
        with pytest.raises(ValueError, match="plain name"):
            max_watermark_query(bad, "AEDAT")
    ids = spark.sql("SELECT CASE WHEN id < 90 THEN id - 5 END AS ID, timestamp_seconds(id * 1000) AS AEDAT FROM range(100)")
    span = [(-5, 84, n) for n in (1, 2, 7, 120)] + [(3, 3, 4), (0, 1, 3), (None, None, 5)]
    for lower, upper, parts in span:
        conditions = range_predicates("ID", lower, upper, parts)
        assert len(conditions) <= parts
        counts = [ids.where(c).count() for c in conditions]
        assert sum(counts) == 100, (lower, upper, parts, counts)
    times = range_predicates("AEDAT", datetime(1970, 1, 1), datetime(1970, 1, 2), 4)
    assert len(times) == 4 and "'1970-01-01 06:00:00'" in times[0]
    assert sum(ids.where(c.replace("'1970", "timestamp '1970")).count() for c in times) == 100


def test_watermark_and_columns_narrow_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("SELECT id, timestamp '2024-01-01' + make_interval(0,0,0,cast(id AS int)) AS AEDAT, id * 2 AS x FROM range(10)").write.parquet(path)
    t = spark.read.parquet(path)
    assert narrowed(t).count() == 10
    assert narrowed(t, watermark_column="AEDAT").count() == 10
    assert narrowed(t, watermark_value="2024-01-05 00:00:00").count() == 10
    got = narrowed(t, ["id"], "AEDAT", "2024-01-05 00:00:00")
    assert sorted(r.id for r in got.collect()) == [5, 6, 7, 8, 9] and got.columns == ["id"]
    assert narrowed(t, None, "AEDAT", datetime(2024, 1, 9)).count() == 1
    empty = narrowed(t, None, "AEDAT", datetime(2030, 1, 1))
    assert empty.count() == 0 and empty.columns == t.columns
    assert src.max_watermark(t, "AEDAT").collect()[0].max_watermark == "2024-01-10 00:00:00"
    assert src.max_watermark(empty, "AEDAT").collect()[0].max_watermark is None


def test_extract_window_is_open_below_and_closed_above(spark):
    t = spark.sql("SELECT cast(d AS timestamp) AS AEDAT FROM VALUES ('2024-01-01'), ('2024-01-02'), ('2024-01-03'), (NULL) AS t(d)")
    rows = src.window_extract(t, "AEDAT", datetime(2024, 1, 1), datetime(2024, 1, 2), "RUN-1", RUN).collect()
    assert [(r.AEDAT, r._ingestion_ts, r._source_file, r._is_deleted) for r in rows] == [
        (datetime(2024, 1, 2), RUN, "RUN-1", False)
    ]


def test_csv_sources(spark, tmp_path):
    (tmp_path / "o.csv").write_text(
        "order_id,order_date,customer_id,customer_name,product_id,product_name,category,quantity,unit_price,"
        "total_amount,currency,status,region,sales_rep_id,sales_rep_name\n"
        'O1,2024-02-03,C1,"Söhne, Inc",P1,Bolt,Parts,3,1.50,4.50,EUR,Completed,EMEA,R1,Zoë\n',
        encoding="utf-8",
    )
    row = src.read_orders_csv(spark, str(tmp_path / "o.csv")).collect()[0]
    assert (row.order_date, row.customer_name, row.unit_price) == (date(2024, 2, 3), "Söhne, Inc", Decimal("1.5000"))
    (tmp_path / "c.csv").write_text(
        "customer_id,customer_name,account_type,industry,country,city,region,email,phone,account_manager_id,"
        "credit_limit,currency,is_active,created_date,last_modified_date\n"
        "C1,One,Standard,Toys,DE,Bonn,EMEA,a@b.example,,R1,1000,EUR,true,2020-01-01,2024-01-01\n"
    )
    row = src.read_customers_csv(spark, str(tmp_path / "c.csv")).collect()[0]
    assert (row.credit_limit, row.is_active, row.phone) == (Decimal("1000.00"), True, None)


def test_json_envelopes(spark, tmp_path):
    doc = {"schema_version": "9", "products": [{"product_id": "P1", "cost_price": 1.5}, {"product_id": "P2", "weight_kg": None}]}
    (tmp_path / "p.json").write_text(json.dumps(doc, indent=2))
    rows = src.read_product_catalogue(spark, str(tmp_path / "p.json")).collect()
    assert [(r.product_id, r.cost_price) for r in rows] == [("P1", 1.5), ("P2", None)]
    records = [
        {"attributes": {"type": "Account", "url": f"/{i}"}, "Id": i, "LastModifiedDate": f"2024-02-{d}T10:00:00.000+0000"}
        for i, d in (("a", "20"), ("b", "28"))
    ]
    (tmp_path / "crm.json").write_text(json.dumps({"done": True, "total_size": 2, "records": records}, indent=1))
    accounts = src.read_crm_accounts(spark, str(tmp_path / "crm.json"))
    assert {r.Id: r.record_url for r in accounts.collect()} == {"a": "/a", "b": "/b"}
    recent = src.recently_modified(accounts, RUN).collect()
    assert [(r.Id, r.LastModifiedDate) for r in recent] == [("b", datetime(2024, 2, 28, 10))]


def test_tables_by_name_and_path(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert src.read_table(spark, str(tmp_path / "t")).count() == 3
    spark.range(2).createOrReplaceTempView("two_rows")
    assert src.read_table(spark, "two_rows").count() == 2


def test_bronze_append_spreads_one_date_and_prunes(spark, tmp_path):
    path = str(tmp_path / "b")
    batch = spark.range(1000).select("id", F.lit(RUN).alias("_ingestion_ts"))
    src.append_bronze(batch, path)
    src.append_bronze(batch.withColumn("ingestion_date", F.lit(date(2024, 3, 1))), path)
    back = spark.read.parquet(path)
    assert back.count() == 2000
    day = src.incremental_scan(back, date(2024, 3, 2))
    assert day.count() == 1000 and src.incremental_scan(back, date(2024, 3, 2), True).count() == 2000
    assert "PartitionFilters: [isnotnull(ingestion_date" in day._jdf.queryExecution().toString()


STATE = T.StructType([T.StructField("k", T.StringType()), T.StructField("x", T.LongType()), T.StructField("m", T.IntegerType())])


def state(df):
    return sorted(map(tuple, df.collect()))


def test_snapshot_table_states(spark, tmp_path):
    t = src.SnapshotTable(str(tmp_path / "t"), STATE, ("m",), ("x",))
    assert not t.exists(spark) and t.read(spark).count() == 0
    t.overwrite(spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("c", 3, 2)], STATE))
    t.replace_partitions(spark.createDataFrame([("d", 4, 2)], STATE), [(2,)])
    assert state(t.read(spark)) == [("a", 1, 1), ("d", 4, 2)]
    assert state(t.read(spark, [(2,)])) == [("d", 4, 2)]
    assert state(t.read(spark, version=1)) == [("a", 1, 1), ("b", 2, 2), ("c", 3, 2)]
    assert t.manifest(spark) == {"m=1": (1,), "m=2": (2,)}
    # A state may be built from the one it replaces.
    t.replace_partitions(t.read(spark, [(1,)]).withColumn("x", F.col("x") + 1), [(1,)])
    assert state(t.read(spark)) == [("a", 2, 1), ("d", 4, 2)]
    t.replace_partitions(spark.createDataFrame([], STATE), [(2,)])
    assert state(t.read(spark)) == [("a", 2, 1)]
    t.replace_partitions(spark.createDataFrame([], STATE), [(1,)])
    assert t.exists(spark) and t.read(spark).count() == 0


def test_rows_are_added_to_partitions(spark, tmp_path):
    t = src.SnapshotTable(str(tmp_path / "t"), STATE, ("m",))
    t.overwrite(spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("c", 3, 3)], STATE))
    assert t.apply(spark.createDataFrame([("d", 4, 2), ("e", 5, 1), ("f", 6, 4)], STATE), [(2,), (3,)]) == 2
    assert state(t.read(spark)) == [("a", 1, 1), ("d", 4, 2), ("e", 5, 1), ("f", 6, 4)]
    assert t.manifest(spark) == {"m=1": (1, 2), "m=2": (2,), "m=4": (2,)}
    assert state(t.read(spark, version=1)) == [("a", 1, 1), ("b", 2, 2), ("c", 3, 3)]
    assert t.stored_bytes(spark, [(1,)]) > t.stored_bytes(spark, [(2,)]) > 0
    t.apply(t.read(spark).where("m = 9"), [(1,)])
    assert state(t.read(spark)) == [("d", 4, 2), ("f", 6, 4)] and t.versions(spark) == [1, 2, 3]
    assert {p.split("/data/")[1] for p in t.prune(spark, keep=1)} == {"v=1/m=1", "v=1/m=2", "v=1/m=3", "v=2/m=1"}


def test_a_table_knows_its_highest_key(spark, tmp_path):
    t = src.SnapshotTable(str(tmp_path / "t"), STATE, ("m",), key="x")
    assert t.highest_key(spark) == 0
    t.overwrite(spark.createDataFrame([("a", 7, 1), ("b", 2, 2)], STATE))
    t.replace_partitions(spark.createDataFrame([("c", 5, 1)], STATE), [(1,)])
    assert t.highest_key(spark) == 7  # the row is gone, its number stays given
    t.apply(spark.createDataFrame([("d", 9, 2)], STATE), [])
    t.replace_partitions(spark.createDataFrame([], STATE), [(1,), (2,)])
    assert t.highest_key(spark) == 9 and t.read(spark).count() == 0


def test_unfinished_write_stays_invisible(spark, tmp_path):
    t = src.SnapshotTable(str(tmp_path / "t"), STATE, ("m",))
    t.overwrite(spark.createDataFrame([("a", 1, 1)], STATE))
    with pytest.raises(Exception, match="boom"):
        t.overwrite(t.read(spark).where(F.raise_error(F.lit("boom")).cast("boolean")))
    with pytest.raises(ValueError, match="outside the replaced partitions"):
        t.replace_partitions(spark.createDataFrame([("z", 1, 9)], STATE), [(1,)])
    assert state(t.read(spark)) == [("a", 1, 1)]
    t.overwrite(spark.createDataFrame([("b", 2, 1)], STATE))
    assert state(t.read(spark)) == [("b", 2, 1)]


def test_pruning_keeps_what_recent_states_carry(spark, tmp_path):
    t = src.SnapshotTable(str(tmp_path / "t"), STATE, ("m",))
    t.overwrite(spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], STATE))
    for x in range(3):
        t.replace_partitions(spark.createDataFrame([("b", x, 2)], STATE), [(2,)])
    removed = t.prune(spark, keep=2)
    assert sorted(p.split("/data/")[1] for p in removed) == ["v=1/m=2", "v=2/m=2"]
    assert state(t.read(spark)) == [("a", 1, 1), ("b", 2, 2)]
    assert state(t.read(spark, version=3)) == [("a", 1, 1), ("b", 1, 2)]


def test_cluster_rewrite_keeps_rows_and_cuts_heavy_values(spark, tmp_path):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("day"), "id")
    out = cluster_rewrite(df, ["day", "id"], 4)
    assert out.rdd.getNumPartitions() == 4
    assert out.exceptAll(df).count() == 0 and out.count() == 4000
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2000
    path = str(tmp_path / "c")
    out.write.parquet(path)
    assert stored_bytes(spark.read.parquet(path)) > 1000
    assert files_for(0) == 1 and files_for(134_217_729) == 2


def test_retention_tiers(spark):
    df = spark.sql("SELECT cast(d AS date) AS ingestion_date FROM VALUES ('2024-03-01'), ('2023-12-02'), ('2023-12-01'), ('2017-03-01'), ('2017-02-28') AS t(d)")
    tiers = retention_tiers(df, date(2024, 3, 1))
    assert {k: v.count() for k, v in tiers.items()} == {"hot": 2, "archive": 2, "expired": 1}


def test_contract_projection(spark, raw):
    out = conform_to_contract(raw.withColumns({"quantity": F.lit("1"), "total_amount": F.lit(2)}), BRONZE_ORDERS)
    assert out.schema.names == BRONZE_ORDERS.names and out.schema["quantity"].dataType == MONEY
    assert len(SILVER_ORDERS.names) == 22


def test_strict_conversion_names_lossy_columns(spark):
    contract = TableContract(
        "t",
        columns(("n", MONEY), ("i", T.IntegerType()), ("d", T.DateType()), ("b", T.BooleanType()), ("s", STR, True, 3), ("z", STR)),
    )
    df = spark.sql(
        """SELECT * FROM VALUES
          ('ok',   '1.2500', 7L, timestamp '2024-01-01 00:00:00', 'abc'),
          ('n',    '1.25001', 7L, timestamp '2024-01-01 00:00:00', 'abc'),
          ('n',    'x', 7L, timestamp '2024-01-01 00:00:00', 'abc'),
          ('i',    '1', 3000000000L, timestamp '2024-01-01 00:00:00', 'abc'),
          ('d',    '1', 7L, timestamp '2024-01-01 10:00:00', 'abc'),
          ('s',    '1', 7L, timestamp '2024-01-01 00:00:00', 'abcd'),
          ('null', NULL, NULL, NULL, NULL) AS t(case, n, i, d, s)"""
    )
    for r in df.select("case").collect():
        rows = conform_strict(df.where(F.col("case") == r.case), contract).collect()
        want = [] if r.case in ("ok", "null") else [r.case]
        assert all(x._conform_errors == want for x in rows), r.case
    flagged = conform_strict(spark.sql("SELECT 1 AS b, '2024-01-01 10:00' AS d"), contract).collect()[0]
    assert flagged._conform_errors == ["d", "b"] and flagged.b is None and flagged.d is None
