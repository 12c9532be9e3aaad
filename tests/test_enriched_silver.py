"""Names join before the hash is taken, so that no digest goes through the joins' shuffles."""

from datetime import date

from conftest import RUN, by

from tallyworks.contracts import conform_to_contract
from tallyworks.plans import silver
from tallyworks.plans.lake import Lake


def test_digests_do_not_pass_the_joins_with_names(spark, raw, rates, tmp_path, monkeypatch):
    customers = spark.sql("SELECT * FROM VALUES ('C7', 'Seven', true), ('C8', 'Eight', true), ('C9', 'Old', false) AS t(customer_id, customer_name, is_current)")
    products = spark.sql("SELECT * FROM VALUES ('P3', 'Three', 'Toys', true), ('P9', 'Nine', 'Toys', true) AS t(product_id, product_name, category, is_current)")
    plans = []

    def conform(df, contract):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return conform_to_contract(df, contract)

    monkeypatch.setattr(silver, "conform_to_contract", conform)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lake, day = Lake(str(tmp_path / "named")), date(2024, 3, 1)
        silver.build_silver(spark, lake, rates, day, RUN, full_refresh=True, bronze=raw, customers=customers, products=products)
        plain = Lake(str(tmp_path / "plain"))
        silver.build_silver(spark, plain, rates, day, RUN, full_refresh=True, bronze=raw)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = plans[0].index("SortMergeJoin")
    assert plans[0].count("SortMergeJoin") == 2 and "md5(" in plans[0][:joins] and "md5(" not in plans[0][joins:]
    named, hashes = by(lake.silver_orders.read(spark)), by(plain.silver_orders.read(spark))
    assert {k: r._source_hash for k, r in named.items()} == {k: r._source_hash for k, r in hashes.items()}
    assert (named["A1"].customer_name, named["A1"].category, named["A2"].customer_name, named["A2"].category) == ("Seven", "Toys", "Eight", None)
    assert named["A3"].customer_name is None and named["A3"].product_name == "Three"
