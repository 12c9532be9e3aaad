import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tallyworks.session import build_session  # noqa: E402

RUN = datetime(2024, 3, 2, 4, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def raw(spark):
    """Six deliveries of five orders, all as text; order A1 comes twice."""
    return spark.sql(
        """SELECT *, cast(ts AS timestamp) AS _ingestion_ts, cast(ts AS date) AS ingestion_date,
                  'B-' || substr(ts, 12, 2) AS _source_file, false AS _is_deleted
           FROM VALUES
             ('A1', '2024-02-27', 'C7', 'P3', '4.0',  '12.5', '50.0',  'USD', ' comp', 'APAC', 'R1', '2024-03-01 07:00:00'),
             ('A1', '2024-02-27', 'C7', 'P3', '5.0',  '12.5', '62.5',  'USD', 'COMP',  'APAC', 'R1', '2024-03-01 11:00:00'),
             ('A2', '2024-02-28', 'C8', 'P4', '1.0',  '80.0', '80.0',  'EUR', 'p',     'EMEA', 'R2', '2024-03-01 07:00:00'),
             ('A3', '2023-12-31', 'C9', 'P3', '2.5',  '10.0', '25.0',  'GBP', 'Canc',  NULL,   NULL, '2024-03-01 07:00:00'),
             ('A4', '2024-01-05', 'C9', 'P4', '0.0',  '10.0', '-1.0',  'JPY', 'R',     'AMER', 'R2', '2024-03-01 07:00:00'),
             ('A5', '2024-01-05', 'C7', 'P4', 'many', '10.0', '10.0',  'CAD', 'held',  'AMER', 'R2', '2024-03-01 07:00:00')
           AS t(order_id, order_date, customer_id, product_id, quantity, unit_price, total_amount, currency, status,
                region, sales_rep_id, ts)"""
    ).drop("ts")


@pytest.fixture
def rates(spark):
    return spark.sql(
        """SELECT cast(d AS date) AS rate_date, c AS from_currency, cast(r AS double) AS rate_to_usd FROM VALUES
           ('2024-03-01', 'EUR', 1.1), ('2024-03-01', 'GBP', 1.25), ('2024-03-01', 'USD', 1.0),
           ('2024-02-29', 'EUR', 1.3) AS t(d, c, r)"""
    )


def by(df, key="order_id"):
    return {r[key]: r for r in df.collect()}
