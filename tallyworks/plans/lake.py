"""Where the tables of all layers live."""

from __future__ import annotations

from dataclasses import dataclass

from tallyworks.contracts import (
    BRONZE_ORDERS,
    DAILY_SUMMARY,
    DATE,
    DIM_CUSTOMER,
    DIM_DATE,
    DIM_EMPLOYEE,
    DIM_PRODUCT,
    FACT_ORDERS,
    LONG,
    SILVER_ORDERS,
    STR,
    TS,
    TableContract,
    columns,
)
from tallyworks.operators.late import DELIVERED
from tallyworks.operators.scd2 import SILVER_HISTORY
from tallyworks.sources.feed import ChangeFeed
from tallyworks.sources.files import CRM_ACCOUNTS
from tallyworks.sources.landing import Landing, quarantine_at
from tallyworks.sources.snapshots import SnapshotTable

# Gold tables are stored by month; the month column exists in storage only.
MONTH = "_month"


def _with(schema, *more):
    return columns(*[(f.name, f.dataType, f.nullable) for f in schema], *more)


def _by_month(schema):
    return _with(schema, (MONTH, STR))


# Deliveries may carry the representative, which the contract does not list but silver needs.
STORED_ORDERS = TableContract(
    name=BRONZE_ORDERS.name,
    schema=columns(
        *[(f.name, f.dataType, f.nullable) for f in BRONZE_ORDERS.schema if f.name != "ingestion_date"],
        ("sales_rep_id", STR),
        ("ingestion_date", BRONZE_ORDERS.schema["ingestion_date"].dataType, False),
    ),
    partition_by=BRONZE_ORDERS.partition_by,
)
STORED_ACCOUNTS = _with(CRM_ACCOUNTS, ("_ingestion_ts", TS), ("_source_file", STR), ("ingestion_date", DATE))

# Silver keeps when a version was delivered, which the contract does not list, so that late versions find their place.
STORED_SILVER = TableContract(
    name=SILVER_ORDERS.name,
    schema=_with(SILVER_ORDERS.schema, (DELIVERED, TS)),
    primary_key=SILVER_ORDERS.primary_key,
    partition_by=SILVER_ORDERS.partition_by,
    not_null=SILVER_ORDERS.not_null,
    row_checks=SILVER_ORDERS.row_checks,
)


@dataclass(frozen=True)
class Lake:
    """Base folder of one environment."""

    root: str

    @property
    def bronze_orders(self) -> Landing:
        return Landing(f"{self.root}/bronze/sales_orders_raw", STORED_ORDERS.schema)

    @property
    def bronze_accounts(self) -> Landing:
        return Landing(f"{self.root}/bronze/crm_accounts_raw", STORED_ACCOUNTS)

    def files(self, name: str, schema) -> Landing:
        """Rows of delivered files of one kind."""
        return Landing(f"{self.root}/bronze/files_{name}", _with(schema, ("_ingestion_ts", TS), ("_source_file", STR), ("ingestion_date", DATE)))

    def quarantine(self, name: str) -> Landing:
        """What of an input could not be used."""
        return quarantine_at(f"{self.root}/quarantine/{name}")

    @property
    def archived_orders(self) -> SnapshotTable:
        """Aged bronze rows by ingestion date; the state of the table is the ledger of what has been copied."""
        return SnapshotTable(f"{self.root}/archive/sales_orders_raw", STORED_ORDERS.schema, ("ingestion_date",))

    @property
    def silver_orders(self) -> SnapshotTable:
        """Current rows and history lie apart: closed rows are added to theirs, which a merge neither reads nor writes."""
        return SnapshotTable(
            f"{self.root}/silver/sales_orders_cleansed",
            STORED_SILVER.schema,
            (SILVER_HISTORY.is_current, *STORED_SILVER.partition_by),
            ("order_date", "customer_id", "product_id"),
        )

    @property
    def silver_changes(self) -> ChangeFeed:
        return ChangeFeed(f"{self.root}/silver/sales_orders_changes", STORED_SILVER.schema)

    @property
    def control(self) -> str:
        """The run log: a folder of its own for each write, so that jobs which end together do not meet."""
        return f"{self.root}/ctrl/pipeline_runs"

    @property
    def gold_progress(self) -> SnapshotTable:
        """The states of silver and the dimensions that the fact reflects; 0 while it has to be rebuilt."""
        names = ("silver_version", "customer_version", "product_version", "employee_version")
        return SnapshotTable(f"{self.root}/ctrl/gold_progress", columns(*[(n, LONG) for n in names]))

    @property
    def customers(self) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/dim/customer", DIM_CUSTOMER.schema, key="customer_sk")

    @property
    def products(self) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/dim/product", DIM_PRODUCT.schema, key="product_sk")

    @property
    def employees(self) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/dim/employee", DIM_EMPLOYEE.schema, key="employee_sk")

    @property
    def dates(self) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/dim/date", DIM_DATE.schema)

    @property
    def fact_orders(self) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/fact/sales_orders", _by_month(FACT_ORDERS.schema), (MONTH,),
                             ("order_date", "customer_sk", "product_sk"), "sales_order_sk")

    @property
    def unresolved(self) -> SnapshotTable:
        """Current orders whose customer or product is not known yet."""
        schema = _with(SILVER_ORDERS.schema, ("unresolved", STR), ("run_id", STR))
        return SnapshotTable(f"{self.root}/fact/sales_orders_waiting", schema)

    @property
    def daily_summary(self) -> SnapshotTable:
        return SnapshotTable(f"{self.root}/agg/sales_daily_summary", _by_month(DAILY_SUMMARY.schema), (MONTH,),
                             ("order_date", "region", "category"), "summary_sk")

    @property
    def summary_due(self) -> SnapshotTable:
        """Dates whose facts changed since the summary was refreshed."""
        return SnapshotTable(f"{self.root}/agg/sales_daily_summary_due", columns(("order_date", DATE)))

    def reference(self, name: str) -> str:
        return f"{self.root}/bronze/reference_{name}"
