from tallyworks.sources.database import max_watermark, read_database_table, window_extract
from tallyworks.sources.files import (
    append_bronze,
    crm_accounts,
    read_crm_accounts,
    read_crm_responses,
    read_customers_csv,
    read_orders_csv,
    read_product_catalogue,
    recently_modified,
    unpack_records,
)
from tallyworks.sources.layout import cluster_rewrite, retention_tiers, stored_bytes
from tallyworks.sources.snapshots import SnapshotTable
from tallyworks.sources.tables import incremental_scan, read_table

__all__ = [
    "SnapshotTable",
    "append_bronze",
    "cluster_rewrite",
    "crm_accounts",
    "incremental_scan",
    "max_watermark",
    "read_crm_accounts",
    "read_crm_responses",
    "read_customers_csv",
    "read_database_table",
    "read_orders_csv",
    "read_product_catalogue",
    "read_table",
    "recently_modified",
    "retention_tiers",
    "stored_bytes",
    "unpack_records",
    "window_extract",
]
