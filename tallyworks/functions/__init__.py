from tallyworks.functions.columns import (
    STATUS_BY_CODE,
    STRICT_STATUS_CODES,
    date_key,
    default_processing_date,
    iso_date,
    margin_percent,
    new_run_id,
    row_hash,
    standardise_status,
    standardise_status_strict,
    to_usd,
    year_month,
    year_quarter,
)

__all__ = [
    "STATUS_BY_CODE",
    "STRICT_STATUS_CODES",
    "date_key",
    "default_processing_date",
    "iso_date",
    "margin_percent",
    "new_run_id",
    "row_hash",
    "standardise_status",
    "standardise_status_strict",
    "to_usd",
    "year_month",
    "year_quarter",
]
