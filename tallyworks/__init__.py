"""Sales-order lakehouse on PySpark: bronze extracts, SCD2 silver, gold star schema and reports."""
