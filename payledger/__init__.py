"""payledger: accounts-payable / receivable analytics on ERP finance tables, on Spark.

Every dataset is a plain function ``(tables, cfg) -> DataFrame`` built from the
DataFrame API, so Catalyst prunes columns, pushes filters into the parquet scans
and AQE picks join strategies at run time.
"""

from payledger.config import LedgerConfig

__all__ = ["LedgerConfig"]
