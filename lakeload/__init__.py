"""lakeload — layered lake tables (raw, silver, gold) on plain Spark.

Full loads, change-data-capture merges with metrics, change feeds and versioned
snapshots over parquet, gold tables from joins and aggregations, and rule-driven
data-quality reports, all expressed as DataFrame plans.
"""

from lakeload.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
