"""Writers: table replacement, catalog tables, versioned snapshots, ledger, archive."""

from lakeload.sinks.tables import (
    archive_batch,
    create_databases,
    drop_table,
    replace_table,
    save_table,
)
from lakeload.sinks.versioned import VersionedTable
from lakeload.sinks.ledger import Ledger

__all__ = [
    "archive_batch",
    "create_databases",
    "drop_table",
    "replace_table",
    "save_table",
    "VersionedTable",
    "Ledger",
]
