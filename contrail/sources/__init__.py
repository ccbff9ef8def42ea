from contrail.sources.files import file_fingerprints
from contrail.sources.io import (
    read_flights, read_versions, source_stats, union_versions, write_report, write_table,
)
from contrail.sources.tables import DRIVER_TABLES, read_table

__all__ = [
    "DRIVER_TABLES", "file_fingerprints", "read_flights", "read_table", "read_versions", "source_stats",
    "union_versions", "write_report", "write_table",
]
