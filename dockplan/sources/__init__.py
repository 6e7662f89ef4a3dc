"""Sources: logical schemas, storage scans, and the driver-table bindings."""

from dockplan.sources.bindings import AS_OF, SITE, DriverTables, bind
from dockplan.sources.layout import read_layout, write_layout
from dockplan.sources.schemas import SCHEMAS
from dockplan.sources.tables import at_location, at_snapshot, in_horizon, read_tables

__all__ = [
    "AS_OF",
    "SITE",
    "DriverTables",
    "bind",
    "SCHEMAS",
    "at_location",
    "at_snapshot",
    "in_horizon",
    "read_layout",
    "read_tables",
    "write_layout",
]
