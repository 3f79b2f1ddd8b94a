from orderflow.sources.areas import read_area, write_by_area
from orderflow.sources.buckets import write_bucketed
from orderflow.sources.dimensions import SNAPSHOTS, Snapshot
from orderflow.sources.sinks import append_new, append_rows, replace_slice, work_database
from orderflow.sources.snapshots import conform, empty_text_as_null, refresh_snapshot
from orderflow.sources.versions import Store, VersionConflict

__all__ = [
    "SNAPSHOTS", "Snapshot", "Store", "VersionConflict", "append_new", "append_rows", "conform", "empty_text_as_null",
    "read_area", "refresh_snapshot", "replace_slice", "work_database", "write_bucketed", "write_by_area",
]
