"""Raw marketplace tables: schemas, readers, writers and test fixtures."""

from bazaar.sources.catalog import load_sources, read_bucketed, read_raw, staged, write_bucketed, write_sources
from bazaar.sources.schemas import RAW_SCHEMAS, TABLE_NAMES
from bazaar.sources.snapshots import SnapshotConflict, expire, manifest, read_snapshot, versions, write_snapshot

__all__ = [
    "load_sources", "read_bucketed", "read_raw", "staged", "write_bucketed", "write_sources", "RAW_SCHEMAS", "TABLE_NAMES",
    "SnapshotConflict", "expire", "manifest", "read_snapshot", "versions", "write_snapshot",
]
