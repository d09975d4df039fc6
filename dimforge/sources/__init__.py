"""Reading raw and conformed tables; snapshots and publishing."""

from dimforge.sources.catalog import RawTables, ensure_database, register_views
from dimforge.sources.raw_schemas import RAW_COLUMNS, RawColumnsMissing, declared
from dimforge.sources.snapshot import (
    PublishConflict,
    PublishUnknown,
    input_token,
    is_complete,
    preview,
    publish,
    publish_part,
    published_parts,
    remove_orphans,
    snapshot_once,
    snapshot_path,
)

__all__ = [
    "PublishConflict", "PublishUnknown", "RAW_COLUMNS", "RawColumnsMissing", "RawTables", "declared", "ensure_database", "input_token", "is_complete", "preview", "publish",
    "publish_part", "published_parts", "register_views", "remove_orphans", "snapshot_once", "snapshot_path",
]
