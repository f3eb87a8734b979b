"""Reading landed captures and reading or writing stored tables."""

from .landing import read_landing, stream_landing, write_dead_letters, write_landing
from .snapshot_files import SnapshotFiles, read_snapshots, register, stream_snapshots
from .tables import (
    append_stream,
    current_version,
    drop_old_versions,
    read_current,
    read_table,
    refresh,
    save_clustered_table,
    stream_table,
    write_clustered,
)

__all__ = [
    "SnapshotFiles",
    "append_stream",
    "current_version",
    "drop_old_versions",
    "read_current",
    "read_landing",
    "read_snapshots",
    "read_table",
    "refresh",
    "register",
    "save_clustered_table",
    "stream_landing",
    "stream_snapshots",
    "stream_table",
    "write_clustered",
    "write_dead_letters",
    "write_landing",
]
