from raceway.streaming.late import WINDOW, read_late, read_windows, write_windows
from raceway.streaming.live import (
    compact_changes,
    dedupe_stream,
    land_stream,
    latest_stream,
    open_stream,
    read_changes,
    run_available,
    window_mean,
    write_changes,
)
from raceway.streaming.snapshot import read_snapshot, upsert, write_snapshot

__all__ = [
    "WINDOW",
    "compact_changes",
    "dedupe_stream",
    "land_stream",
    "latest_stream",
    "open_stream",
    "read_changes",
    "read_late",
    "read_snapshot",
    "read_windows",
    "run_available",
    "upsert",
    "window_mean",
    "write_changes",
    "write_snapshot",
    "write_windows",
]
