from tickloom.sources.files import (
    discover_inputs,
    read_positional,
    read_runs,
    read_ticks_csv,
    read_ticks_ndjson,
    follow_ndjson,
)
from tickloom.sources.kafka import read_records, read_snapshot, write_records
from tickloom.sources.tables import (
    append_registry,
    compact_history,
    read_history,
    read_ticks,
    store_ticks,
    write_batch,
    write_sparse_csv,
)

__all__ = [
    "append_registry",
    "discover_inputs",
    "compact_history",
    "follow_ndjson",
    "read_history",
    "read_positional",
    "read_records",
    "read_runs",
    "read_snapshot",
    "read_ticks",
    "read_ticks_csv",
    "read_ticks_ndjson",
    "store_ticks",
    "write_batch",
    "write_records",
    "write_sparse_csv",
]
