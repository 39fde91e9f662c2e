from tickloom.functions.hashing import partition_of
from tickloom.functions.text import blank_to_null, strip
from tickloom.functions.times import (
    date_text,
    epoch_millis,
    event_instant,
    iso_local,
    local_to_instant,
    parse_local,
    wall_clock,
)

__all__ = [
    "blank_to_null",
    "date_text",
    "epoch_millis",
    "event_instant",
    "iso_local",
    "local_to_instant",
    "parse_local",
    "partition_of",
    "strip",
    "wall_clock",
]
