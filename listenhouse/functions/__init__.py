"""Column functions; all of them built from native Spark expressions."""

from listenhouse.functions.keys import (
    artist_key, filled_location_key, location_key, song_key, surrogate_key,
)
from listenhouse.functions.text import repair_text
from listenhouse.functions.time import (
    date_key, date_key_string, forever, from_epoch_millis, gap_seconds, hour_start, time_parts,
)

__all__ = [
    "artist_key", "date_key", "date_key_string", "filled_location_key", "forever",
    "from_epoch_millis", "gap_seconds", "hour_start", "location_key", "repair_text",
    "song_key", "surrogate_key", "time_parts",
]
