from seismark.functions.text import area_regex, area_split, state_suffix
from seismark.functions.times import (
    date_stamp,
    epoch_ms_pair,
    epoch_ms_to_string,
    epoch_ms_to_timestamp,
    event_date,
    month_day,
)

__all__ = [
    "area_regex", "area_split", "state_suffix",
    "date_stamp", "epoch_ms_pair", "epoch_ms_to_string", "epoch_ms_to_timestamp", "event_date",
    "month_day",
]
