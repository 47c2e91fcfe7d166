from .checksum import row_checksum
from .nested import filter_elements, map_to_array, non_empty, prefix, reshape, struct_defaults
from .timecols import epoch_day, format_ms, newest_of, time_literal, year_month, year_of

__all__ = [
    "epoch_day",
    "filter_elements",
    "format_ms",
    "map_to_array",
    "newest_of",
    "non_empty",
    "prefix",
    "reshape",
    "row_checksum",
    "struct_defaults",
    "time_literal",
    "year_month",
    "year_of",
]
