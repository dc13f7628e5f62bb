"""Column-level functions (inventory X1-X10, F1)."""

from fieldstat.functions.columns import (  # noqa: F401
    NA_TEXT, as_integer, category_text, epoch_day, fill_missing, label_in, minutes_between,
    parse_time, paste, positive_code, time_of_day_text, time_text,
)
