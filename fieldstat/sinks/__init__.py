"""Sinks (inventory K1-K4): layered tables, R-style quoted CSV, chart data."""

from fieldstat.sinks.layers import read_layer, write_layer  # noqa: F401
from fieldstat.sinks.quoted_csv import (  # noqa: F401
    csv_header_line, quoted_csv_lines, write_quoted_csv,
)
