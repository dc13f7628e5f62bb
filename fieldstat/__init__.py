"""fieldstat: survey/census microdata processing on Spark DataFrames.

Layout
------
sources/    archive-member scan, typed delimited reads, code-list catalog, status extract
functions/  Column-level helpers (paste, integer/category casts, dates, times)
operators/  reshaping, label joins, merges, representative rows, cross-tabs
sinks/      layered table writes, quoted CSV lines, chart datasets
plans/      the census marts and report tables, plus the driver-table stand-ins
llm/        operators that prepare training text (optional; nothing else imports it)
"""

__version__ = "0.1.0"
