"""Relational operators of the census pipeline (P, J, A, F inventory rows)."""

from fieldstat.operators.groups import (  # noqa: F401
    bar_data, crosstab_count, crosstab_totals, keep_first, pivot_values,
    representative_rows,
)
from fieldstat.operators.joins import (  # noqa: F401
    bounded_broadcast, exists_join, label_join, merge_frames, unmatched_codes,
)
from fieldstat.operators.reshape import (  # noqa: F401
    drop_range, rename_first, to_category, to_integer,
)
