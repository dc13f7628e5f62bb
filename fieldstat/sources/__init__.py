"""Sources (inventory S1-S6)."""

from fieldstat.sources.archive import (  # noqa: F401
    archive_blocks, archive_headers, archive_lines, check_headers, explode_archives, explode_blocks, read_member,
)
from fieldstat.sources.codelists import load_code_lists  # noqa: F401
from fieldstat.sources.delimited import read_delimited  # noqa: F401
from fieldstat.sources.extract import extract_status  # noqa: F401
from fieldstat.sources.records import number_records, records, with_quote_state  # noqa: F401
from fieldstat.sources.types import apply_types, guess_types, read_guessed  # noqa: F401
