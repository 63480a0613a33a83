"""Scans: JSON-lines files, nested documents, sheet files, stored tables."""

from stratus.sources.jsonl import (  # noqa: F401
    scan_lines, nonblank, parse_records, quarantine, rows_per_file, line_numbers,
    require_rows, relative_path,
)
