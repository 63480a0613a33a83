"""Table writes: strict JSONL export, report export, loads, keyed edits, layout."""
