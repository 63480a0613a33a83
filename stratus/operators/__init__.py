"""DataFrame -> DataFrame operators: normalisation, dedup, validation, reports."""
