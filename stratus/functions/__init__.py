"""Scalar Column -> Column functions (unit conversion, text and time parsing)."""

from stratus.functions.units import f_to_c, mph_to_kmh, inhg_to_hpa, in_to_mm, CONVERTERS  # noqa: F401
from stratus.functions.text import (  # noqa: F401
    parse_measure, compass_degrees, to_double, strip_blank, is_blank, truncate,
)
from stratus.functions.time import (  # noqa: F401
    date_from_path, combine_date_time, combine_date_time_multi, iso_timestamp,
    to_timestamp_coerce, ts_to_iso, sheet_date,
)
from stratus.functions.sanitize import non_finite_to_null, sanitize_frame  # noqa: F401
