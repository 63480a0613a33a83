"""Measurement text parsing, compass lookup, coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from stratus.schema import COMPASS_DEGREES

# A plain decimal number (what Python's float() accepts, minus inf/nan words
# and digit separators); anything else becomes null instead of raising.
NUMBER_RE = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Blank characters folded to a plain space before trimming (Python's
# ``str.strip``/``split`` treat them all as whitespace): every Unicode blank.
BLANKS = ("\t\n\u000b\u000c\r\u001c\u001d\u001e\u001f\u0085\u00a0\u1680"
          "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
          "\u2028\u2029\u202f\u205f\u3000")


def to_spaces(x) -> Column:
    """Map the common blank characters (NBSP, tab, newlines...) to a space."""
    return F.translate(_c(x), BLANKS, " " * len(BLANKS))


def strip_blank(x) -> Column:
    """Trim whitespace at both ends (Python ``str.strip``), no regex."""
    return F.trim(to_spaces(x))


def is_blank(x) -> Column:
    """True if a text holds nothing but blanks: read up to its first other character."""
    return F.ltrim(_c(x), F.lit(BLANKS + " ")) == F.lit("")


def to_double(x) -> Column:
    """Numeric coercion, unparseable -> null (never raises)."""
    s = strip_blank(_c(x).cast("string"))
    return F.when(s.rlike(NUMBER_RE), s.try_cast("double"))


def measure_token(x) -> Column:
    """X5, first half: the cleaned numeric token of a measurement text."""
    s = strip_blank(_c(x).cast("string"))
    token = F.translate(F.substring_index(s, " ", 1), ",", ".")
    return F.when(token.startswith("<"), F.regexp_replace(token, "^<+", "")).otherwise(token)


def token_to_double(token) -> Column:
    """Guarded cast of a cleaned token (null unless it is a plain number)."""
    t = _c(token)
    return F.when(t.rlike(NUMBER_RE), t.try_cast("double"))


def parse_measure(x) -> Column:
    """``'57.7\\xa0°F'`` -> 57.7.

    NBSP -> blank, trim; first blank-separated token; ``,`` -> ``.``;
    leading ``<`` stripped; then a guarded cast. ``''``, ``-``, ``--``,
    ``N/A`` and anything else non-numeric give null.
    """
    return token_to_double(measure_token(x))


def compass_degrees(x) -> Column:
    """Compass text -> degrees, trimmed, case-sensitive, unmapped -> null."""
    pairs = []
    for k, v in COMPASS_DEGREES.items():
        pairs += [F.lit(k), F.lit(float(v))]
    lookup = F.create_map(*pairs)
    return F.try_element_at(lookup, strip_blank(_c(x).cast("string")))


def truncate(x, n: int) -> Column:
    """First n characters."""
    return F.left(_c(x), F.lit(n))
