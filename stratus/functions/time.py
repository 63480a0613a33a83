"""Dates from paths, clock text, ISO timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ISO_PREFIX_RE = r"^\d{4}-\d{2}-\d{2}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _six_digits_to_date(s: Column, order: str) -> Column:
    fmt = {"DMY": "ddMMyy", "MDY": "MMddyy"}[order]
    return F.when(s.rlike(r"^\d{6}$"), F.try_to_date(s, fmt))


def date_from_path(path, order: str = "DMY") -> Column:
    """First ``/dddddd/`` segment of a path as a date (year 2000+YY).

    ``order`` is ``DMY`` or ``MDY``; invalid dates give null.
    """
    seg = F.regexp_extract(_c(path), r"/(\d{6})/", 1)
    return _six_digits_to_date(seg, order)


def sheet_date(name) -> Column:
    """Sheet name -> date from its first six characters, DDMMYY."""
    return _six_digits_to_date(F.substring(_c(name), 1, 6), "DMY")


def _norm_blanks(t: Column) -> Column:
    return F.regexp_replace(t, r"(?U)\s+", " ")


def _clock12(day: Column, t: Column, pattern: str) -> Column:
    """ISO text of a day and a 12-hour clock: groups hour, minute, seconds or '', am/pm."""
    part = lambda i: F.regexp_extract(t, pattern, i)
    hour = part(1).try_cast("int")
    hour24 = F.pmod(hour, F.lit(12)) + F.when(F.lower(part(4)) == "pm", 12).otherwise(0)
    sec = F.when(part(3) == "", "00").otherwise(part(3))
    text = F.concat(day, F.lit(" "), F.lpad(hour24.cast("string"), 2, "0"), F.lit(":"), F.lpad(part(2), 2, "0"), F.lit(":"), F.lpad(sec, 2, "0"))
    return F.when(t.rlike(pattern) & hour.between(1, 12), text)


CLOCK12_RE = r"^(\d{1,2}):(\d{1,2})() ([AaPp][Mm])$"
CLOCK12_ANY_RE = r"^(\d{1,2}):(\d{1,2})(?::(\d{1,2}))? ?([AaPp][Mm])$"


def combine_date_time(date, time_text) -> Column:
    """X11: date + 12-hour clock text (``%I:%M %p``) -> TIMESTAMP_NTZ.

    Any blank run between the parts counts as one blank; a missing part or an
    invalid clock gives null.
    """
    t = _norm_blanks(_c(time_text).cast("string"))
    return _clock12(F.date_format(_c(date), "yyyy-MM-dd"), t, CLOCK12_RE).try_cast("timestamp_ntz")


def combine_date_time_multi(date, time_text) -> Column:
    """Date + a time cell in any accepted form (12-hour clock with or
    without seconds and blank, ``HH:mm``, ``HH:mm:ss``, or a full timestamp
    whose time part is kept). All by wall time: no session zone is involved."""
    return combine_date_clock(date, clock_text(time_text))


def clock_text(x) -> Column:
    """A time cell as text with single blanks, none at the ends."""
    return F.trim(_norm_blanks(_c(x).cast("string")))


def combine_date_clock(date, clock) -> Column:
    """X12 on a cleaned time cell (:func:`clock_text`). It is read many times:
    who works on many rows makes it a column of its own first."""
    t = _c(clock)
    d = F.date_format(_c(date), "yyyy-MM-dd")
    full = F.when(t.rlike(ISO_PREFIX_RE), t.try_cast("timestamp_ntz"))
    clock = r"^(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?$"
    part = lambda i: F.lpad(F.regexp_extract(t, clock, i), 2, "0")
    text = F.coalesce(
        _clock12(d, t, CLOCK12_ANY_RE),
        F.when(t.rlike(clock), F.concat(d, F.lit(" "), part(1), F.lit(":"), part(2), F.lit(":"), part(3))),
        F.concat(d, F.lit(" "), F.date_format(full, "HH:mm:ss.SSSSSS")),
    )
    return text.try_cast("timestamp_ntz")


def iso_timestamp(x, zone: str = "convert") -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ; ``Z`` accepted; blank/invalid -> null.

    ``zone='convert'``: values with an offset are converted to UTC.
    ``zone='drop'``: the offset is discarded, wall time kept.
    Neither depends on the session time zone.
    """
    s = _c(x).cast("string")
    guarded = F.when(s.rlike(ISO_PREFIX_RE), s)
    if zone == "convert":
        # text with an offset: the instant, as UTC wall time (independent of
        # the session time zone); text without one: its wall time as is
        has_zone = s.rlike(r"\d{2}:\d{2}(:\d{2}(\.\d*)?)?(Z|[+-]\d{2}(:?\d{2})?)$")
        micros = F.unix_micros(guarded.try_cast("timestamp")).cast("decimal(20,0)")
        utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=micros / 1_000_000)
        return F.when(has_zone, utc).otherwise(guarded.try_cast("timestamp_ntz"))
    if zone == "drop":
        return guarded.try_cast("timestamp_ntz")
    raise ValueError(zone)


def to_timestamp_coerce(x) -> Column:
    """Timestamp coercion of text, bad -> null (wall time kept)."""
    return iso_timestamp(x, zone="drop")


def ts_to_iso(x) -> Column:
    """TIMESTAMP -> ``YYYY-MM-DDTHH:MM:SS[.ffffff]`` (fraction only when non-zero)."""
    ts = _c(x)
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.when(frac == F.lit("000000"), base).otherwise(F.concat(base, F.lit("."), frac))
