"""Lenient parsing of untrusted text: bad values become null instead of failing the job.

Spark 4 runs in ANSI mode, where a plain ``cast`` raises on bad input, so every parse here uses
``try_cast`` / ``try_to_timestamp``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from starloom.functions.text import _col, strip_ws

# Decimal and exponent notation, infinities; not the suffixed (1d, 2.5f) or hexadecimal forms that
# a JVM double accepts.
_NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf(inity)?)\s*$"


def lenient_double(c: Column | str, default: float | None = None) -> Column:
    """``pd.to_numeric(errors='coerce')`` then optional ``fillna(default)``."""
    c = _col(c)
    v = F.when(c.rlike(_NUMBER), c.try_cast("double"))
    return F.coalesce(v, F.lit(float(default))) if default is not None else v


def lenient_int(c: Column | str, default: int | None = 1) -> Column:
    """Parse as a 64-bit number, fill missing with ``default`` and truncate toward zero (``'2.7'`` -> 2).

    Whole numbers are read exactly; others go through a double. Text that is no number, or one that
    64 bits cannot hold, counts as missing.
    """
    c = _col(c)
    v = F.coalesce(c.try_cast("bigint"), lenient_double(c).try_cast("bigint"))
    return F.coalesce(v, F.lit(int(default)).cast("bigint")) if default is not None else v


# A date as year-month-day or year/month/day, or month/day/year; then, optionally, a time with up to
# nine fraction digits and a zone.
_DATE = r"(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{1,2}/\d{1,2}/\d{4})"
_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
_ZONE = r"(?:Z|[+-]\d{2}:?\d{2})"
_TIMESTAMP = rf"^{_DATE}(?:[T ]{_TIME}{_ZONE}?)?$"


def lenient_timestamp(c: Column | str, formats: Sequence[str] = ()) -> Column:
    """A zone-less timestamp from the stripped text, or null.

    Read without a format: ISO dates with ``-`` or ``/``, month-first slash dates, an optional time
    (``T`` or a space, seconds and up to nine fraction digits optional, kept to the microsecond) and
    an optional zone, whose wall-clock time is kept. ``formats`` are tried on text of other shapes.
    The text is brought to one shape first, so each value is parsed once.
    """
    s = strip_ws(c)
    iso = F.regexp_replace(s, r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2")
    iso = F.regexp_replace(iso, r"^(\d{4})/(\d{1,2})/", "$1-$2-")
    iso = F.regexp_replace(iso, rf"({_TIME}){_ZONE}$", "$1")
    iso = F.regexp_replace(iso, r"(\.\d{6})\d+$", "$1")
    parsed = F.when(s.rlike(_TIMESTAMP), iso.try_cast("timestamp_ntz"))
    extra = [F.try_to_timestamp(s, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(parsed, *extra) if extra else parsed
