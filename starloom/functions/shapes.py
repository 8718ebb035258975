"""One time format a column, taken from its first value (the alternative to reading each value by itself).

``infer_time_shapes`` looks at the first non-null text of each column in input order, in one aggregate;
the driver derives the shape, which enters the plan as literals; ``shape_timestamp`` reads values of
that shape, all others become null.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.parse import lenient_timestamp
from starloom.functions.text import _col, strip_ws

# Dates by their order and separator; a slash or dash date is month first unless its first field can
# be no month.
_DATES = {
    "ymd": r"(?P<y>\d{4})(?P<s>[-/])(?P<m>\d{1,2})(?P=s)(?P<d>\d{1,2})",
    "mdy": r"(?P<m>\d{1,2})(?P<s>[-/])(?P<d>\d{1,2})(?P=s)(?P<y>\d{4})",
    "compact": r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?P<s>)",
}
_REST = (
    r"(?:(?P<sep>[T ])(?P<hour>\d{1,2}):(?P<minute>\d{2})(?::(?P<second>\d{2})(?P<fraction>\.\d{1,9})?)?"
    r"(?P<zone>Z|[+-]\d{2}:?\d{2})?)?"
)


@dataclass(frozen=True)
class TimeShape:
    """The format of a column: field order, separators, which time fields, fraction and zone it has,
    and whether white space stands before or after."""

    order: str  # ymd, mdy, dmy or compact
    separator: str = "-"
    between: str = ""  # between date and time; empty without a time
    seconds: bool = False
    fraction: bool = False
    zone: bool = False
    lead: bool = False
    trail: bool = False

    @property
    def pattern(self) -> str:
        """What a value of this shape looks like; single-digit months, days and hours are allowed."""
        year, two = r"\d{4}", r"\d{1,2}"
        date = {
            "ymd": self.separator.join([year, two, two]),
            "mdy": self.separator.join([two, two, year]),
            "dmy": self.separator.join([two, two, year]),
            "compact": r"\d{8}",
        }[self.order]
        time = ""
        if self.between:
            time = self.between + r"\d{1,2}:\d{2}" + (r":\d{2}" if self.seconds else "") + (r"\.\d{1,9}" if self.fraction else "")
            time += r"(?:Z|[+-]\d{2}:?\d{2})" if self.zone else ""
        space = r"(?U:\s+)"
        return f"^{space if self.lead else ''}{date}{time}{space if self.trail else ''}$"


def time_shape(text: str | None) -> TimeShape | None:
    """The shape of a time text; None if it has none of the known shapes or is no possible time."""
    if text is None:
        return None
    body = text.strip()
    for order, date in _DATES.items():
        m = re.fullmatch(date + _REST, body)
        if m is None:
            continue
        year, month, day = int(m["y"]), int(m["m"]), int(m["d"])
        if order == "mdy" and month > 12:
            order, month, day = "dmy", day, month
        try:
            dt.datetime(year, month, day, int(m["hour"] or 0), int(m["minute"] or 0), int(m["second"] or 0))
        except ValueError:
            return None
        return TimeShape(
            order,
            m["s"],
            m["sep"] or "",
            m["second"] is not None,
            m["fraction"] is not None,
            m["zone"] is not None,
            text != text.lstrip(),
            text != text.rstrip(),
        )
    return None


def shape_timestamp(c: Column | str, shape: TimeShape | None, formats: Sequence[str] = ()) -> Column:
    """A zone-less timestamp of text in ``shape``, else null. Without a shape each value is read by
    itself (:func:`starloom.functions.parse.lenient_timestamp`)."""
    c = _col(c)
    if shape is None:
        return lenient_timestamp(c, formats)
    iso = strip_ws(c)
    if shape.order == "mdy":
        iso = F.regexp_replace(iso, r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})", "$3-$1-$2")
    elif shape.order == "dmy":
        iso = F.regexp_replace(iso, r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})", "$3-$2-$1")
    elif shape.order == "compact":
        iso = F.regexp_replace(iso, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    elif shape.separator == "/":
        iso = F.regexp_replace(iso, r"^(\d{4})/(\d{1,2})/", "$1-$2-")
    if shape.zone:
        iso = F.regexp_replace(iso, r"(?:Z|[+-]\d{2}:?\d{2})$", "")
    if shape.fraction:
        iso = F.regexp_replace(iso, r"(\.\d{6})\d+$", "$1")
    return F.when(c.rlike(shape.pattern), iso.try_cast("timestamp_ntz"))


def infer_time_shapes(df: DataFrame, columns: Mapping[str, tuple[Column, Sequence[str | Column]]]) -> dict[str, TimeShape | None]:
    """The shape of each named text column, from its first non-null value in the given order (the
    ingest ordinal). One aggregate over the pruned columns; one row of texts reaches the driver."""
    firsts = []
    for name, (text, order) in columns.items():
        cols = [F.col(o) if isinstance(o, str) else o for o in order]
        firsts.append(F.min_by(text, F.when(text.isNotNull(), F.struct(*cols))).alias(name))
    if not firsts:
        return {}
    row = df.agg(*firsts).first()
    return {name: time_shape(row[name]) for name in columns}
