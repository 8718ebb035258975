"""Text cleaning with the exact semantics of Python's ``str`` methods, as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The strings a pandas CSV reader turns into missing values by default.
# "-" and "nil" are deliberately not in the list.
#   "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
#   "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"
# ---------------------------------------------------------------------------
NA_TOKENS: tuple[str, ...] = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Runs of letters or of non-letters; title case capitalises each letter run.
_LETTER_RUNS = r"(\p{L}+|[^\p{L}]+)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c: Column | str) -> Column:
    """Missing-value markers (``NA_TOKENS``) become null; other strings pass unchanged."""
    c = _col(c)
    return F.when(~c.isin(*NA_TOKENS), c)


def strip_ws(c: Column | str) -> Column:
    """``str.strip()``: remove leading and trailing Unicode white space (``F.trim`` only drops spaces)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def title_case(c: Column | str) -> Column:
    """``str.title()``: upper-case the first letter after any non-letter, lower-case the rest.

    ``initcap`` only splits on spaces (``d'oeste`` -> ``D'oeste``); splitting into letter runs
    first gives ``D'Oeste`` and ``Embu-Guaçu`` like Python.
    """
    runs = F.regexp_extract_all(_col(c), F.lit(_LETTER_RUNS), 1)
    return F.array_join(F.transform(runs, lambda r: F.initcap(r)), "")


def zfill(c: Column | str, width: int = 5) -> Column:
    """``str.zfill(width)``: left-pad with zeros after an optional sign; longer input is unchanged."""
    c = _col(c)
    signed = c.startswith("-") | c.startswith("+")
    rest = c.substr(F.lit(2), F.length(c))
    return (
        F.when(F.length(c) >= width, c)
        .when(signed, F.concat(c.substr(1, 1), F.lpad(rest, width - 1, "0")))
        .otherwise(F.lpad(c, width, "0"))
    )
