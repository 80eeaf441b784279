"""Text columns: cleaning, damaged ids, lists and header names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a field is trimmed
# or tested for blank (Unicode white space and the four separator controls).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# An all-digit id that a spreadsheet rewrote as 1.20E+17.
DAMAGED_ID = r"(?i)\A[0-9]++(\.[0-9]++)?E\+[0-9]++\z"

# Texts that some tools read as NULL.
NULL_LITERALS = ("NA", "NULL", "None", "N/A", "nan")


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for NULL, empty and white-space-only text; never NULL."""
    return c.isNull() | (strip(c) == "")


def clean(c: Column) -> Column:
    """Trim, and turn blank text into NULL."""
    return F.nullif(strip(c), F.lit(""))


def is_damaged_id(cleaned: Column) -> Column:
    """True where a cleaned id is in scientific notation; never NULL."""
    return F.coalesce(cleaned.rlike(DAMAGED_ID), F.lit(False))


def repair_id(cleaned: Column) -> Column:
    """A damaged id becomes NULL since its digits are lost."""
    return F.when(~is_damaged_id(cleaned), cleaned)


def split_list(c: Column) -> Column:
    """Comma list to array: items trimmed, blank items dropped."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda item: item != "")


def normalise_header(name: str) -> str:
    """ "Install Time" -> "install_time"."""
    return name.strip().lower().replace(" ", "_")


def normalise_headers(names: Iterable[str]) -> list[str]:
    out = [normalise_header(n) for n in names]
    clashes = sorted({n for n in out if out.count(n) > 1})
    if clashes:
        raise ValueError(f"headers clash after normalising: {clashes}")
    return out
