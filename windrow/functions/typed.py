"""Strict parsing to typed columns, with the error kept as data.

Nothing here raises inside a job: each parser has a companion that says whether
a non-blank text failed to parse.  Timestamps are NTZ throughout, so no session
time zone can shift them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.functions.text import WHITESPACE, is_blank, strip

# Year-month-day hour:minute:second.  Nearly every timestamp has the
# first form; the second also takes one-digit fields, a space-padded day and any
# white space between date and time.  Year 0 and anything around are refused.
PLAIN_TIMESTAMP = r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
TIMESTAMP = (
    r"\A(?!0000)[0-9]{4}-[0-9]{1,2}-( [1-9]|[0-9]{1,2})"
    rf"[{WHITESPACE}]+[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}\z"
)

# Wide enough to keep money unrounded until the table's own scale is applied.
MONEY_WIDE = "decimal(38,18)"
MONEY = "decimal(18,4)"


def parse_timestamp(c: Column) -> Column:
    """NTZ timestamp, or NULL when the text is blank or not in the exact format."""
    padded = F.regexp_replace(c, r"- ([1-9])", "-0$1")
    single_spaced = F.regexp_replace(padded, f"[{WHITESPACE}]+", " ")
    return F.when(c.rlike(PLAIN_TIMESTAMP), c.try_cast("timestamp_ntz")).when(
        c.rlike(TIMESTAMP), single_spaced.try_cast("timestamp_ntz")
    )


def parse_decimal(c: Column) -> Column:
    """Unrounded money, or NULL when the text is blank or not a storable number.

    Edge white space, a sign, an exponent and digit-group underscores are fine.
    """
    return F.replace(strip(c), F.lit("_"), F.lit("")).try_cast(MONEY_WIDE)


def failed(raw: Column, parsed: Column) -> Column:
    """True where a non-blank text gave no value; never NULL."""
    return parsed.isNull() & ~is_blank(raw)


def overflows(wide: Column) -> Column:
    """True where unrounded money does not fit the table's scale; never NULL."""
    return wide.isNotNull() & wide.try_cast(MONEY).isNull()
