"""Date parsing for the text formats found in the source files.

All parsers give null for junk, so that one bad row does not end a job.
"""

from __future__ import annotations

from datetime import date

from tallychain.config import Period
from tallychain.functions.text import strip_quotes


def parse_quoted_date(x: str) -> str:
    """``'2026-01-15 16:24:17'`` with literal quotes."""
    return parse_text_date(strip_quotes(x))


def parse_text_date(x: str) -> str:
    """ISO date or timestamp text."""
    return f"try_cast(left({x}, 10) AS DATE)"


def parse_dmy_date(x: str) -> str:
    """``15-01-2026 10:00``; the time part is ignored."""
    return f"CAST(try_to_timestamp(left({x}, 10), 'dd-MM-yyyy') AS DATE)"


def parse_month_name_date(x: str) -> str:
    """``Jan 5, 2026``, falling back to ISO text."""
    # The two shapes never overlap, so only one parser runs per row.
    return (
        f"CASE WHEN {x} RLIKE '^[A-Za-z]' THEN CAST(try_to_timestamp({x}, 'MMM d, yyyy') AS DATE) "
        f"ELSE {parse_text_date(x)} END"
    )


def month_label(x: str) -> str:
    """``yyyy-MM`` of a date."""
    return f"left(CAST({x} AS STRING), 7)"


def month_start(x: str) -> str:
    return f"trunc({x}, 'MM')"


def between(x: str, start: date, end: date) -> str:
    """Half-open range. A plain range reaches the Parquet scan, ``year(x) = ...`` would not."""
    return f"({x} >= DATE'{start}' AND {x} < DATE'{end}')"


def in_period(x: str, period: Period) -> str:
    return between(x, period.start, period.end)


def year_month(x: str, year: int, month: int) -> str:
    """``YEAR(x) = year AND MONTH(x) = month`` as a range."""
    return in_period(x, Period.month(f"{year}-{month:02d}"))


def month_prefix(x: str, prefix: str) -> str:
    """``x LIKE 'yyyy-MM%'`` on a date, as a range."""
    return in_period(x, Period.month(prefix))
