"""Date parsing and date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"


def parsed_date(text: Column | str, pattern: str = ISO_DATE) -> Column:
    """Text to date; text that does not match the pattern gives null."""
    return F.try_to_date(text, pattern)


def year_number(value: Column | str) -> Column:
    return F.year(value).cast("bigint")


def year_text(value: Column | str) -> Column:
    return F.date_format(value, "yyyy")


def month_text(value: Column | str) -> Column:
    return F.date_format(value, "MM")
