"""Publication dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Month names as they appear in article records.
MONTHS = {
    "Jan": 1, "Feb": 2, "Mar": 3, "Apr": 4, "May": 5, "Jun": 6,
    "Jul": 7, "Aug": 8, "Sep": 9, "Oct": 10, "Nov": 11, "Dec": 12,
}


def publication_date(year: Column, month: Column, day: Column) -> Column:
    """``YYYY-MM-DD`` text from date parts; null without a year.

    A missing month or day counts as 1; one that is neither a number nor a month
    name (a season, say) sends the whole date to 1 January.
    """
    names = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    number = F.coalesce(names[month], strip(month).try_cast("int"), _missing(month))
    day_number = F.coalesce(strip(day).try_cast("int"), _missing(day))
    full = F.format_string("%s-%02d-%02d", year, number, day_number)
    return F.when(
        year != "",
        F.when(number.isNotNull() & day_number.isNotNull(), full).otherwise(
            F.concat(year, F.lit("-01-01"))
        ),
    )


def _missing(part: Column) -> Column:
    return F.when(part.isNull(), F.lit(1))
