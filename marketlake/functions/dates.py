"""Date formatting and lenient parsing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: shapes of a date cell and how each is read ----
DATE_FORMATS = (
    (r"^\d{2} [A-Za-z]{3} \d{2}$", "dd MMM yy"),
    (r"^\d{2} [A-Za-z]{3} \d{4}$", "dd MMM yyyy"),
    (r"^\d [A-Za-z]{3} \d{2}$", "d MMM yy"),
    (r"^\d [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4}$", "MMM d yyyy"),
    (r"^[A-Za-z]{4,9} \d{1,2},? \d{4}$", "MMMM d yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", "d-MMM-yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", "d-MMM-yy"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
    (r"^\d{4}-\d{2}-\d{2}[T ].+$", "yyyy-MM-dd"),
)


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def year_text(date: Column) -> Column:
    return F.date_format(date, "yyyy")


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def iso_timestamp(stamp: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ss``, with six digits of a second's fraction if there is one."""
    text = F.replace(stamp.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))
    return F.when(F.length(text) == 19, text).otherwise(F.rpad(text, 26, "0"))


def flexible_date(text: Column, formats: Sequence[tuple[str, str]] = DATE_FORMATS) -> Column:
    """The date if the text has one of the shapes, else NULL. Two-digit years from 69 on are of the 1900s.

    A comma after the day and a time after an ISO date are read over.

    Only the format of the matching shape is tried: a failed attempt costs an exception.
    """

    def parse(pattern: str) -> Column:
        plain = F.substring(text, 1, 10) if pattern == "yyyy-MM-dd" else F.replace(text, F.lit(","), F.lit(""))
        if "yyyy" not in pattern:
            # The century goes into the text: a day that is looked at before it is shifted would be parsed twice.
            century = F.when(F.right(text, F.lit(2)) >= "69", "19").otherwise("20")
            plain = F.concat(F.left(text, F.length(text) - 2), century, F.right(text, F.lit(2)))
            pattern = pattern.replace("yy", "yyyy")
        return F.try_to_date(plain, pattern)

    cases = F
    for shape, pattern in formats:
        cases = cases.when(text.rlike(shape), parse(pattern))
    # Every shape has a digit, so one test settles what is no date at all.
    return F.when(text.rlike("[0-9]"), cases)


def partition_path(date: Column) -> Column:
    """``year=YYYY/month=MM/day=DD`` of the date."""
    return F.date_format(date, "'year='yyyy'/month='MM'/day='dd")
