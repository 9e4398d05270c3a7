"""Date expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date formats, first match wins, and the season of each month.
ISO_DATE = "yyyy-MM-dd"
DATE_FORMATS = (ISO_DATE, "MM/dd/yyyy", "dd-MM-yyyy")
SEASONS = ("Winter", "Spring", "Summer", "Autumn")


def parse_date(value: Column | str, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First format that parses; null when none does (never an ANSI error).

    A value is only parsed under formats whose digit layout it has: a failed parse costs an
    exception, a layout test does not. ISO dates take the plain cast, which needs no formatter.
    """
    value = F.col(value) if isinstance(value, str) else value

    def attempt(fmt: str) -> Column:
        layout = "^" + re.sub(r"[A-Za-z]+", lambda run: f"[0-9]{{{len(run[0])}}}", fmt) + "$"
        parsed = value.try_cast("date") if fmt == ISO_DATE else F.try_to_date(value, fmt)
        return F.when(value.rlike(layout), parsed)

    return F.coalesce(*[attempt(fmt) for fmt in formats])


def season_of(month: Column | str) -> Column:
    """Meteorological season: December opens Winter, then three months each."""
    month = F.col(month) if isinstance(month, str) else month
    quarter = F.floor((month % 12) / 3).cast("int")
    return F.element_at(F.array(*[F.lit(s) for s in SEASONS]), quarter + 1)


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "month")


def decade_of(day: Column | str) -> Column:
    return (F.floor(F.year(day) / 10) * 10).cast("int")


