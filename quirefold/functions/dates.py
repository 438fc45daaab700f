"""Date parsing and the inclusive date range."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# (prefix length, shape that guards against padding Spark would accept, datetime pattern)
_FORMATS = (
    (19, r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$", "yyyy-M-d'T'H:m:s"),
    (10, r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (10, r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
)


def parse_date(c: Column) -> Column:
    """ISO datetime, ISO date or day/month/year, whatever follows the prefix ignored; otherwise null."""
    def attempt(chars, shape, pattern):
        head = F.substring(c, 1, chars)
        return F.when(head.rlike(shape), F.try_to_timestamp(head, F.lit(pattern)).cast("date"))

    return F.coalesce(*(attempt(*f) for f in _FORMATS))


def in_date_range(c: Column, date_from: date | None = None, date_to: date | None = None) -> Column:
    """Inclusive range in which an unknown date passes; an absent bound is left out."""
    bounds = [c >= F.lit(date_from)] if date_from else []
    bounds += [c <= F.lit(date_to)] if date_to else []
    if not bounds:
        return F.lit(True)
    inside = bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]
    return c.isNull() | inside


def parse_iso_argument(value: str | None) -> date | None:
    """Strict ISO date for run parameters; raises ValueError on anything else."""
    if not value:
        return None
    try:
        return date.fromisoformat(value)
    except ValueError:
        raise ValueError(f"invalid date {value!r}: expected YYYY-MM-DD") from None
