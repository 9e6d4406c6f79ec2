"""Dates in the forms that pages and files have them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The forms tried, in this order.
FORMS = ("yyyy-MM-dd", "dd.MM.yyyy", "yyyyMMdd", "yyyy.MM.dd", "yyyy/MM/dd")


def any_date(text: Column) -> Column:
    """The first form that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in FORMS])


def dotted_birth(text: Column) -> Column:
    """Birth dates with slashes or dots between year, month and day."""
    return F.try_to_timestamp(F.regexp_replace(text, "[/-]", "."), F.lit("yyyy.MM.dd")).cast("date")


def range_dates(text: Column) -> Column:
    """Start and finish of a range such as "29 December, 2019 - 4 January, 2020" or "6 - 12 January, 2020"."""
    finish = F.regexp_extract(text, r"-\s*(\d+ \w+,? \d{4})\s*$", 1)
    year, month = F.regexp_extract(finish, r"(\d{4})$", 1), F.regexp_extract(finish, r"^\d+ (\w+)", 1)
    left = F.trim(F.regexp_extract(text, r"^(.*?)-", 1))
    start = F.when(left.rlike(r"\d{4}$"), left).when(left.rlike(r"^\d+ \w+"), F.concat_ws(" ", F.regexp_replace(left, ",", ""), year)).otherwise(F.concat_ws(" ", left, month, year))
    day = lambda t: F.try_to_timestamp(F.regexp_replace(t, ",", ""), F.lit("d MMMM yyyy")).cast("date")
    return F.struct(day(start).alias("starts"), day(finish).alias("ends"))


def age_at(day: Column, birth: Column) -> Column:
    """Age in years, cut after three digits."""
    return F.floor(F.months_between(day, birth, False) / 12 * 1000) / 1000


def minutes(text: Column) -> Column:
    """Minutes of a duration hh:mm."""
    return F.regexp_extract(text, r"^(\d+):", 1).cast("int") * 60 + F.regexp_extract(text, r":(\d+)", 1).cast("int")
