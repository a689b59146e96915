"""Date parsing and date arithmetic as Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date layouts, tried in this order.
BUREAU_MASKS = [
    "dd/MM/yyyy", "dd-MM-yyyy", "dd.MM.yyyy",
    "yyyy/MM/dd", "yyyy-MM-dd", "yyyy.MM.dd",
    "MM/dd/yyyy", "MM-dd-yyyy",
]
OFFER_EXTRA_MASKS = ["dd/MM/yy", "dd-MM-yy", "dd/MMM/yyyy", "dd-MMM-yyyy"]

# First year of the hundred-year span that two-digit years fall in.
TWO_DIGIT_CENTURY_START = 1970


def _try_mask(c: Column, mask: str, lenient: bool) -> Column:
    if lenient:
        mask = mask.replace("dd", "d").replace("MMM", "@").replace("MM", "M").replace("@", "MMM")
    parsed = F.to_date(F.try_to_timestamp(c, F.lit(mask)))
    if "yyyy" in mask:
        return parsed
    rolls_back = F.year(parsed) >= TWO_DIGIT_CENTURY_START + 100
    return F.when(rolls_back, F.add_months(parsed, -1200)).otherwise(parsed)


def parse_date(c: Column, masks: list[str] = BUREAU_MASKS, *, lenient: bool = False, auto: bool = False) -> Column:
    """First layout that reads the text; day-first layouts come before month-first ones.

    ``lenient`` also takes one-digit days and months; ``auto`` finally tries Spark's own date cast.
    """
    tries = [_try_mask(c, mask, lenient) for mask in masks]
    if auto:
        tries.append(c.try_cast("date"))
    return F.coalesce(*tries)


def parse_offer_date(c: Column, *, lenient: bool = False) -> Column:
    """Lender-offer dates: trimmed, more layouts, then a plain cast."""
    return parse_date(F.trim(c.cast("string")), BUREAU_MASKS + OFFER_EXTRA_MASKS, lenient=lenient, auto=True)


def inquiry_date(c: Column) -> Column:
    """Date in front of an inquiry time such as ``05-JAN-24 10:00``."""
    return _try_mask(F.split_part(c, F.lit(" "), F.lit(1)), "dd-MMM-yy", False)


def month_diff(start: Column, end: Column) -> Column:
    """Number of month boundaries between two dates (negative when ``end`` is earlier)."""
    return (F.year(end) * 12 + F.month(end)) - (F.year(start) * 12 + F.month(start))


def age_years(dob: Column, as_of: dt.date) -> Column:
    return F.floor(F.date_diff(F.lit(as_of), dob) / F.lit(365.25)).cast("bigint")


def plausible_dob(dob: Column, created_at: Column, as_of: dt.date) -> Column:
    """Keep a birth date only when it implies an age of 1 to 99 at load time, or under 100 today."""
    at_load = F.year(created_at) - F.year(dob)
    today = F.lit(as_of.year) - F.year(dob)
    return F.when(at_load.between(1, 99) | today.between(1, 99), dob)


def date_text(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")
