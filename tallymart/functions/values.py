"""Text to numbers and dates.  Nothing here raises on bad input: it gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.contract import MONEY

# Characters dropped from money text, and from quantity text.
WHITE_SPACE = " \t\n\v\f\r"
MONEY_NOISE = "$₹€£," + WHITE_SPACE
QUANTITY_NOISE = "," + WHITE_SPACE

# What counts as an ISO date: a bare number such as a year or a row id does not.
ISO_DATE = r"^\d{4}-\d{1,2}-\d{1,2}([ T].*)?$"

# Fixed value: the date pattern known besides the ISO forms.
DATE_FORMATS = ("M/d/yyyy",)

# The usual spelling of that pattern, and of a whole number: these are read without a formatter or decimals.
US_DATE = r"^\d{1,2}/\d{1,2}/[1-9]\d{3}$"
PLAIN_WHOLE = r"^\d{1,9}$"


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def money(text: Column) -> Column:
    """Decimal amount; NaN, infinities and type suffixes are not numbers here.

    Noise is mostly at the ends or a comma; only other text is searched character by character.
    """
    plain = text.cast("string")
    trimmed = F.replace(F.btrim(plain, F.lit(MONEY_NOISE)), F.lit(","), F.lit(""))
    digits = F.translate(plain, MONEY_NOISE, "")
    return F.coalesce(trimmed.try_cast(MONEY), F.nullif(digits, F.lit("")).try_cast(MONEY))


def quantity(text: Column) -> Column:
    """Whole number; ``3.0`` is 3, ``3.5`` is NULL."""
    plain = text.cast("string")
    digits = F.translate(plain, QUANTITY_NOISE, "")
    exact = F.nullif(digits, F.lit("")).try_cast(MONEY)
    whole = F.when(exact == F.floor(exact), exact.try_cast("int"))
    return F.when(F.regexp_like(plain, F.lit(PLAIN_WHOLE)), plain.try_cast("int")).otherwise(whole)


def _us_date(trimmed: Column) -> Column:
    """``M/d/yyyy`` turned into the ISO form, whose cast needs no formatter; NULL for another spelling."""
    month, year = (F.substring_index(trimmed, "/", k) for k in (1, -1))
    day = F.substring_index(F.substring_index(trimmed, "/", 2), "/", -1)
    iso = F.concat(year, F.lit("-"), month, F.lit("-"), day)
    return F.when(F.regexp_like(trimmed, F.lit(US_DATE)), iso.try_cast("date"))


def _by_pattern(trimmed: Column, pattern: str) -> Column:
    parsed = F.try_to_date(trimmed, pattern)
    return F.coalesce(_us_date(trimmed), parsed) if pattern == "M/d/yyyy" else parsed


def parse_date(
    text: Column, formats: tuple[str, ...] = DATE_FORMATS, iso_first: bool = True
) -> Column:
    """A date in an ISO form or in the first of ``formats`` that fits, else NULL.

    A bare number is never a date: it must have the ISO form's dashes.  A year
    of two digits (``yy``) is one of 2000 to 2099.

    Text in another form costs the ISO attempt little but a pattern an
    exception, so ISO goes first; turn that off for a pattern such as
    ``yyyy-dd-MM`` that an ISO date could be mistaken for.
    """
    trimmed = blank_to_null(text.cast("string"))
    dashed = F.substring(trimmed, 5, 1) == "-"  # spares other text the pattern
    iso = F.when(dashed & F.regexp_like(trimmed, F.lit(ISO_DATE)), trimmed.try_cast("date"))
    patterns = [_by_pattern(trimmed, f) for f in formats]
    return F.coalesce(*([iso, *patterns] if iso_first else [*patterns, iso]))


def dimension(text: Column) -> Column:
    return F.lower(F.trim(text))


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def month_date(year: Column, month: Column) -> Column:
    """First day of a (year, month) pair given as numbers or digits."""
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))
