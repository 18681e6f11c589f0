"""Scalar ``Column -> Column`` helpers.

They reproduce the PostgreSQL and pandas behaviours the warehouse relies on
where the Spark built-in of the same name behaves differently.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"
RATE = "decimal(5,4)"

# French calendar labels, January first and Sunday first.
MONTHS_FR = (
    "Janvier", "Février", "Mars", "Avril", "Mai", "Juin",
    "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre",
)
WEEKDAYS_FR = (
    "Dimanche", "Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi",
)


# --- text -------------------------------------------------------------------

def concat_present(*parts: Column) -> Column:
    """Concatenation that skips NULL parts (Spark ``concat`` would return NULL)."""
    return F.concat_ws("", *parts)


def prefixed_key(prefix: str, natural: Column) -> Column:
    """``zone_12`` style key; a missing natural key gives a missing key."""
    return F.concat(F.lit(prefix), natural.cast("string"))


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends (``trim`` only drops blanks)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def title_case(text: Column) -> Column:
    """Strip and capitalise every run of cased letters, also after ``-`` and ``'``.

    ``initcap`` only starts a new word after a blank, so a marker plus a blank is
    placed behind every other separator first and taken out again after.
    """
    opened = F.regexp_replace(strip(text), r"([^\p{Lu}\p{Ll}\p{Lt} ])", "$1\u0001 ")
    return F.replace(F.initcap(opened), F.lit("\u0001 "), F.lit(""))


def email_or_null(text: Column) -> Column:
    return F.when(text.contains("@"), text)


def number_with_unit(value: Column, unit: str) -> Column:
    """Millions with one decimal and a unit, as text."""
    return F.concat((value / F.lit(1_000_000)).cast("decimal(20,1)").cast("string"), F.lit(unit))


# --- lenient parsing ----------------------------------------------------------

def lenient_amount(text: Column) -> Column:
    """Unreadable or missing amounts count as zero."""
    return F.coalesce(text.try_cast(MONEY), F.lit(0).cast(MONEY))


def lenient_timestamp(text: Column) -> Column:
    """Unreadable dates become NULL."""
    return text.try_cast("timestamp_ntz")


def lenient_date(text: Column) -> Column:
    return lenient_timestamp(text).cast("date")


def price_amount(text: Column) -> Column:
    """Read a price such as ``12 €``; currency signs and blanks are dropped.

    Points and commas are told apart by their place.  With both kinds the last one
    marks the decimals, and must occur once.  A single kind marks thousands if it
    repeats or if exactly three digits follow after one to three others; otherwise
    it marks the decimals.  Anything else is unreadable and gives NULL.
    """
    digits = F.regexp_replace(text.cast("string"), r"[^0-9.,\-]", "")
    thousands = F.regexp_replace(digits, "[.,]", "")
    decimal = F.concat(F.regexp_replace(F.regexp_replace(digits, r"[.,][0-9]*$", ""), "[.,]", ""),
                       F.lit("."), F.regexp_extract(digits, r"[.,]([0-9]*)$", 1))
    return (F.when(~digits.rlike("[.,]"), digits)
             .when(digits.rlike(r"^-?[0-9]{1,3}(\.[0-9]{3})+$|^-?[0-9]{1,3}(,[0-9]{3})+$"), thousands)
             .when(digits.rlike(r"^-?[0-9]*[.,][0-9]*$|^-?[0-9,]+\.[0-9]*$|^-?[0-9.]+,[0-9]*$"), decimal)
            ).try_cast(MONEY)


def json_amount(document: Column, field: str) -> Column:
    return F.get_json_object(document, f"$.{field}").try_cast(MONEY)


def json_count(document: Column, field: str) -> Column:
    return F.get_json_object(document, f"$.{field}").try_cast("int")


# --- dates --------------------------------------------------------------------

def as_timestamp(value: str | dt.date | dt.datetime | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def as_date(value: str | dt.date | dt.datetime | Column) -> Column:
    return as_timestamp(value).cast("date")


def date_key(day: Column) -> Column:
    """YYYYMMDD integer; NULL stays NULL."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def date_key_or(day: Column, default: int = 20240101) -> Column:
    return F.coalesce(date_key(day), F.lit(default))


def full_days(start: Column, end: Column) -> Column:
    """Completed 24 hour days between two zone-less timestamps."""
    elapsed = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    return F.date_part(F.lit("DAY"), elapsed).cast("int")


def calendar_days(start: Column, end: Column) -> Column:
    """Difference in calendar days, whatever the time of day."""
    return F.datediff(end, start)


def weekday_number(day: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(day) - 1


def month_fr(month: Column) -> Column:
    return F.element_at(F.array(*[F.lit(m) for m in MONTHS_FR]), month)


def weekday_fr(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS_FR]), number + 1)


def quarter_label(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day).cast("string"),
                    F.lit("-"), F.year(day).cast("string"))


# --- units --------------------------------------------------------------------

def hectares(area: Column, unit: Column) -> Column:
    return F.when(unit == "m2", area / F.lit(10000)).otherwise(area).cast("decimal(21,6)")


# --- hashes -------------------------------------------------------------------

def hash_key(prefix: str, natural: Column, version: Column | int = 1) -> Column:
    """Stable surrogate key from prefix, natural key and version: a whole digest."""
    version = version if isinstance(version, Column) else F.lit(version)
    digest = F.md5(F.concat_ws("_", F.lit(prefix), natural.cast("string"), version.cast("string")))
    text = F.concat(F.lit(f"{prefix}_"), F.upper(digest))
    return F.when(natural.isNotNull(), text)


def hash_bucket(text: Column, buckets: int) -> Column:
    """Reproducible pseudo-random number in ``0 .. buckets - 1``."""
    number = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (number % F.lit(buckets)).cast("int")


def hash_range(text: Column, low: int, high: int) -> Column:
    """Reproducible pseudo-random number in ``low .. high`` inclusive."""
    return hash_bucket(text, high - low + 1) + F.lit(low)


def hash_choice(text: Column, values: tuple[str, ...]) -> Column:
    picks = F.array(*[F.lit(v) for v in values])
    return F.element_at(picks, hash_bucket(text, len(values)) + 1)
