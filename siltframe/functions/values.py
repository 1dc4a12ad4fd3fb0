"""Domain values: null codes, flags, dates, units and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Numeric codes for "not applicable", "not available" and "unknown".
NULL_CODES = (-777777, -888888, -999999)

# Text in a raw date type -> the name it is stored under; the first hit wins.
_DATE_TYPES = [
    ("core top estimated", "Top of core estimated"),
    ("core estimated", "Top of core estimated"),
    ("core top known", "Top of core known"),
    ("core known", "Top of core known"),
    ("isotopic correlation", "Isotopic correlation"),
    ("pollen correlation", "Pollen correlation"),
    ("stratigraphic correlation", "Stratigraphic correlation"),
]

# Date types that need a calibration curve, and the hiatus marker.
_RADIOCARBON = "carbon|AMS|Counting|counting"
_HIATUS = "hiatus|Hiatus"


def if_else(test: Column, yes, no) -> Column:
    """Two-way choice that is null where the test is null (``when`` alone would fall through)."""
    return F.when(test.isNull(), None).when(test, yes).otherwise(no)


def null_max(*columns: Column) -> Column:
    """Row-wise maximum, null if any argument is null."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | c.isNull()
    return F.when(~missing, F.greatest(*columns))


def parse_flag(c: Column) -> Column:
    """Text starting with y is true, with n false, anything else null."""
    return F.when(c.rlike("^[Yy]"), True).when(c.rlike("^[Nn]"), False)


def null_codes_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NULL_CODES), c)


def to_centimetres(metres: Column) -> Column:
    """Metres to centimetres; null codes keep their value."""
    scaled = metres * 100
    coded = F.bround(scaled).isin(*[code * 100 for code in NULL_CODES])
    return F.when(coded, F.bround(scaled / 100)).otherwise(scaled)


def standard_date_type(c: Column) -> Column:
    result = None
    for pattern, name in _DATE_TYPES:
        test = c.rlike(pattern)
        result = F.when(test, name) if result is None else result.when(test, name)
    return result.otherwise(c)


def is_hiatus(date_type: Column) -> Column:
    return date_type.rlike(_HIATUS)


def positive_error(error: Column) -> Column:
    """A missing or non-positive dating error counts as one year."""
    return F.when(error.isNull() | (error <= 0), 1.0).otherwise(error)


def calibration_curve(date_type: Column, latitude: Column) -> Column:
    """0 = calendar date; 1 / 3 / 4 = northern / southern / mixed tropical radiocarbon curve."""
    return (
        F.when(~F.coalesce(date_type.rlike(_RADIOCARBON), F.lit(False)), 0)
        .when(latitude <= -15, 3)
        .when((latitude > -15) & (latitude < 15), 4)
        .otherwise(1)
    )


def within_age_tolerance(age: Column, archive_age: Column, *, by_size: bool = False) -> Column:
    """Rounded age within 1 % of the archive's, or both missing; null if one is missing.

    The bounds of a negative age lie the wrong way round, so it never matches; ``by_size``
    compares against one per cent of its absolute value instead.
    """
    a, b = F.bround(age), F.bround(archive_age)
    inside = F.abs(a - b) <= F.abs(b) * 0.01 if by_size else (a >= b * 0.99) & (a <= b * 1.01)
    return inside | (age.isNull() & archive_age.isNull())


def fill_unknown(c: Column) -> Column:
    return F.when(c.isNull() | c.contains("unknown"), "not known").otherwise(c)


def derive_age_used(reason: Column) -> Column:
    return F.when(reason.isNull(), "yes").otherwise("no")
