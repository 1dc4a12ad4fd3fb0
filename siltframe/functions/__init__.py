"""Column expressions; everything here stays inside the JVM."""

from .text import clean_name, null_text, snake_case, squish, strip_code
from .values import (
    NULL_CODES,
    calibration_curve,
    derive_age_used,
    fill_unknown,
    if_else,
    is_hiatus,
    null_codes_to_null,
    null_max,
    parse_flag,
    positive_error,
    standard_date_type,
    to_centimetres,
    within_age_tolerance,
)

__all__ = [
    "NULL_CODES",
    "calibration_curve",
    "clean_name",
    "derive_age_used",
    "fill_unknown",
    "if_else",
    "is_hiatus",
    "null_codes_to_null",
    "null_max",
    "null_text",
    "parse_flag",
    "positive_error",
    "snake_case",
    "squish",
    "standard_date_type",
    "strip_code",
    "to_centimetres",
    "within_age_tolerance",
]
