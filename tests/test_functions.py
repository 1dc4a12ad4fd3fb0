import pytest
from pyspark.sql import functions as F

from siltframe import functions as fn


def values(df, column):
    return [r[0] for r in df.select(column.alias("v")).collect()]


@pytest.fixture
def text(frame):
    return lambda *v: frame("t string", *[(x,) for x in v])


def test_flags(text):
    df = text("Yes", "y", "No - ignore", "n", "ignore", "", None)
    assert values(df, fn.parse_flag(F.col("t"))) == [True, True, False, False, None, None, None]


def test_squish_and_codes(text):
    assert values(text("  a \t b\n c "), fn.squish(F.col("t"))) == ["a b c"]
    assert values(text(" LAB - 12 3"), fn.strip_code(F.col("t"))) == ["LAB123"]
    assert values(text("NULL", "x", None), fn.null_text(F.col("t"))) == [None, "x", None]


def test_clean_name(text):
    df = text("Étang de la  Grée (2)", "ETANG DE LA GREE 2")
    assert values(df, fn.clean_name(F.col("t"))) == ["etangdelagree2"] * 2


def test_snake_case_gives_repeated_headers_their_position():
    assert fn.snake_case(["Entity name", "siteName", "Entity name", "Depth (cm)"]) == [
        "entity_name_1",
        "site_name",
        "entity_name_3",
        "depth_cm",
    ]


def test_null_codes_survive_the_unit_change(frame):
    df = frame("v double", (-777777.0,), (-888888.0,), (-999999.0,), (1.23,), (None,))
    assert values(df, fn.to_centimetres(F.col("v"))) == [-777777.0, -888888.0, -999999.0, 123.0, None]
    assert values(df, fn.null_codes_to_null(F.col("v"))) == [None, None, None, 1.23, None]


def test_row_maximum_propagates_null(frame):
    df = frame("a double, b double", (5.0, 3.0), (None, 3.0), (None, None))
    assert values(df, fn.null_max(F.col("a"), F.col("b"))) == [5.0, None, None]


def test_rounding_is_half_even(frame):
    df = frame("v double", (0.5,), (1.5,), (2.5,), (-2.5,))
    assert values(df, F.bround("v")) == [0.0, 2.0, 2.0, -2.0]


def test_age_gate(frame):
    df = frame("b double, a double", (100.0, 101.0), (100.0, 103.0), (None, None), (None, 5.0), (-60.0, -60.0))
    assert values(df, fn.within_age_tolerance(F.col("a"), F.col("b"))) == [True, False, True, None, False]
    assert values(df, fn.within_age_tolerance(F.col("a"), F.col("b"), by_size=True))[-1] is True


def test_if_else_keeps_a_null_test_null(frame):
    df = frame("v double", (1.0,), (3.0,), (None,))
    assert values(df, fn.if_else(F.col("v") > 2, F.lit("high"), F.lit("low"))) == ["low", "high", None]


def test_date_types_first_hit_wins(text):
    df = text("core top estimated", "old core known", "tephra", None)
    assert values(df, fn.standard_date_type(F.col("t"))) == [
        "Top of core estimated",
        "Top of core known",
        "tephra",
        None,
    ]


def test_calibration_curves(frame):
    df = frame(
        "t string, lat double",
        ("AMS", 40.0),
        ("AMS", -15.0),
        ("AMS", 0.0),
        ("AMS", 15.0),
        ("tephra", -40.0),
        ("AMS", None),
        (None, 1.0),
    )
    assert values(df, fn.calibration_curve(F.col("t"), F.col("lat"))) == [1, 3, 4, 1, 0, 1, 0]


def test_fills(frame):
    df = frame("t string", ("unknown", ), ("peat",), (None,))
    assert values(df, fn.fill_unknown(F.col("t"))) == ["not known", "peat", "not known"]
    assert values(df, fn.derive_age_used(F.col("t"))) == ["no", "no", "yes"]
