"""Hand-computed field texts."""

import pytest

from quartermill.functions import formats as f, packing
from quartermill.functions.text import jurisdiction, jurisdiction_class, jurisdiction_key

Q = f.quote


def one(spark, expression):
    return spark.sql(f"SELECT {expression} AS v").first()["v"]


CASES = [
    (f.overflow_field(Q("CS"), "'JOHN'", 12, "A1", 12), "CSJOHN        "),
    (f.overflow_field(Q("CU"), "' SMITH '", 14, "A2", 14), "CUSMITH         "),
    (f.overflow_field(Q("CS"), "'MAXIMILIANA-13'", 12, "A1", 12), "CSMAXIMILIANA-A113      "),
    (f.overflow_field(Q("CU"), "'FEATHERSTONEHAUGH-11'", 14, "A2", 14), "CUFEATHERSTONEHAA2UGH-11"),
    (f.overflow_field(Q("CU"), "'FEATHERSTONEHAUGH-112'", 14, "A2", 14), "CUFEATHERSTONEHAA2UGH-11"),
    (f.identity_field(Q("DD"), "'123456789'"), "DD123-45-6789"),
    (f.identity_field(Q("DD"), "'123-45-6789'"), "DD123-45-6789"),
    (f.identity_field(Q("DD"), "'12A45B789'"), "DD12A45B789"),
    (f.identity_field(Q("DD"), "CAST(NULL AS STRING)"), None),
    (f.date_field(Q("SY"), "DATE '1985-03-15'", "yyyyMMdd"), "SY19850315"),
    (f.date_field(Q("NZ"), "DATE '2020-06-01'", "MMddyyyy"), "NZ06012020"),
    (f.decimal_field(Q("A7"), "CAST(25.5 AS DECIMAL(18,4))", 10, 4, False), "A70000255000"),
    (f.decimal_field(Q("A7"), "CAST(-12 AS DECIMAL(18,0))", 6, 0, False), "A7000-12"),
    (f.decimal_field(Q("A7"), "CAST(1.13 AS DECIMAL(18,2))", 6, 2, True), "A7+00113"),
    (f.number_field(Q("N1"), "-7", 5, True), "N1-0007"),
    (f.number_field(Q("N1"), "7", 5, False), "N100007"),
    (f.text_field(Q("G4"), "''", 6), "G4      "),
    (f.text_field(Q("G4"), "'abcdefgh'", 6), "G4abcdef"),
    (f.text_field(Q("G4"), "'ab'", 4, "left"), "G4  ab"),
    (f.text_field(Q("G4"), "CAST(NULL AS STRING)", 6), None),
    (f.amount_field("'EJ'", "CAST(1500 AS DECIMAL(18,2))", "12", "false", 2), "EJ+00000150000"),
    (f.amount_field("'EK'", "CAST(1500 AS DECIMAL(18,2))", "14", "false", 2), "EK+0000000150000"),
    (f.amount_field("'EJ'", "CAST(-12.34 AS DECIMAL(18,2))", "12", "false", 2), "EJ-00000001234"),
    (f.amount_field("'EJ'", "CAST(0 AS DECIMAL(18,2))", "12", "false", 2), None),
    (f.amount_field("'EJ'", "CAST(NULL AS DECIMAL(18,2))", "12", "true", 2), None),
    (f.amount_field("CAST(NULL AS STRING)", "CAST(5 AS DECIMAL(18,2))", "12", "NULL", 2), None),
    (f.amount_field("'7H'", "CAST(0 AS DECIMAL(18,2))", "12", "true", 2), "7H+00000000000"),
    (f.amount_field("'NT'", "CAST(15000 AS DECIMAL(18,2))", "12", "false", 2), "NT+00001500000"),
    (f.flag_text_field("'DH'", "'M'"), "DHM"),
    (f.count_field("'DI'", "3"), "DI03"),
    (f.place_field("'X1'", "'12345'"), "X1012345"),
    (f.place_field("'X1'", "'  '"), None),
    (f.zero_text("12", "true"), "+00000000000"),
    (f.zero_text("14", "true"), "+0000000000000"),
    (f.zero_text("8", "false"), "00000000"),
    (jurisdiction("CAST(NULL AS STRING)", "CAST(NULL AS STRING)"), "F"),
    (jurisdiction("'CA'", "CAST(NULL AS STRING)"), "CA"),
    (jurisdiction("'CA'", "'000123'"), "CA0123"),
    (jurisdiction_key("'CA'"), "CA    "),
    (jurisdiction_class("'CA'"), "S"),
    (jurisdiction_class("'CA0123'"), "L"),
    (jurisdiction_class("''"), "S"),
]


@pytest.mark.parametrize("expression, expected", CASES)
def test_field_text(spark, expression, expected):
    assert one(spark, expression) == expected


def test_overflow_flag(spark):
    assert one(spark, f.amount_overflows("CAST(12345678901.00 AS DECIMAL(18,2))", "12", 2)) is True
    assert one(spark, f.amount_overflows("CAST(1.00 AS DECIMAL(18,2))", "12", 2)) is False


def test_quote_keeps_quotes_and_backslashes(spark):
    assert one(spark, f.quote("a'b\\c")) == "a'b\\c"


def test_worker_prefix_is_twelve_wide(spark):
    assert one(spark, packing.WORKER_PREFIX) == "******      "
