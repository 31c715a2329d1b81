import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from duebook.functions.amounts import charge_sign, german_decimal, parse_german_decimal, units
from duebook.functions.dates import german_date, local_date
from duebook.functions.fingerprint import row_fingerprint
from duebook.functions.text import comma_list, concat_skipping_nulls, safe_id


def one(spark, column, data=((1,),), schema="x int"):
    return spark.createDataFrame(list(data), schema).select(column.alias("v")).first().v


def test_german_decimals(spark):
    values = spark.createDataFrame([(-1230,), (5,), (None,)], "c bigint").select(german_decimal("c").alias("v")).collect()
    assert [r.v for r in values] == ["12,30", "0,05", None]
    parsed = spark.createDataFrame([("12,30",), ("x",)], "t string").select(parse_german_decimal("t").alias("v")).collect()
    assert [r.v for r in parsed] == [Decimal("12.30"), None]


def test_local_date_in_any_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-06-30 22:30:00' as t, timestamp_ntz'2024-01-30 22:30:00' as w")
    for zone in ("UTC", "America/New_York", "Europe/Berlin"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            row = df.select(local_date("t").alias("a"), local_date("w").alias("b")).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert (row.a, row.b) == (dt.date(2024, 7, 1), dt.date(2024, 1, 30))


def test_german_date(spark):
    df = spark.createDataFrame([("31.12.2023",), ("2023-12-31",), (None,)], "t string")
    assert [r.v for r in df.select(german_date("t").alias("v")).collect()] == [dt.date(2023, 12, 31), None, None]


def test_inverted_signs(spark):
    glids = ["OVERPAYMENT_CREDIT", "ELEC_MANUAL_BONUS", "OVERPAYMENT_CREDIT_REJECTED", "_MANUAL_BONUS", "X"]
    df = spark.createDataFrame([(g,) for g in glids], "g string")
    # the wildcard before MANUAL needs a character, '%' before it may be empty
    assert [r.v for r in df.select(charge_sign("g").alias("v")).collect()] == [-1, -1, 1, -1, 1]


def test_units_are_exact(spark):
    assert one(spark, units(F.lit("1234.50"))) == Decimal("12.345000")


def test_fingerprint_separates_columns_and_nulls(spark):
    df = spark.createDataFrame([("a", "b"), ("ab", ""), ("ab", None), (None, "ab")], "x string, y string")
    assert df.select(row_fingerprint("x", "y")).distinct().count() == 4


def test_text_helpers(spark):
    assert one(spark, safe_id(F.lit("x"))) is None
    assert one(spark, safe_id(F.lit(" 2"))) == 2
    assert one(spark, comma_list(F.lit(""))) is None
    assert one(spark, comma_list(F.lit("1,,2"))) == ["1", "", "2"]
    assert one(spark, concat_skipping_nulls(F.lit("a"), F.lit(None), F.lit("b"))) == "ab"
