"""Column helpers on their edge cases."""

import datetime

import pytest
from pyspark.sql import functions as F

from runlake.functions import columns as C

UTC = datetime.timezone.utc


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("text, n", [("12", 12), ("-3", -3), ("", None), ("1.5", None), ("99999999999999999999", None), (" 1", None)])
def test_to_int(spark, text, n):
    assert one(spark, C.to_int(F.lit(text))) == n


def test_to_int_keeps_to_a_limit(spark):
    assert one(spark, C.to_int(F.lit("4294967295"), C.U32)) == C.U32
    assert one(spark, C.to_int(F.lit("4294967296"), C.U32)) is None


@pytest.mark.parametrize("text, x", [("0.5", 0.5), (".5", 0.5), ("1.2.3", None), ("abc", None), ("3", 3.0)])
def test_to_float(spark, text, x):
    assert one(spark, C.to_float(F.lit(text))) == x


def test_trim_takes_white_space_of_any_script(spark):
    assert one(spark, C.trim_ws(F.lit("  a b \n"))) == "a b"


def test_iso_time(spark):
    assert one(spark, C.parse_iso(F.lit("2031-03-05T08:15:20.125-0400"))).replace(tzinfo=UTC) == datetime.datetime(2031, 3, 5, 12, 15, 20, 125000, UTC)
    assert one(spark, C.parse_iso(F.lit("10.5s"))) is None


@pytest.mark.parametrize("zone, offset", [("EDT", "-0400"), ("EST", "-0500"), ("PST", None)])
def test_only_eastern_zones_are_known(spark, zone, offset):
    assert one(spark, C.zone_offset(F.lit(zone))) == offset


def test_a_date_must_have_its_weekday(spark):
    parts = [F.lit(x) for x in ("Jul", "8", "06:07:08", "EDT", "2031")]
    assert one(spark, C.parse_zoned(*parts, F.lit("Tue"))) is not None
    assert one(spark, C.parse_zoned(*parts, F.lit("Mon"))) is None


def test_whole_parts_are_cut_off(spark):
    assert one(spark, C.to_micros(F.lit(1.9999), 1e3)) == 1999
    assert one(spark, C.truncated(F.lit(-1.9))) == -1
    assert one(spark, C.unsigned_diff(F.lit(3), F.lit(5))) is None


def test_epoch_numbers(spark):
    assert one(spark, C.from_epoch_ns(F.lit(1_000_000_007))) == one(spark, F.timestamp_micros(F.lit(1_000_000)))
    assert one(spark, C.from_epoch_ns(F.lit(-1))) == one(spark, F.timestamp_micros(F.lit(-1)))
