"""Time helpers at their edges, against plain Python."""

from datetime import datetime, timezone
from math import floor

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelink.functions import timefn as T


def utc(*parts):
    return datetime(*parts, tzinfo=timezone.utc)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def at(text):
    return F.lit(text).cast("timestamp")


def micros(column):
    return F.unix_micros(column)


def of(moment):
    return round(moment.replace(microsecond=0).timestamp()) * 1_000_000 + moment.microsecond


def test_minutes_are_counted_by_their_boundaries(spark):
    rows = [("2020-01-01 00:00:59", "2020-01-01 00:01:01", 1), ("2020-01-01 00:00:00", "2020-01-01 00:00:59.999", 0),
            ("2020-01-01 00:01:01", "2020-01-01 00:00:59", 1), ("1969-12-31 23:59:59", "1970-01-01 00:00:00", 1),
            ("2019-12-31 23:59:30", "2020-01-01 00:30:00", 31), (None, "2020-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, "a string, b string, want long")
    got = df.select(T.minute_boundary_diff(F.col("a").cast("timestamp"), F.col("b").cast("timestamp")).alias("x"), "want")
    assert all(r["x"] == r["want"] for r in got.collect())


def test_offsets_are_whole_milliseconds_rounded_down(spark):
    a = at("2020-01-01 00:00:00.0005")
    assert one(spark, T.elapsed_ms(a, at("2020-01-01 00:00:01.0004"))) == 999
    assert one(spark, T.offset_seconds(at("2020-01-01 00:00:01.5005"), a)) == 1.5
    assert one(spark, T.elapsed_ms(at("2020-01-01 00:00:00.001"), at("2020-01-01 00:00:00.0005"))) == -1


def test_seconds_are_added_to_the_microsecond(spark):
    t = at("2020-02-28 23:59:59.9")
    for secs in (0.1, -0.0000004, 86400.000001, None):
        got = one(spark, micros(T.add_seconds(t, F.lit(secs).cast("double"))))
        assert got == (None if secs is None else of(utc(2020, 2, 28, 23, 59, 59, 900000)) + round(secs * 1e6))


def test_epochs_in_seconds_or_milliseconds(spark):
    limit = T.EPOCH_MS_THRESHOLD
    cases = {0.0: 0, 1.5: 1_500_000, -1.0: -1_000_000, float(limit - 1): (limit - 1) * 10**6,
             float(limit): limit * 1000, limit + 0.9: limit * 1000, 1577836800123.0: 1577836800123000,
             253402300799999.0: 253402300799999000}
    unreadable = [None, float("nan"), float("inf"), float("-inf"), 1e300, -1e300, 253402300800000.0, -62135596801.0]
    df = spark.createDataFrame([(x,) for x in [*cases, *unreadable]], "x double")
    got = [r["t"] for r in df.select(micros(T.epoch_auto("x")).alias("t")).collect()]
    assert got == [*cases.values(), *[None] * len(unreadable)]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-6e10, 2.5e14), min_size=50, max_size=200))
def test_any_epoch_is_read_as_python_reads_it(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i long, x double")
    got = {r["i"]: r["t"] for r in df.select("i", micros(T.epoch_auto("x")).alias("t")).collect()}
    for i, x in enumerate(xs):
        want = floor(x) * 1000 if x >= T.EPOCH_MS_THRESHOLD else x * 1e6
        assert abs(got[i] - want) <= 0.5


def test_wall_clocks_around_a_change_of_the_clock(spark):
    zone = "America/New_York"
    assert one(spark, micros(T.local_to_utc(at("2020-03-08 01:59:59"), zone))) == of(utc(2020, 3, 8, 6, 59, 59))
    assert one(spark, micros(T.local_to_utc(at("2020-03-08 03:00:00"), zone))) == of(utc(2020, 3, 8, 7))
    assert one(spark, micros(T.local_to_utc(at("2020-11-01 00:59:59"), F.lit(zone)))) == of(utc(2020, 11, 1, 4, 59, 59))
    for moment in ("2020-07-01 12:00:00", "2020-12-01 12:00:00", "2020-11-01 07:00:00"):
        back = T.local_to_utc(T.utc_to_local(at(moment), zone), zone)
        assert one(spark, micros(back)) == one(spark, micros(at(moment)))
    assert one(spark, T.local_to_utc(F.lit(None).cast("timestamp"), zone)) is None


def test_days_begin_at_midnight_utc(spark):
    assert one(spark, micros(T.day_of(at("2020-02-29 23:59:59.999999")))) == of(utc(2020, 2, 29))
    assert one(spark, micros(T.day_of(at("1969-12-31 00:00:01")))) == of(utc(1969, 12, 31))
