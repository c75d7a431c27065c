import datetime as dt

from pyspark.sql import functions as F

from stopwise.functions import timeutil as tu


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def _ntz(text):
    return F.lit(text).cast("timestamp_ntz")


def test_service_date_turns_at_three(spark):
    for clock, want in (("2023-12-15 03:00:00", 15), ("2023-12-15 05:45:00", 15), ("2023-12-16 02:59:59", 15), ("2023-12-16 03:00:00", 16)):
        assert _one(spark, tu.service_date(_ntz(clock))) == dt.date(2023, 12, want)


def test_date_integers(spark):
    assert _one(spark, tu.to_date_from_int(F.lit(20240207))) == dt.date(2024, 2, 7)
    assert _one(spark, tu.to_date_from_int(F.lit(20241399))) is None
    assert _one(spark, tu.date_int(F.lit("2024-02-07").cast("date"))) == 20240207


def test_times_past_midnight(spark):
    assert _one(spark, tu.seconds_of_time(F.lit("25:10:00"))) == 90600
    assert _one(spark, tu.seconds_of_time(F.lit("noon"))) is None


def test_elapsed_seconds_on_the_day_clocks_change(spark):
    noon = F.to_utc_timestamp(F.lit("2024-03-10 12:00:00").cast("timestamp"), tu.ZONE)
    assert _one(spark, tu.elapsed_since_midnight(noon, F.lit("2024-03-10").cast("date"))) == 39600


def test_buckets_when_clocks_go_back(spark):
    day = F.lit("2024-11-03").cast("date")
    for utc, want in (("2024-11-03 05:29:59", 2), ("2024-11-03 05:30:00", 3), ("2024-11-03 06:15:00", 3), ("2024-11-03 06:59:59", 3), ("2024-11-03 07:00:00", 4), ("2024-11-03 03:59:59", None)):
        assert _one(spark, tu.clock_bucket(F.lit(utc).cast("timestamp"), day)) == want


def test_buckets_when_clocks_go_forward(spark):
    day = F.lit("2024-03-10").cast("date")
    for utc, want in (("2024-03-10 06:59:59", 3), ("2024-03-10 07:00:00", 6)):
        assert _one(spark, tu.clock_bucket(F.lit(utc).cast("timestamp"), day)) == want


def test_placeholder_time(spark):
    assert _one(spark, tu.placeholder_time(F.lit("2020-01-15").cast("date"), _ntz("1900-01-02 01:35:00"))) == dt.datetime(2020, 1, 16, 1, 35)


def test_rounding(spark):
    assert [_one(spark, tu.round_half_even(F.lit(float(x)))) for x in (445, 455)] == [440, 460]
    assert [_one(spark, tu.ceil_to(F.lit(x), 30)) for x in (91.0, 90.0)] == [120, 90]


def test_ranges(spark):
    assert tu.date_range(spark, "2024-02-28", "2024-03-01").count() == 3
    assert [r.date.month for r in tu.date_range(spark, "2024-11-15", "2025-01-02", months=True).collect()] == [11, 12, 1]
