from decimal import Decimal

from pyspark.sql import functions as F

from marketlens.functions import avg_elapsed, avg_exact, calendar_days, day_name, elapsed_micros, iso_dow, month_of, pct, round2
from tests.conftest import ts


def test_round_half_away_from_zero_on_decimal(spark):
    df = spark.createDataFrame([(Decimal("1.005"),), (Decimal("-1.005"),), (Decimal("2.675"),)], "x decimal(12,3)")
    assert [r[0] for r in df.select(round2("x")).collect()] == [Decimal("1.01"), Decimal("-1.01"), Decimal("2.68")]


def test_pct_null_on_zero_and_rounding(spark):
    df = spark.createDataFrame([(1, 3), (2, 0), (1, 8)], "a long, b long")
    out = [r[0] for r in df.select(pct("a", "b")).collect()]
    assert out == [Decimal("33.33"), None, Decimal("12.50")]


def test_avg_exact_matches_sql_definition(spark):
    df = spark.createDataFrame([(Decimal("10.00"),), (Decimal("10.01"),), (Decimal("10.01"),)], "x decimal(12,2)")
    assert df.agg(avg_exact("x")).first()[0] == Decimal("10.01")
    assert spark.createDataFrame([], "x decimal(12,2)").agg(avg_exact("x")).first()[0] is None


def test_day_of_week_and_name(spark):
    df = spark.createDataFrame([(ts("2020-01-04 12:00:00"),)], "t timestamp_ntz")
    r = df.select(iso_dow("t").alias("d"), day_name("t").alias("n"), month_of("t").alias("m")).first()
    assert (r.d, r.n, str(r.m)) == (6, "Saturday", "2020-01-01")


def test_calendar_vs_elapsed_days(spark):
    df = spark.createDataFrame([(ts("2020-01-01 23:00:00"), ts("2020-01-02 01:00:00"))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(calendar_days("a", "b").alias("cal"), elapsed_micros("a", "b").alias("us")).first()
    assert r.cal == 1
    assert round(r.us / 86400e6, 2) == 0.08


def test_trim_removes_spaces_only(spark):
    df = spark.createDataFrame([(" \t ",), ("  ",)], "s string")
    assert [r[0] for r in df.select(F.trim("s") != "").collect()] == [True, False]


def test_avg_elapsed_is_rounded_once(spark):
    """Means just below and at a half cent, both signs: 1.0049996 days is 1.00, 1.005 is 1.01."""
    day = 86_400_000_000
    for micros, want in [([int(1.0049996 * day)], "1.00"), ([1005 * day // 1000], "1.01"), ([-1005 * day // 1000], "-1.01"),
                         ([day, day + day // 50], "1.01"), ([0], "0.00")]:
        df = (spark.createDataFrame([(m,) for m in micros], "us long")
              .select(F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("a"), "us")
              .withColumn("b", F.timestamp_add("MICROSECOND", F.col("us"), F.col("a"))))
        assert df.agg(avg_elapsed("a", "b")).first()[0] == Decimal(want), micros
    assert df.limit(0).agg(avg_elapsed("a", "b")).first()[0] is None
    assert df.agg(avg_elapsed("a", "b", "hour")).first()[0] == Decimal("0.00")
