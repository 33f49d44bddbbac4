import datetime as dt

from pyspark.sql import functions as F

from ovenbird.functions import money, timefn


def test_boundary_counting(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0),
                                 dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0))],
                               "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz, d timestamp_ntz")
    r = df.select(timefn.days_between("a", "b").alias("days"),
                  timefn.minutes_between("c", "d").alias("mins")).first()
    assert r.days == 1  # one midnight crossed
    assert r.mins == 1  # one minute boundary crossed


def test_weekday_and_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 6),), (dt.date(2024, 1, 8),)], "d date")
    rows = df.select("d", timefn.day_of_week0("d").alias("dow"), timefn.is_weekend("d").alias("we"),
                     timefn.week_start("d").alias("wk"), timefn.day_name("d").alias("dn"),
                     timefn.mmdd("d").alias("mmdd"), timefn.month_key("d").alias("mk")).collect()
    by = {r.d: r for r in rows}
    assert by[dt.date(2024, 1, 7)].dow == 0 and by[dt.date(2024, 1, 7)].we  # Sunday
    assert by[dt.date(2024, 1, 6)].dow == 6 and by[dt.date(2024, 1, 6)].we  # Saturday
    assert not by[dt.date(2024, 1, 8)].we
    assert by[dt.date(2024, 1, 7)].wk == dt.date(2024, 1, 1)  # weeks start on Monday
    assert by[dt.date(2024, 1, 7)].dn == "Sun"
    assert by[dt.date(2024, 1, 7)].mmdd == "0107" and by[dt.date(2024, 1, 7)].mk == "2024-01"


def test_rounding_rules(spark):
    df = spark.createDataFrame([(2.675, 5)], "x double, n int")
    r = df.select(money.js_round2(F.col("x")).alias("js"),
                  money.round_avg(F.lit(12.525).cast("decimal(10,3)"), F.lit(1), 2).alias("ra")).first()
    assert r.js == 2.68
    assert float(r.ra) == 12.53  # half away from zero on the exact value


def test_nullif_guard(spark):
    df = spark.createDataFrame([(10, 0), (10, 5)], "a int, b int")
    out = [r.q for r in df.select((F.col("a") / money.nullif_zero("b")).alias("q")).collect()]
    assert out[0] is None and out[1] == 2.0
