from pyspark.sql import functions as F

from routeweave.functions.timefmt import iso_datetime, journey_hours, split_datetime


def _hours(spark, dep, arr):
    df = spark.createDataFrame([(dep, arr)], "d STRING, a STRING")
    return df.select(journey_hours(F.col("d"), F.col("a"))).collect()[0][0]


def test_journey_hours_cases(spark):
    assert _hours(spark, "2031-04-17T09:35:00.000Z", "2031-04-17T12:00:00.000Z") == 2
    # same hour, earlier minute: clock says 0 hours and -35 minutes -> 0
    assert _hours(spark, "2031-04-17T10:50:00.000Z", "2031-04-18T10:15:00.000Z") == 0
    # over midnight: +24 h rule
    assert _hours(spark, "2031-04-17T23:30:00.000Z", "2031-04-18T01:10:00.000Z") == 1
    # 25 hours on the calendar is understated to 1 (the date is ignored)
    assert _hours(spark, "2031-04-17T10:00:00.000Z", "2031-04-18T11:00:00.000Z") == 1


def test_split_datetime_and_iso(spark):
    df = spark.createDataFrame([("2031-04-17T09:35:00.000Z",)], "d STRING")
    assert df.select(split_datetime(F.col("d"))).collect()[0][0] == ["2031-04-17", "09:35:00", "000Z"]
    one = spark.createDataFrame([(125,)], "m INT").select(
        iso_datetime(F.to_date(F.lit("2024-01-03")), F.col("m"))).collect()[0][0]
    assert one == "2024-01-03T02:05:00.000Z"
