from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from raceway.functions import day_number, endpoint_name, instant, mapped, whole_second, written_day


def one(spark, column, kind, value):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("x")).first()[0]


def ntz(column):
    return column.cast("timestamp_ntz")


@pytest.mark.parametrize(
    "text, utc",
    [
        ("2023-08-26T23:30:47+00:00", datetime(2023, 8, 26, 23, 30, 47)),
        ("2023-08-26T23:30:47.125000+02:00", datetime(2023, 8, 26, 21, 30, 47, 125000)),
        ("2023-08-26T23:30:47", datetime(2023, 8, 26, 23, 30, 47)),
        (None, None),
    ],
)
def test_instant_honours_the_offset(spark, text, utc):
    assert one(spark, ntz(instant("v")), "string", text) == utc


def test_malformed_time_raises_or_gives_null(spark):
    assert one(spark, instant("v", strict=False), "string", "not a time") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE"):
        one(spark, instant("v"), "string", "not a time")


def test_written_day_ignores_offset_and_session_zone(spark, conf):
    conf("spark.sql.session.timeZone", "Europe/Rome")
    assert one(spark, written_day("v"), "string", "2023-08-26T23:30:47+00:00") == date(2023, 8, 26)


def test_whole_second(spark):
    value = datetime(2024, 1, 1, 10, 0, 1, 999999)
    assert one(spark, ntz(whole_second("v")), "timestamp_ntz", value) == datetime(2024, 1, 1, 10, 0, 1)


def test_day_number(spark):
    assert one(spark, day_number("v"), "date", date(2024, 1, 1)) == 19723
    assert one(spark, day_number("v"), "date", None) is None


@pytest.mark.parametrize(
    "url, name",
    [
        ("https://a.example/v1/position", "position"),
        ("https://a.example/v1/car_data?session_key=1&driver_number=2", "car_data"),
        ("https://a.example/en/25#top", "25#top"),
        ("https://a.example/en/853/", ""),
        ("plain", "plain"),
        (None, None),
    ],
)
def test_endpoint_name(spark, url, name):
    assert one(spark, endpoint_name("v"), "string", url) == name


def test_mapped_misses_are_null(spark):
    df = spark.createDataFrame([(1,), (10,), (11,), (20,), (21,), (None,)], "p int")
    points = {1: 25, 10: 1, 11: 0, 20: 0}
    found = rows(df.select("p", mapped(F.col("p"), points).alias("x")))
    assert found == [(None, None), (1, 25), (10, 1), (11, 0), (20, 0), (21, None)]
