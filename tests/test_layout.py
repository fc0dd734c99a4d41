import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from raceway import sources
from raceway.contracts import Contract, Field
from raceway.operators import cluster_on_curve
from raceway.sources import variants


def files_that_may_hold(df, path, column, value):
    """Files of a table left by minimum and maximum, and files in all."""
    stored = df.sparkSession.read.parquet(path).withColumn("file", F.input_file_name())
    bounds = stored.groupBy("file").agg(F.min(column).alias("low"), F.max(column).alias("high"))
    return bounds.filter(F.lit(value).between(F.col("low"), F.col("high"))).count(), bounds.count()


@pytest.fixture
def laps(spark):
    # Half of all rows are of driver 1; the days are uneven.
    driver = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 50)
    race = F.pmod(F.xxhash64("id"), F.lit(400))
    day = F.date_add(F.lit(date(2024, 1, 1)), F.pow(F.col("id") % 37, F.lit(2)).cast("int"))
    return spark.range(40_000).select(driver.alias("driver"), race.alias("race"), day.alias("day"), "id")


def test_a_filter_on_any_key_skips_most_files(spark, laps, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        cluster_on_curve(laps, ["driver", "race"]).write.parquet(f"{tmp_path}/curve")
        sources.cluster_for_write(laps, ["driver", "race"]).write.parquet(f"{tmp_path}/plain")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(f"{tmp_path}/curve")
    assert stored.count() == 40_000 and stored.exceptAll(laps).isEmpty()
    left, of = files_that_may_hold(laps, f"{tmp_path}/curve", "race", 123)
    assert left * 5 <= of  # a fifth; by driver first it is nearly every file of a driver with few rows
    assert files_that_may_hold(laps, f"{tmp_path}/curve", "driver", 7)[0] * 4 <= of
    assert left < files_that_may_hold(laps, f"{tmp_path}/plain", "race", 123)[0]


def test_curve_takes_nulls_days_and_empty_tables(spark, laps):
    keys = ["driver", "race", "day"]
    some = laps.limit(500).withColumn("race", F.when(F.col("race") > 50, F.col("race")))
    assert cluster_on_curve(some, keys).exceptAll(some).isEmpty()
    assert cluster_on_curve(laps.limit(0), keys).count() == 0
    assert cluster_on_curve(spark.createDataFrame([(None,)], "a int"), ["a"]).collect() == [(None,)]
    with pytest.raises(ValueError, match="no place"):
        cluster_on_curve(spark.createDataFrame([("x",)], "a string"), ["a"])
    with pytest.raises(ValueError, match="fit"):
        cluster_on_curve(laps, keys, bits=30)


def test_a_warehouse_table_can_lie_on_the_curve(spark, laps, tmp_path):
    contract = Contract("Laps", ("id", "race"), (Field("id", T.LongType()), Field("race", T.LongType())))
    rows = laps.select("id", "race")
    sources.write_warehouse(rows, contract, str(tmp_path), layout=cluster_on_curve)
    assert spark.read.parquet(f"{tmp_path}/Laps").exceptAll(rows).isEmpty()


def test_variants_tell_numbers_text_and_null_apart(spark, tmp_path):
    records = [
        {"k": 1, "gap": 1.5}, {"k": 2, "gap": "+1 LAP"}, {"k": 3, "gap": None}, {"k": 4}, {"k": 5, "gap": "12"},
        {"k": 6, "gap": 7}, {"k": 7, "gap": True}, {"k": 8, "gap": [1, 2]}, {"k": 9, "gap": ""}, {"k": 10, "gap": 1e300},
    ]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text("\n".join(map(json.dumps, records)))
    variants.read_json_records(spark, f"{tmp_path}/raw").write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    got = stored.select(variants.field("record", "k", "long").alias("k"), variants.mixed("record", "gap").alias("v")).select("k", "v.*")
    rows = {r.k: (r.kind, r.number) for r in got.collect()}
    assert rows == {
        1: ("number", 1.5), 2: ("text", None), 3: ("null", None), 4: ("absent", None), 5: ("text", None),
        6: ("number", 7.0), 7: ("boolean", None), 8: ("other", None), 9: ("text", None), 10: ("number", 1e300),
    }
    text = {r.k: r.text for r in got.collect()}
    assert (text[2], text[3], text[4], text[5], text[6], text[8], text[9]) == ("+1 LAP", None, None, "12", "7", "[1,2]", "")


def test_a_broken_record_raises_and_odd_names_are_found(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"it\'s a.b": 4}\n')
    df = variants.read_json_records(spark, f"{tmp_path}/a.json")
    assert df.select(variants.field("record", "it's a.b", "int")).first()[0] == 4
    (tmp_path / "b.json").write_text('{"k": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        variants.read_json_records(spark, f"{tmp_path}/b.json").collect()
