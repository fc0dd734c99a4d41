from datetime import date, datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from raceway import operators as ops
from raceway.contracts import DRIVERS, PIT_STOPS, RESULTS
from raceway.functions import instant, written_day
from raceway.sources import write_warehouse


def test_latest_per_key_orders_by_instant_not_text(spark):
    df = spark.createDataFrame(
        [
            (1, 9, "2023-08-26T12:00:00+02:00", 5),  # 10:00 UTC, though the larger text
            (1, 9, "2023-08-26T11:00:00+00:00", 3),
            (1, 9, "2023-08-26T11:00:00.000+00:00", 2),  # the same instant
            (1, 9, None, 1),
            (2, 9, None, 7),  # alone in its group
            (3, 9, "2023-08-26T10:00:00+00:00", None),
            (3, 9, "2023-08-26T10:00:00+00:00", 4),
        ],
        "car int, race int, date string, position int",
    )
    got = ops.latest_per_key(df, ["car", "race"], [instant("date"), "position"])
    assert rows(got, "car", "position") == [(1, 3), (2, 7), (3, 4)]
    assert got.columns == df.columns


def test_latest_per_key_reduces_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 1)], "k int, t int")
    text = plan(ops.latest_per_key(df, ["k"], ["t"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1


def test_latest_narrow_agrees_with_latest_per_key(spark):
    stamps = [None, "1969-12-31T23:59:59.999999+00:00", "2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00Z",
              "2024-01-01T00:00:00.000001Z", "0002-01-01T00:00:00Z", "9998-01-01T00:00:00Z"]
    records = [(i % 11, stamps[i * i % 7], None if i % 4 == 0 else (i - 99) ** 9) for i in range(200)]
    records += [(90, None, None), (91, None, 0), (91, None, None), (92, stamps[2], 255), (92, stamps[2], 300)]
    records += [(93, stamps[3], -(1 << 63)), (93, stamps[3], None), (94, stamps[3], (1 << 63) - 1), (94, stamps[3], 5)]
    df = spark.createDataFrame(records, "k int, date string, position bigint")
    wide = ops.latest_per_key(df, ["k"], [instant("date"), "position", "date"])
    take = {"i": instant("date"), "position": F.col("position")}
    narrow = ops.latest_narrow(df, ["k"], instant("date"), "position", take)
    assert rows(narrow, "k", "i", "position") == rows(wide.withColumn("i", instant("date")), "k", "i", "position")
    assert "Sort" not in plan(narrow)


@pytest.mark.parametrize("partitions", [1, 2, 32])
def test_latest_narrow_orders_equal_records_by_written_day(spark, partitions):
    same = ["2023-08-26T23:30:00+00:00", "2023-08-27T00:30:00+01:00", "2023-08-26T22:30:00-01:00"]
    df = spark.createDataFrame([(1, d, 3) for d in same], "k int, date string, position int").repartition(partitions)
    take = {"day": written_day("date"), "position": F.col("position")}
    last = F.date_diff(written_day("date"), F.to_date(instant("date"))) + 1
    got = ops.latest_narrow(df, ["k"], instant("date"), "position", take, last)
    assert rows(got) == [(1, date(2023, 8, 27), 3)] and "Sort" not in plan(got)


def test_dedupe_by_keeps_latest_session(spark):
    df = spark.createDataFrame(
        [(21, 9000, "A"), (21, 9100, "B"), (22, 9000, None)], "driver int, session int, team string"
    )
    assert rows(ops.dedupe_by(df, ["driver"], ["session", "team"]), "driver", "team") == [
        (21, "B"),
        (22, None),
    ]


def test_map_lookup(spark):
    df = spark.createDataFrame([(1,), (99,), (None,)], "p int")
    got = ops.map_lookup(df, "p", {1: 25}, "points")
    assert rows(got) == [(None, None), (1, 25), (99, None)]


def test_daily_mean(spark):
    df = spark.createDataFrame(
        [
            ("2024-01-01T23:59:59+00:00", 1.0, None),
            ("2024-01-01T10:00:00+00:00", 2.0, None),
            ("2024-01-01T11:00:00+00:00", None, None),
            ("2024-01-02T00:00:00+00:00", 5.0, 1.0),
            (None, 7.0, 2.0),
        ],
        "date string, a double, b double",
    )
    assert rows(ops.daily_mean(df, "date", ["a", "b"])) == [
        (None, 7.0, 2.0),
        (date(2024, 1, 1), 1.5, None),
        (date(2024, 1, 2), 5.0, 1.0),
    ]


def test_day_key(spark):
    df = spark.createDataFrame([(date(1970, 1, 1),), (date(2024, 1, 1),), (None,)], "d date")
    assert rows(ops.day_key(df, "d", "k"), "k") == [(None,), (0,), (19723,)]


def test_reshape_drops_derives_renames(spark):
    df = spark.createDataFrame([(1, "2", 3)], "a int, b string, c int")
    got = ops.reshape(df, drop=("c", "nope"), derive={"b": F.col("b").cast("int")}, rename={"a": "id"})
    assert got.columns == ["id", "b"] and rows(got) == [(1, 2)]
    assert ops.reshape(df).columns == df.columns


def test_strip_attributes_ignores_unknown(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ops.strip_attributes(df, ["b", "nope"]).columns == ["a"]


def test_stringify_keeps_null(spark):
    df = spark.createDataFrame([(1.234, "+1 LAP"), (None, None)], "gap double, interval string")
    assert rows(ops.stringify(df, ["gap", "interval"])) == [(None, None), ("1.234", "+1 LAP")]


def test_fill_text_leaves_numbers(spark):
    df = spark.createDataFrame([(None, None), ("SOFT", 1.0)], "compound string, age double")
    assert rows(ops.fill_text(df)) == [("SOFT", 1.0), ("Unknown", None)]


def test_fill_sentinel(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, team_id bigint")
    got = ops.fill_sentinel(df, {"team_id": -1})
    assert rows(got) == [(1, -1), (2, 5)] and got.schema["team_id"].dataType.simpleString() == "int"


def test_dedupe_rows_and_distinct_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (2, "a")], "k int, v string")
    assert rows(ops.dedupe_rows(df)) == [(1, None), (1, "a"), (2, "a")]
    assert rows(ops.distinct_keys(df, "k")) == [(1,), (2,)]


@pytest.mark.parametrize("partitions", ["1", "2", "64"])
def test_surrogate_key_depends_only_on_the_rows(spark, conf, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    # A third of the rows share the first column.
    source = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("hot"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id").cast("string")).alias("name"),
        "id",
    )
    got = ops.surrogate_key(source.unionByName(source).distinct(), ["hot", "name"], "key")
    want = sorted(
        (tuple(r) for r in source.collect()), key=lambda r: (r[0], r[1] is not None, r[1] or "", r[2])
    )
    assert [tuple(r) for r in got.orderBy("key").collect()] == [(i, *r) for i, r in enumerate(want)]


def test_surrogate_key_when_ranges_are_cut_into_pieces(spark, conf):
    conf("spark.sql.files.maxRecordsPerFile", "3")
    got = ops.surrogate_key(spark.range(100), ["id"], "key")
    assert got.where("key <> id").count() == 0 and got.count() == 100


def test_surrogate_key_of_nothing(spark):
    df = spark.createDataFrame([], "a int")
    assert ops.surrogate_key(df, ["a"], "k").columns == ["k", "a"]
    assert ops.surrogate_key(df, ["a"], "k").count() == 0


TEAMS = [(1, "Alpha"), (2, "Beta"), (3, None), (4, None)]
CARS = [(44, "Alpha"), (45, "Nowhere"), (46, None), (47, "Beta"), (48, "Beta")]


def test_lookup_left_keeps_every_row(spark):
    cars = spark.createDataFrame(CARS, "car int, team string")
    teams = spark.createDataFrame(TEAMS, "team_id int, team string")
    got = ops.lookup_left(cars, teams, "team", ["team_id"])
    assert got.columns == ["car", "team", "team_id"]
    assert rows(got, "car", "team_id") == [(44, 1), (45, None), (46, None), (47, 2), (48, 2)]


def test_lookup_left_counts_equal_rows_once_and_refuses_conflicts(spark):
    cars = spark.createDataFrame(CARS, "car int, team string")
    copies = spark.createDataFrame([*TEAMS, (1, "Alpha")], "team_id int, team string")
    assert ops.lookup_left(cars, copies, "team", ["team_id"]).count() == len(CARS)
    conflict = spark.createDataFrame([*TEAMS, (9, "Alpha")], "team_id int, team string")
    with pytest.raises(Exception, match="team_id is not unique for team"):
        ops.lookup_left(cars, conflict, "team", ["team_id"]).collect()
    with pytest.raises(ValueError, match="already present"):
        ops.lookup_left(cars, copies.withColumn("car", F.lit(1)), "team", ["car"])


def test_lookup_left_on_a_date_and_of_null_values(spark):
    day = date(2024, 1, 1)
    facts = spark.createDataFrame([(1, day), (2, date(1969, 1, 2)), (3, None)], "id int, date date")
    days = spark.createDataFrame([(day, 19723), (date(1969, 1, 2), -364), (None, 5), (None, 6)], "date date, weather_id int")
    for unique in (False, True):
        got = ops.lookup_left(facts, days, "date", ["weather_id"], unique=unique)
        assert rows(got, "id", "weather_id") == [(1, 19723), (2, -364), (3, None)]
    half = spark.createDataFrame([(day, 1), (day, None)], "date date, weather_id int")
    with pytest.raises(Exception, match="not unique"):
        ops.lookup_left(facts, half, "date", ["weather_id"]).collect()


def test_lookup_runs_nothing_while_planning(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup-plan", "planning only")
    try:
        ops.lookup_left(spark.range(5), spark.range(5).withColumn("n", F.lit(1)), "id", ["n"])
        assert list(tracker.getJobIdsForGroup("lookup-plan")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_lookup_splits_a_hot_key(spark, conf):
    """Half of the rows share one key; the join reads that key in several tasks."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    facts = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).alias("key"), "id"
    )
    dim = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    got = ops.lookup_left(facts, dim, "key", ["twice"])
    assert got.where(F.col("twice") == F.col("key") * 2).count() == 200_000
    assert got.count() == 200_000
    got.write.format("noop").mode("overwrite").save()
    got.collect()
    assert "skew=true" in plan(got)


def test_union_batches(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, a string")
    b = spark.createDataFrame([(9.5, 1)], "b double, id int")
    empty = spark.createDataFrame([], "id int, a string")
    got = ops.union_batches([a, empty, b, a])
    assert got.columns == ["id", "a", "b"]
    assert rows(got) == [(1, None, 9.5), (1, "x", None), (1, "x", None), (2, "y", None), (2, "y", None)]
    with pytest.raises(ValueError):
        ops.union_batches([])


def test_request_manifest(spark):
    seen = spark.createDataFrame(
        [(9001, 1), (9001, 44), (9002, 44), (9001, 44), (9003, None), (None, 1)], "session_key int, driver_number int"
    )
    base = "https://a.example/v1/car_data"
    both = ops.request_manifest(base, seen, ["session_key", "driver_number"])
    assert rows(both) == [
        (s, d, f"{base}?session_key={s}&driver_number={d}") for s, d in ((9001, 1), (9001, 44), (9002, 44))
    ]
    assert rows(ops.request_manifest(base, seen, ["session_key"])) == [
        (s, f"{base}?session_key={s}") for s in (9001, 9002, 9003)
    ]
    assert rows(ops.request_manifest(base)) == [(base,)]
    many = spark.range(300).select(F.lit(1).alias("session_key"), F.col("id").alias("driver_number"))
    assert ops.request_manifest(base, many, ["session_key", "driver_number"]).count() == 300


DRIVER_ROWS = [(1, "A B", "AB", None, None), (255, None, "CD", "NED", 2)]
DRIVER_DDL = "driver_id int, full_name string, acronym string, country_code string, team_id int"


def test_contract_alignment(spark):
    df = spark.createDataFrame([("X", 7, "AB")], "extra string, driver_id bigint, acronym string")
    got = ops.align_to_contract(df, DRIVERS)
    assert [f.dataType for f in got.schema] == [f.type for f in DRIVERS.fields]
    assert rows(got) == [(7, None, "AB", None, None)]


def test_contract_seconds_are_cut(spark):
    df = spark.createDataFrame(
        [(1, 2.5, datetime(2024, 1, 1, 10, 0, 0, 900000), 1, 2)],
        "lap_number int, pit_duration double, date timestamp_ntz, driver_id int, race_id int",
    )
    got = ops.align_to_contract(df, PIT_STOPS).select(F.col("date").cast("timestamp_ntz"))
    assert got.first()[0] == datetime(2024, 1, 1, 10)


def test_clean_rows_pass(spark):
    df = spark.createDataFrame(DRIVER_ROWS, DRIVER_DDL)
    assert rows(ops.enforce_contract(df, DRIVERS)) == DRIVER_ROWS
    assert rows(ops.guard_contract(df, DRIVERS)) == DRIVER_ROWS
    assert ops.contract_violations(df, DRIVERS).where("breaches > 0").count() == 0


@pytest.mark.parametrize(
    "bad, rule",
    [
        ((1, "X", None, None, None), "acronym null x1"),
        ((256, "X", "X", None, None), "driver_id range x1"),
        ((-1, "X", "X", None, None), "driver_id range x1"),
        ((3, "X", "X", None, 256), "team_id range x1"),
        ((1, "other", "X", None, None), "driver_id key x1"),
    ],
)
def test_breaches_raise(spark, bad, rule):
    first = [r for r in DRIVER_ROWS if not (bad[0] == 1 and "null" in rule and r[0] == 1)]
    df = spark.createDataFrame([*first, bad], DRIVER_DDL)
    with pytest.raises(ops.ContractError, match=rule):
        ops.enforce_contract(df, DRIVERS)
    if "key" not in rule:
        with pytest.raises(Exception, match="bad value"):
            ops.guard_contract(df, DRIVERS).collect()


def test_sixteen_bit_range(spark):
    df = spark.createDataFrame(
        [(1, 25, 1, 65536, None, date(2024, 1, 1)), (21, None, 1, 2, 65535, date(2024, 1, 1))],
        "final_position int, points_earned int, driver_id int, race_id int, weather_id int, date date",
    )
    with pytest.raises(ops.ContractError, match="race_id range x1$"):
        ops.enforce_contract(df, RESULTS)


def test_require_rows_and_unique(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,)], "k int")
    assert ops.require_rows(df, "x") is df
    with pytest.raises(ops.ContractError, match="position: no rows"):
        ops.require_rows(df.where("k > 5"), "position")
    with pytest.raises(ops.ContractError, match="2 rows repeat"):
        ops.check_unique(df, ["k"], "x")
    assert ops.check_unique(df.distinct(), ["k"], "x").count() == 2
    assert ops.check_unique(df.where("k > 5"), ["k"], "x").count() == 0


def test_keys_are_compared_as_stored(spark, tmp_path):
    """Two stops within one second are one key for the check as for the table."""
    stops = [(1, 2.5, datetime(2024, 1, 1, 10, 0, 0, f), 1, 2) for f in (100000, 900000)]
    df = spark.createDataFrame(stops, "lap_number int, pit_duration double, date timestamp, driver_id int, race_id int")
    with pytest.raises(ops.ContractError, match="date key x1$"):
        ops.enforce_contract(df, PIT_STOPS)
    with pytest.raises(ops.ContractError, match="1 rows repeat"):
        write_warehouse(df, PIT_STOPS, str(tmp_path))


def test_keys_too_wide_for_their_column_are_counted(spark):
    """Car numbers beyond 16 bits are breaches of the range, and equal only to themselves."""
    cars = [1, 1, 32768, 65537, 65537, -32769, None, None]
    df = spark.createDataFrame([(c, "X", "X", None, None) for c in cars], DRIVER_DDL.replace("driver_id int", "driver_id long"))
    found = {(r.field, r.rule): r.breaches for r in ops.contract_violations(df, DRIVERS).collect()}
    assert found["driver_id", "range"] == 4 and found["driver_id", "null"] == 2 and found["driver_id", "key"] == 3
    with pytest.raises(ops.ContractError, match="driver_id range x4"):
        ops.enforce_contract(df, DRIVERS)


def test_violations_read_their_table_once(spark, tmp_path):
    spark.createDataFrame(DRIVER_ROWS, DRIVER_DDL).write.parquet(str(tmp_path / "t"))
    text = plan(ops.contract_violations(spark.read.parquet(str(tmp_path / "t")), DRIVERS))
    assert text.count("FileScan parquet") == 1
    nothing = spark.createDataFrame([], DRIVER_DDL)
    assert ops.contract_violations(nothing, DRIVERS).where("breaches <> 0").count() == 0
