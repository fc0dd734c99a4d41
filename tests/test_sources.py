import json
import os
import uuid
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from conftest import rows
from pyspark.sql import functions as F, types as T

from raceway import sources
from raceway.contracts import DRIVERS, TEAMS, Contract, Field
from raceway.operators import ContractError
from raceway.session import get_session, new_folder, shared_folder
from raceway.sources import key_index


class FakeSession:
    """Stands in for a session, whose core settings cannot change once it runs."""

    def __init__(self, master, _jvm=None, _jsc=None, **conf):
        self._jvm, self._jsc = _jvm, _jsc
        self.conf, self.sparkContext, self.master, self.folder = conf, self, master, None

    def setCheckpointDir(self, folder):
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder


def test_scratch_lies_below_the_named_folder(spark):
    named = FakeSession("local[2]", **{"spark.checkpoint.dir": "hdfs://shared/cp/"})
    assert shared_folder(named) == "hdfs://shared/cp/"
    assert new_folder(named, "x").startswith("hdfs://shared/cp/x-")
    assert new_folder(named, "x") != new_folder(named, "x")


def test_only_a_local_session_makes_its_own_scratch_folder(spark):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("spark://host:7077"))
    for local_path in ("file:/tmp/cp", "/tmp/cp"):
        with pytest.raises(RuntimeError, match="every executor"):
            shared_folder(FakeSession("yarn", _jvm=spark._jvm, _jsc=spark._jsc, **{"spark.checkpoint.dir": local_path}))
    local = FakeSession("local[4]")
    assert os.path.isdir(shared_folder(local)) and shared_folder(local) == local.folder


class FakeCluster(FakeSession):
    """A cluster whose tasks run in ``spark`` and write below ``disk``, if they do not see the driver's folders."""

    defaultParallelism = 2

    def __init__(self, spark, master="spark://host:7077", disk=None, **conf):
        super().__init__(master, _jvm=spark._jvm, _jsc=spark._jsc, **conf)
        self.read, self.applicationId, self.tried = spark.read, uuid.uuid4().hex, 0
        self._spark, self._disk = spark, disk

    def range(self, *args):
        self.tried += 1
        numbers, disk = self._spark.range(*args), self._disk
        if disk is None:
            return numbers
        return SimpleNamespace(write=SimpleNamespace(parquet=lambda path: numbers.write.parquet(disk + "/other")))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_a_cluster_may_share_a_mounted_folder(spark, tmp_path, master, scheme):
    mount = f"{scheme}{tmp_path}"
    cluster = FakeCluster(spark, master, **{"spark.checkpoint.dir": mount})
    assert shared_folder(cluster) == mount and new_folder(cluster, "x").startswith(f"{mount}/x-")
    assert cluster.tried == 1 and os.listdir(tmp_path) == []


def test_a_cluster_refuses_a_folder_of_the_driver_alone(spark, tmp_path):
    own = FakeCluster(spark, disk=str(tmp_path / "disk"), **{"spark.checkpoint.dir": str(tmp_path / "cp")})
    with pytest.raises(RuntimeError, match="every executor"):
        shared_folder(own)
    (tmp_path / "file").write_text("")
    with pytest.raises(RuntimeError, match="every executor"):
        shared_folder(FakeCluster(spark, **{"spark.checkpoint.dir": str(tmp_path / "file")}))


def test_a_cluster_without_a_named_folder_uses_the_warehouse(spark, tmp_path):
    for master in ("spark://host:7077", "local-cluster[2,1,1024]"):
        cluster = FakeCluster(spark, master, **{"spark.sql.warehouse.dir": f"file:{tmp_path}"})
        assert new_folder(cluster, "x").startswith(f"file:{tmp_path}/_scratch/x-") and cluster.folder is None
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(FakeSession(master))


def test_session_is_pinned_to_utc(spark):
    assert get_session() is not None
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_read_source_uses_the_declared_schema_and_drops(spark, tmp_path):
    path = str(tmp_path / "position.parquet")
    spark.createDataFrame(
        [(1, 9, "2024-01-01T00:00:00", 3, "extra")],
        "driver_number bigint, session_key bigint, date string, position int, other string",
    ).write.parquet(path)
    df = sources.read_source(spark, "position", {"position": path}, drop=["date", "nope"])
    assert df.columns == ["driver_number", "session_key", "position"]


def test_json_arrays_lines_and_empty_batches(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([{"a": 1, "gap": "+1 LAP"}, {"a": 2}]))
    (tmp_path / "2.json").write_text("[]")
    (tmp_path / "3.json").write_text(json.dumps([{"a": 1, "gap": 1.234}, {"b": "x", "a": 1}]))
    df = sources.read_json_batches(spark, str(tmp_path))
    assert rows(df, "a", "b", "gap") == [
        (1, None, "+1 LAP"), (1, None, "1.234"), (1, "x", None), (2, None, None),
    ]
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "1.json").write_text('{"a": 1}\n{"a": 2}\n')
    typed = sources.read_json_batches(spark, str(lines), df.select("a").schema, lines=True)
    assert rows(typed) == [(1,), (2,)]


def test_broken_json_raises(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"a": 1}, {"a": ')
    schema = spark.range(1).select(F.col("id").alias("a")).schema
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILFAST|FAILED_READ"):
        sources.read_json_batches(spark, str(tmp_path), schema).collect()


def test_catalogue():
    specs = {s.name: s for s in sources.load_specs()}
    assert len(specs) == 11
    assert specs["car_data"].key_by == ("session_key", "driver_number")
    assert specs["intervals"].stringify == ("gap_to_leader", "interval")
    assert "headshot_url" in specs["drivers"].drop
    given = sources.load_specs('[{"name": "laps", "drop": ["x"], "key_by": ["session_key"]}]')
    assert given == (sources.SourceSpec("laps", drop=("x",), key_by=("session_key",)),)


def test_api_descriptions():
    limits = {"start": 1, "end": 500}
    url = "https://a.example/v1/"
    text = json.dumps(
        [
            {"base_url": url + "car_data?x=1", "attributes_to_remove": ["brake"],
             "session_keys_range": limits, "driver_numbers_range": limits},
            {"base_url": url + "intervals", "attributes_to_remove": [], "session_keys_range": limits},
        ]
    )
    assert sources.load_specs(text) == (
        sources.SourceSpec("car_data", ("brake",), (), ("session_key", "driver_number"), url + "car_data?x=1"),
        sources.SourceSpec("intervals", (), ("gap_to_leader", "interval"), ("session_key",), url + "intervals"),
    )


@pytest.mark.parametrize(
    "text",
    ["[]", "{}", '[{"drop": []}]', '[{"name": ""}]', '[{"name": "x", "drop": "abc"}]',
     '[{"base_url": 1, "attributes_to_remove": []}]', '[{"base_url": "u/x", "attributes_to_remove": "a"}]',
     '[{"base_url": "u/x", "attributes_to_remove": [], "session_keys_range": {"start": 1}}]', "[1]",
     '[{"name": "x", "key_by": ["year"]}]', '[{"name": "x", "other": 1}]', '[{"name": "x", "drop": [1]}]'],
)
def test_bad_catalogues_are_refused(text):
    with pytest.raises(ValueError):
        sources.load_specs(text)


def test_write_raw_is_snappy_and_replaces(spark, tmp_path):
    for n in (3, 2):
        path = sources.write_raw(spark.range(n), str(tmp_path), "laps")
    assert path == f"{tmp_path}/laps.parquet" and spark.read.parquet(path).count() == 2
    assert any(f.endswith(".snappy.parquet") for f in os.listdir(path))


def test_csv_brings_every_value_back(spark, tmp_path):
    df = spark.createDataFrame(
        [
            (1, 'say "hi", ok', datetime(2024, 1, 1, 1, 2, 3, 456), date(2024, 1, 1), 1.5),
            (2, "two\nlines\r\nand \\ more", None, None, None),
            (3, "", None, None, 0.1),
            (4, None, datetime(2024, 1, 1), None, 1e-9),
            (5, "  São Paulo ", None, None, 1e300),
        ],
        "id int, name string, at timestamp_ntz, day date, x double",
    )
    path = sources.export_csv(df, str(tmp_path / "t.csv"))
    assert rows(sources.read_csv(spark, path, df.schema)) == rows(df)
    part = next(f for f in os.listdir(path) if f.startswith("part-"))
    assert open(f"{path}/{part}").readline() == "id,name,at,day,x\n"


TEAM_ROWS = [(i, f"Team {i}", None, f"T{i}") for i in range(1, 31)]
TEAM_DDL = "team_id int, name string, country_code string, acronym string"


def test_warehouse_write_is_checked_sorted_and_repeatable(spark, conf, tmp_path):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    root = str(tmp_path)
    df = spark.createDataFrame(TEAM_ROWS, TEAM_DDL)
    for _ in range(2):
        path = sources.write_warehouse(df.repartition(3, "name"), TEAMS, root)
    back = sources.read_warehouse(spark, TEAMS, root)
    assert rows(back) == TEAM_ROWS and [f.dataType for f in back.schema] == [f.type for f in TEAMS.fields]
    ranges = []
    for f in sorted(os.listdir(path)):
        if f.startswith("part-"):
            ids = [r[0] for r in spark.read.parquet(f"{path}/{f}").select("team_id").collect()]
            assert ids == sorted(ids)
            ranges += ids
    assert ranges == sorted(ranges)


def test_refused_rows_never_reach_the_table(spark, tmp_path):
    root = str(tmp_path)
    good = spark.createDataFrame(TEAM_ROWS, TEAM_DDL)
    sources.write_warehouse(good, TEAMS, root)
    with pytest.raises(Exception, match="bad value 300"):
        sources.write_warehouse(good.unionByName(good.select(F.lit(300).alias("team_id"), "name", "country_code", "acronym")), TEAMS, root)
    with pytest.raises(ContractError, match="30 rows repeat a key"):
        sources.write_warehouse(good.unionByName(good), TEAMS, root)
    assert sources.read_warehouse(spark, TEAMS, root).count() == 30


def test_append_checks_keys_against_the_table(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame(TEAM_ROWS, TEAM_DDL)
    sources.write_warehouse(df.where("team_id <= 10"), TEAMS, root, mode="append")
    sources.write_warehouse(df.where("team_id > 10"), TEAMS, root, mode="append")
    assert sources.read_warehouse(spark, TEAMS, root).count() == 30
    for again in ("team_id = 5", "team_id IN (10, 11)"):
        with pytest.raises(ContractError, match="repeat a key"):
            sources.write_warehouse(df.where(again), TEAMS, root, mode="append")
    assert sources.read_warehouse(spark, TEAMS, root).count() == 30


STOPS = Contract(
    "Stops", ("driver", "race"),
    (Field("driver", T.LongType()), Field("race", T.LongType()), Field("laps", T.LongType(), nullable=True)),
)


def stops(spark, races, drivers=range(400)):
    some = spark.createDataFrame([(r,) for r in races], "race long")
    return spark.createDataFrame([(d,) for d in drivers], "driver long").crossJoin(some).withColumn("laps", F.lit(1).cast("long"))


def test_an_append_reads_only_files_that_may_hold_its_keys(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/Stops"
    for races in ([1, 3, 5], [2, 4], [6, 7]):  # every load has all drivers, and the first two overlap in races
        sources.write_warehouse(stops(spark, races), STOPS, root, mode="append")
    files = key_index.table_files(spark, path)
    assert len(files) >= 3
    look = lambda df: key_index.files_with_keys(spark, path, df.select("driver", "race"))
    assert look(stops(spark, [8])) == []
    # Not in the bounds of the third load, in the bounds of the others, and in no file.
    assert look(stops(spark, [3], range(400, 500))) == []
    hit = look(stops(spark, [4], [17]))
    assert len(hit) == 1
    assert spark.read.parquet(f"{path}/{hit[0]}").where("driver = 17 AND race = 4").count() == 1
    assert key_index.update_index(spark, path, stops(spark, [1]).select("driver", "race")) == []


def test_a_filter_loses_no_key(spark, tmp_path):
    root, path = str(tmp_path), f"{tmp_path}/Stops"
    keys = stops(spark, range(25)).where("hash(driver, race) % 3 = 0")
    sources.write_warehouse(keys, STOPS, root)
    for n in key_index.table_files(spark, path):
        for some in spark.read.parquet(f"{path}/{n}").select("driver", "race").randomSplit([1.0] * 4, 7):
            assert n in key_index.files_with_keys(spark, path, some)
    absent = stops(spark, range(25)).where("hash(driver, race) % 3 <> 0").select("driver", "race")
    sources.write_warehouse(absent.withColumn("laps", F.lit(2).cast("long")), STOPS, root, mode="append")
    assert sources.read_warehouse(spark, STOPS, root).count() == 10_000


def test_an_index_follows_its_table(spark, tmp_path, monkeypatch):
    root, path = str(tmp_path), f"{tmp_path}/Stops"
    sources.write_warehouse(stops(spark, [1]), STOPS, root, mode="append")
    with monkeypatch.context() as stop:  # a stop before the batch appears leaves the files undescribed
        stop.setattr(key_index, "move_folder", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            sources.write_warehouse(stops(spark, [2]), STOPS, root, mode="append")
    with pytest.raises(ContractError, match="400 rows repeat a key"):
        sources.write_warehouse(stops(spark, [1]), STOPS, root, mode="append")
    sources.write_warehouse(stops(spark, [3]), STOPS, root)  # a new version has other files
    sources.write_warehouse(stops(spark, [1]), STOPS, root, mode="append")
    sources.write_warehouse(stops(spark, []), STOPS, root, mode="append")
    with pytest.raises(ContractError, match="1 rows repeat a key"):
        sources.write_warehouse(stops(spark, [3], [399, 400]), STOPS, root, mode="append")
    assert sources.read_warehouse(spark, STOPS, root).count() == 800


def test_a_write_leaves_one_copy(spark, tmp_path):
    df = spark.createDataFrame(TEAM_ROWS, TEAM_DDL)
    scratch = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    for _ in range(2):
        sources.write_warehouse(df, TEAMS, str(tmp_path / "dw"))
    assert os.listdir(tmp_path / "dw") == ["TeamsDT"] and set(os.listdir(scratch)) == before


def test_missing_nullable_column_is_null(spark, tmp_path):
    df = spark.createDataFrame([(1, "AB")], "driver_id int, acronym string")
    sources.write_warehouse(df, DRIVERS, str(tmp_path))
    assert rows(sources.read_warehouse(spark, DRIVERS, str(tmp_path))) == [(1, None, "AB", None, None)]
