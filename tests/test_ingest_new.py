"""Incremental ingest: each file once, bad records aside, stops half-way."""

import importlib
import json
import os

import pytest
from conftest import rows
from pyspark.sql import types as T

from raceway import plans
from raceway.operators import ContractError
from raceway.sources import SourceSpec

SCHEMA = T.StructType().add("car", "long").add("lap", "long").add("gap", "string").add("colour", "string")
module = importlib.import_module("raceway.plans.ingest")
SPEC = SourceSpec("laps", drop=("colour",), stringify=("gap",))


@pytest.fixture
def place(tmp_path):
    class Place:
        landing, root, state = (str(tmp_path / n) for n in ("landing", "raw", "state"))

        def land(self, name, text):
            os.makedirs(f"{self.landing}/laps", exist_ok=True)
            with open(f"{self.landing}/laps/{name}.json", "w") as out:
                out.write(text)

        def table(self, spark):
            return rows(spark.read.parquet(f"{self.root}/laps.parquet"))

        def aside(self, spark):
            return rows(spark.read.parquet(f"{self.root}/quarantine/laps.parquet").select("reason", "record"))

    return Place()


def record(car, lap, gap):
    return {"car": car, "lap": lap, "gap": gap, "colour": "x", "more": 1}


def test_each_file_counts_once(spark, place):
    run = lambda: plans.ingest_new(spark, SPEC, place.landing, place.root, place.state, SCHEMA)
    place.land("a", json.dumps([record(1, 1, 0.5), record(1, 2, "+1 LAP")]))
    place.land("empty", "[]")
    run()
    assert place.table(spark) == [(1, 1, "0.5"), (1, 2, "+1 LAP")]
    place.land("b", json.dumps([record(2, 1, None), record(1, 1, 0.5)]))
    os.remove(f"{place.landing}/laps/a.json")  # a second run has no need of it
    run()
    run()
    assert place.table(spark) == [(1, 1, "0.5"), (1, 1, "0.5"), (1, 2, "+1 LAP"), (2, 1, None)]


def test_bad_records_are_set_aside_with_their_reason(spark, place):
    lines = [json.dumps(record(k, k, "g")) for k in range(3)]
    lines += [json.dumps(record(None, 7, "g")), '{"car": 9, "lap"', json.dumps(record("nine", 9, "g")), "{}"]
    place.land("a", "\n".join(lines))
    run = lambda most: plans.ingest_new(
        spark, SPEC, place.landing, place.root, place.state, SCHEMA, True, ["car", "lap"], most
    )
    run(0.6)
    assert [r[0] for r in place.table(spark)] == [0, 1, 2]
    aside = place.aside(spark)
    assert sorted(r for r, _ in aside) == ["corrupt", "corrupt", "no car", "no car"]
    assert {t for r, t in aside if r == "corrupt"} == set(lines[4:6])
    source = spark.read.parquet(f"{place.root}/quarantine/laps.parquet").select("source_file").distinct().collect()
    assert [r[0].rsplit("/", 1)[1] for r in source] == ["a.json"]
    with pytest.raises(ContractError, match="4 of 7 records"):
        run(0.5)


def test_a_run_that_stopped_between_table_and_quarantine_goes_on(spark, place, monkeypatch):
    place.land("a", "\n".join([json.dumps(record(1, 1, "g")), "broken"]))
    calls = []

    def once(writer):
        if calls:
            raise OSError("stop")
        calls.append(original(writer))

    original = module.run_available
    with monkeypatch.context() as patch:
        patch.setattr(module, "run_available", once)
        with pytest.raises(OSError):
            plans.ingest_new(spark, SPEC, place.landing, place.root, place.state, SCHEMA, True)
    plans.ingest_new(spark, SPEC, place.landing, place.root, place.state, SCHEMA, True)
    assert place.table(spark) == [(1, 1, "g")] and place.aside(spark) == [("corrupt", "broken")]


def test_one_bad_endpoint_stops_no_other(spark, place):
    place.land("a", "broken")
    os.makedirs(f"{place.landing}/turns")
    with open(f"{place.landing}/turns/t.json", "w") as out:
        out.write(json.dumps(record(5, 5, "g")))
    specs, schemas = [SPEC, SourceSpec("turns")], {"laps": SCHEMA, "turns": SCHEMA}
    run = lambda specs: plans.ingest_all_new(
        spark, place.landing, place.root, place.state, specs, schemas, lines=True, most_bad=0.1
    )
    with pytest.raises(ContractError, match="laps: 1 of 1"):
        run(specs)
    assert rows(spark.read.parquet(f"{place.root}/turns.parquet"), "car") == [(5,)]
    with pytest.raises(ValueError, match="no schema"):
        run([SourceSpec("unknown")])
