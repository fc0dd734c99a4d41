"""Run one step: ``python -m raceway ingest|requests|build|export``, also under spark-submit."""

from __future__ import annotations

import argparse
from pathlib import Path

from raceway import plans
from raceway.contracts import WAREHOUSE, WIDE_WAREHOUSE
from raceway.plans.warehouse import TABLES
from raceway.session import get_session
from raceway.sources import load_specs, read_source

RAW_SOURCES = sorted({name for names, *_ in TABLES.values() for name in names})


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="raceway")
    parser.add_argument("--master", help="only when spark-submit does not set it")
    steps = parser.add_subparsers(dest="step", required=True)

    def source_step(name: str, text: str) -> argparse.ArgumentParser:
        step = steps.add_parser(name, help=text)
        step.add_argument("--specs", type=Path, help="JSON list of sources; built-in catalogue by default")
        step.add_argument("--only", nargs="*", help="names of sources; all by default")
        return step

    step = source_step("ingest", "landed JSON to raw Parquet")
    step.add_argument("landing")
    step.add_argument("raw")
    step.add_argument("--lines", action="store_true", help="one record per line instead of arrays")

    step = source_step("requests", "list the requests of each source as Parquet")
    step.add_argument("raw")
    step.add_argument("out")
    step.add_argument("--base-url", help="what precedes the names of sources without an address")

    step = steps.add_parser("build", help="raw Parquet to checked tables")
    step.add_argument("raw")
    step.add_argument("warehouse")
    step.add_argument("--teams", help="path of the teams file, raw/teams.parquet by default")
    step.add_argument("--only", nargs="*", choices=list(TABLES), help="tables; all by default")
    step.add_argument("--wide", action="store_true", help="64-bit columns without ranges")

    step = steps.add_parser("export", help="tables to CSV")
    step.add_argument("warehouse")
    step.add_argument("out")
    step.add_argument("--wide", action="store_true", help="tables that were built wide")
    step.add_argument("--only", nargs="*", choices=list(TABLES), help="tables; all by default")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> dict[str, str]:
    """Do one step and return what it wrote, by name."""
    given = parse(arguments)
    spark = get_session(master=given.master)
    if given.step in ("build", "export"):
        contracts = WIDE_WAREHOUSE if given.wide else WAREHOUSE
    if given.step == "build":
        paths = {name: f"{given.raw}/{name}.parquet" for name in RAW_SOURCES}
        paths["teams"] = given.teams or paths["teams"]
        return plans.build_warehouse(spark, paths, given.warehouse, contracts, given.only or tuple(TABLES))
    if given.step == "export":
        return plans.export_tables(
            spark, given.warehouse, given.out, given.only or tuple(WAREHOUSE), contracts
        )

    specs = load_specs(given.specs.read_text() if given.specs else None)
    specs = [s for s in specs if not given.only or s.name in given.only]
    if given.step == "ingest":
        return plans.ingest_all(spark, given.landing, given.raw, specs, lines=given.lines)
    paths = {name: f"{given.raw}/{name}.parquet" for name in ("sessions", "drivers")}
    sessions, drivers = (read_source(spark, name, paths) for name in ("sessions", "drivers"))
    written = {s.name: f"{given.out}/{s.name}" for s in specs}
    for spec in specs:
        plans.requests(spec, sessions, drivers, given.base_url).write.mode("overwrite").parquet(written[spec.name])
    return written


if __name__ == "__main__":
    for name, path in main().items():
        print(name, path)
