from raceway.plans.dimensions import (
    append_stints,
    build_daily_weather,
    build_driver_history,
    build_drivers,
    build_races,
    build_stints,
    build_teams,
    build_weather,
)
from raceway.plans.export import export_table, export_tables, export_view
from raceway.plans.facts import POINTS, build_pit_stops, build_results, results_by_team
from raceway.plans.ingest import ingest, ingest_all, ingest_all_new, ingest_new, requests
from raceway.plans.warehouse import build_warehouse, table_rows

__all__ = [
    "POINTS",
    "append_stints",
    "build_daily_weather",
    "build_driver_history",
    "build_drivers",
    "build_pit_stops",
    "build_races",
    "build_results",
    "build_stints",
    "build_teams",
    "build_warehouse",
    "build_weather",
    "export_table",
    "export_tables",
    "export_view",
    "ingest",
    "ingest_all",
    "ingest_all_new",
    "ingest_new",
    "requests",
    "results_by_team",
    "table_rows",
]
