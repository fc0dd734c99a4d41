"""The six dimensions, each a function from raw inputs to table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from raceway.contracts import MEASURES
from raceway.functions import instant
from raceway.operators import (
    daily_mean,
    day_key,
    dedupe_by,
    dedupe_rows,
    fill_text,
    intervals,
    lookup_left,
    reshape,
    surrogate_key,
    surrogate_key_append,
)

# Session attributes that the dimension leaves out.
SESSION_EXTRAS = ("circuit_key", "country_key", "country_code", "meeting_key", "gmt_offset", "year")


def build_teams(teams: DataFrame) -> DataFrame:
    return dedupe_rows(teams)


def build_drivers(drivers: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per car number, from its latest session, with the id of that session's team.

    Choosing the row first leaves one record per driver to join and nothing to deduplicate.
    """
    newest = ("session_key", "meeting_key", "team_name", "full_name", "name_acronym", "country_code")
    current = reshape(
        dedupe_by(drivers, ["driver_number"], newest),
        drop=("session_key", "meeting_key"),
        rename={"driver_number": "driver_id", "name_acronym": "acronym"},
    )
    named = teams.select("team_id", teams["name"].alias("team_name"))
    return lookup_left(current, named, "team_name", ["team_id"]).drop("team_name")


def build_driver_history(drivers: DataFrame, teams: DataFrame) -> DataFrame:
    """Stints of each car number with one team: the session it begins in and the one that ends it, or NULL."""
    seen = drivers.select(drivers["driver_number"].alias("driver_id"), "session_key", "team_name")
    named = teams.select("team_id", teams["name"].alias("team_name"))
    return intervals(lookup_left(seen, named, "team_name", ["team_id"]), ["driver_id"], "session_key", ["team_id"])


def build_races(sessions: DataFrame) -> DataFrame:
    races = reshape(
        sessions,
        drop=SESSION_EXTRAS,
        derive={"date_start": instant("date_start"), "date_end": instant("date_end")},
        rename={
            "session_key": "race_id",
            "session_name": "race_name",
            "session_type": "type",
            "circuit_short_name": "circuit_name",
            "date_start": "timestamp_start",
            "date_end": "timestamp_end",
        },
    )
    return dedupe_rows(races)


STINT_ORDER = ("race_id", "driver_id", "stint_number")


def _stints(stints: DataFrame) -> DataFrame:
    names = {"driver_number": "driver_id", "session_key": "race_id"}
    return dedupe_rows(fill_text(reshape(stints, drop=("meeting_key",), rename=names)))


def build_stints(stints: DataFrame, staging: str | None = None) -> DataFrame:
    """Distinct stints, numbered in the order of race, driver and stint."""
    return surrogate_key(_stints(stints), STINT_ORDER, "stint_id", staging)


def append_stints(stints: DataFrame, registry: str, load: int) -> DataFrame:
    """All stints of this load and those before; a stint keeps the number that it first got."""
    return surrogate_key_append(_stints(stints), STINT_ORDER, "stint_id", registry, load)


def build_weather(weather: DataFrame, staging: str | None = None) -> DataFrame:
    """Distinct weather samples, numbered in the order of time."""
    rows = reshape(
        weather,
        drop=("session_key", "meeting_key"),
        derive={"date": instant("date")},
        rename={"date": "timestamp"},
    )
    return surrogate_key(dedupe_rows(rows), ["timestamp"], "weather_id", staging)


def build_daily_weather(weather: DataFrame) -> DataFrame:
    """Means per day; grouping leaves one row per day, so nothing is left to deduplicate."""
    return day_key(daily_mean(weather, "date", MEASURES), "date", "weather_id")
