"""Declared schemas: the raw inputs and the eight warehouse tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

UINT8 = (0, 255)
UINT16 = (0, 65_535)


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    nullable: bool = False
    limits: tuple[int, int] | None = None


@dataclass(frozen=True)
class Contract:
    """Columns in table order, and the key that is both unique and the storage order."""

    table: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, f.nullable) for f in self.fields])

    def widened(self) -> Contract:
        """The same table for data that outgrows 8- and 16-bit numbers: 64 bits, no range."""
        fields = (replace(f, type=T.LongType(), limits=None) if f.limits else f for f in self.fields)
        return replace(self, fields=tuple(fields))


def u8(name: str, nullable: bool = False) -> Field:
    return Field(name, T.ShortType(), nullable, UINT8)


def u16(name: str, nullable: bool = False) -> Field:
    return Field(name, T.IntegerType(), nullable, UINT16)


def f32(name: str) -> Field:
    return Field(name, T.FloatType())


def text(name: str, nullable: bool = False) -> Field:
    return Field(name, T.StringType(), nullable)


def day(name: str) -> Field:
    return Field(name, T.DateType())


def second(name: str) -> Field:
    """An instant kept to the whole second."""
    return Field(name, T.TimestampType())


MEASURES = (
    "humidity",
    "pressure",
    "rainfall",
    "air_temperature",
    "track_temperature",
    "wind_speed",
    "wind_direction",
)

RESULTS = Contract(
    "ResultsFactsFT",
    ("driver_id", "race_id", "date"),
    (
        u8("final_position"),
        # A position outside the points table earns NULL, so such rows stay visible.
        u8("points_earned", nullable=True),
        u8("driver_id"),
        u16("race_id"),
        u16("weather_id", nullable=True),
        day("date"),
    ),
)
PIT_STOPS = Contract(
    "PitStopsFT",
    ("driver_id", "race_id", "date"),
    (u8("lap_number"), f32("pit_duration"), second("date"), u8("driver_id"), u16("race_id")),
)
DRIVERS = Contract(
    "DriversDT",
    ("driver_id",),
    (
        u8("driver_id"),
        text("full_name", nullable=True),
        text("acronym"),
        text("country_code", nullable=True),
        u8("team_id", nullable=True),
    ),
)
TEAMS = Contract(
    "TeamsDT",
    ("team_id",),
    (u8("team_id"), text("name", nullable=True), text("country_code", nullable=True), text("acronym")),
)
RACES = Contract(
    "RacesDT",
    ("race_id",),
    (
        u16("race_id"),
        text("race_name"),
        text("circuit_name"),
        text("location", nullable=True),
        text("type"),
        text("country_name", nullable=True),
        u8("total_laps", nullable=True),
        second("timestamp_start"),
        second("timestamp_end"),
    ),
)
WEATHER = Contract(
    "WeatherDT",
    ("weather_id", "timestamp"),
    (u16("weather_id"), *map(f32, MEASURES), second("timestamp")),
)
DAILY_WEATHER = Contract(
    "DailyWeatherDT",
    ("weather_id", "date"),
    (u16("weather_id"), *map(f32, MEASURES), day("date")),
)
STINTS = Contract(
    "StintsDT",
    ("stint_id",),
    (
        u16("stint_id"),
        u8("stint_number"),
        text("compound"),
        f32("tyre_age_at_start"),
        u16("lap_start"),
        u16("lap_end"),
        u16("race_id"),
        u8("driver_id"),
    ),
)

WAREHOUSE = {
    c.table: c
    for c in (RESULTS, PIT_STOPS, DRIVERS, TEAMS, RACES, WEATHER, DAILY_WEATHER, STINTS)
}
WIDE_WAREHOUSE = {table: contract.widened() for table, contract in WAREHOUSE.items()}


def _raw(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


# Raw inputs by name. Times arrive as ISO-8601 text.
RAW = {
    "position": _raw(driver_number=LONG, session_key=LONG, date=TEXT, position=LONG),
    "drivers": _raw(
        driver_number=LONG, session_key=LONG, meeting_key=LONG, full_name=TEXT,
        name_acronym=TEXT, team_name=TEXT, country_code=TEXT,
    ),
    "teams": _raw(team_id=INT, name=TEXT, country_code=TEXT, acronym=TEXT),
    "sessions": _raw(
        session_key=LONG, session_name=TEXT, session_type=TEXT,
        circuit_short_name=TEXT, location=TEXT, country_name=TEXT,
        date_start=TEXT, date_end=TEXT, circuit_key=LONG, country_key=LONG,
        country_code=TEXT, meeting_key=LONG, gmt_offset=TEXT, year=INT,
    ),
    "pit": _raw(
        driver_number=LONG, session_key=LONG, meeting_key=LONG, lap_number=LONG,
        pit_duration=DOUBLE, date=TEXT,
    ),
    "stints": _raw(
        driver_number=LONG, session_key=LONG, meeting_key=LONG, stint_number=LONG,
        lap_start=LONG, lap_end=LONG, compound=TEXT, tyre_age_at_start=DOUBLE,
    ),
    "weather": _raw(
        session_key=LONG, meeting_key=LONG, date=TEXT,
        **{measure: DOUBLE for measure in MEASURES},
    ),
}
