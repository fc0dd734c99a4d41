"""Every operator and table over the given Parquet tables, as ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from raceway import operators as ops
from raceway import plans, sources, streaming
from raceway.contracts import MEASURES, PIT_STOPS, STINTS, WIDE_WAREHOUSE, Contract, Field, text
from raceway.functions import endpoint_name, instant, written_day
from raceway.registry import race_views as views
from raceway.registry.race_views import iso_text, table
from raceway.session import brief_shuffles, new_folder, remove_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Rows of the live feed arrive within two days. A replay meets its files in one micro-batch, before
# the watermark moves, so no row of the history is late.
LATENESS = "2 days"

ORDERS = Contract(
    "Orders",
    ("order_id",),
    (
        Field("order_id", T.LongType()),
        text("status"),
        Field("price", T.FloatType()),
        Field("laps", T.ShortType(), nullable=True),
        Field("ordered", T.TimestampType()),
    ),
)


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Text times carry their offset; all results are compared as UTC wall time.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _without_zone(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def _without_zone(df: DataFrame) -> DataFrame:
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def _rounded(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# Facts and dimensions


@query
def results_fact(spark, sf_dir):
    days = plans.build_daily_weather(views.weather(spark, sf_dir))
    return plans.build_results(views.positions(spark, sf_dir), days)


@query
def pit_stops_fact(spark, sf_dir):
    return plans.build_pit_stops(views.pit(spark, sf_dir))


@query
def teams_dim(spark, sf_dir):
    return plans.build_teams(views.teams(spark, sf_dir))


@query
def drivers_dim(spark, sf_dir):
    return plans.build_drivers(views.drivers(spark, sf_dir), views.teams(spark, sf_dir))


@query
def races_dim(spark, sf_dir):
    return plans.build_races(views.sessions(spark, sf_dir))


@query
def stints_dim(spark, sf_dir):
    return plans.build_stints(views.stints(spark, sf_dir))


@query
def drivers_history(spark, sf_dir):
    return plans.build_driver_history(views.drivers(spark, sf_dir), views.teams(spark, sf_dir))


@query
def results_by_team_then(spark, sf_dir):
    results = plans.build_results(
        views.race_positions(spark, sf_dir), plans.build_daily_weather(views.weather(spark, sf_dir))
    )
    history = plans.build_driver_history(views.drivers(spark, sf_dir), views.teams(spark, sf_dir))
    return plans.results_by_team(results, history)


@query
def weather_dim(spark, sf_dir):
    return plans.build_weather(views.weather(spark, sf_dir))


@query
def daily_weather_dim(spark, sf_dir):
    return _rounded(plans.build_daily_weather(views.weather(spark, sf_dir)), MEASURES)


@query
def stored_results(spark, sf_dir):
    """Raw Parquet to the stored daily weather, to the stored results, each checked on its way."""
    root = new_folder(spark, "stored")
    samples = views.weather(spark, sf_dir).fillna(0.0, ["rainfall"])
    days = plans.build_daily_weather(samples)
    sources.write_warehouse(days, WIDE_WAREHOUSE["DailyWeatherDT"], root)
    paths = {"position": sources.write_raw(views.positions(spark, sf_dir), root, "position")}
    results = plans.table_rows(spark, "ResultsFactsFT", paths, root, WIDE_WAREHOUSE)
    sources.write_warehouse(results, WIDE_WAREHOUSE["ResultsFactsFT"], root)
    return sources.read_warehouse(spark, WIDE_WAREHOUSE["ResultsFactsFT"], root)


# Operators


@query
def latest_narrow(spark, sf_dir):
    take = {"day": written_day("date"), "position": F.col("position")}
    keys = ["driver_number", "session_key"]
    after = F.date_diff(written_day("date"), F.to_date(instant("date"))) + 1
    return ops.latest_narrow(views.positions(spark, sf_dir), keys, instant("date"), "position", take, after)


@query
def latest_per_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    return ops.latest_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query
def map_lookup(spark, sf_dir):
    placed = table(spark, sf_dir, "events").select(
        "event_id", F.floor("value").cast("int").alias("position")
    )
    return ops.map_lookup(placed, "position", plans.POINTS, "points")


@query
def daily_mean(spark, sf_dir):
    return _rounded(ops.daily_mean(table(spark, sf_dir, "events"), "ts", ["value"]), ["value"])


@query
def team_lookup(spark, sf_dir):
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", views.numbered("Supplier", F.col("c_custkey")).alias("team_name")
    )
    teams = views.teams(spark, sf_dir).withColumnRenamed("name", "team_name")
    return ops.lookup_left(named, teams, "team_name", ["team_id", "country_code"])


@query
def sentinel_fill(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labelled = ops.lookup_left(documents, table(spark, sf_dir, "labels"), "doc_id", ["quality", "toxic"])
    return ops.fill_sentinel(labelled, {"quality": -1, "toxic": -1})


@query
def text_fill(spark, sf_dir):
    return ops.fill_text(views.stints(spark, sf_dir))


@query
def reshape_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", iso_text("o_orderdate"))
    return ops.reshape(
        orders,
        drop=("o_totalprice", "no_such_column"),
        derive={"o_orderdate": instant("o_orderdate")},
        rename={"o_orderkey": "race_id", "o_custkey": "driver_id", "o_orderdate": "timestamp_start"},
    )


@query
def parse_timestamp(spark, sf_dir):
    kind = F.col("event_type")
    offset = F.when(kind == "click", "+02:00").when(kind == "view", "-03:30").otherwise("Z")
    written = F.concat(F.date_format("ts", views.ISO), offset)
    return table(spark, sf_dir, "events").select(
        "event_id",
        instant(written).alias("moment"),
        instant(F.when(kind == "error", F.col("props")).otherwise(written), strict=False).alias("moment_or_null"),
    )


@query
def distinct_rows(spark, sf_dir):
    return ops.dedupe_rows(table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey"))


@query
def dedupe_by_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return ops.dedupe_by(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def distinct_keys(spark, sf_dir):
    return ops.distinct_keys(table(spark, sf_dir, "lineitem"), "l_partkey")


def _cars_of_sessions(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("session_key"), F.col("l_quantity").cast("bigint").alias("driver_number")
    )


@query
def request_manifest(spark, sf_dir):
    seen = _cars_of_sessions(spark, sf_dir)
    return ops.request_manifest("https://example.org/v1/car_data", seen, ["session_key", "driver_number"])


@query
def request_manifest_one_key(spark, sf_dir):
    return ops.request_manifest("https://example.org/v1/laps", _cars_of_sessions(spark, sf_dir), ["session_key"])


@query
def union_batches(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")
    )
    empty = spark.createDataFrame([], customers.schema)
    return ops.union_batches([customers, empty, suppliers, suppliers])


@query
def endpoint_names(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", endpoint_name("url").alias("name"))


@query
def stringify_mixed(spark, sf_dir):
    gap = F.when(F.col("event_type") != "error", F.col("value"))
    mixed = table(spark, sf_dir, "events").select("event_id", gap.alias("gap"), "user_id", "event_type")
    return ops.stringify(mixed, ["gap", "user_id"])


@query
def strip_attributes(spark, sf_dir):
    return ops.strip_attributes(table(spark, sf_dir, "documents"), ["text", "n_chars", "no_such_column"])


@query
def surrogate_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", "l_suppkey", "l_partkey")
    return ops.surrogate_key(ops.dedupe_rows(lines), ["l_suppkey", "l_shipdate"], "sk")


@query
def surrogate_key_append(spark, sf_dir):
    """Stints of odd sessions, then of all, then the second load again."""
    registry, rows = new_folder(spark, "registry"), views.stints(spark, sf_dir)
    plans.append_stints(rows.filter("session_key % 2 = 1"), registry, 1)
    plans.append_stints(rows, registry, 2)
    return plans.append_stints(rows, registry, 2)


@query
def day_key(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return ops.day_key(days, "day", "day_key")


def _orders_for_contract(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderdate").alias("ordered"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("not_in_contract"),
    )


@query
def align_contract(spark, sf_dir):
    return ops.align_to_contract(_orders_for_contract(spark, sf_dir), ORDERS)


@query
def contract_violations(spark, sf_dir):
    """The stops of a session end within one second of its day, so most of their keys are equal once stored."""
    names = {"driver_number": "driver_id", "session_key": "race_id"}
    end = F.timestamp_micros(F.unix_micros(instant("date")) + F.col("lap_number") * 1000)
    tables = (
        (ops.reshape(views.pit(spark, sf_dir), derive={"date": end}, rename=names), PIT_STOPS),
        (ops.reshape(views.stints(spark, sf_dir), rename=names), STINTS),
    )
    found = [
        ops.contract_violations(df, contract).withColumn("table_name", F.lit(contract.table))
        for df, contract in tables
    ]
    return ops.union_batches(found)


# Sources and sinks


@query
def parquet_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    path = sources.write_raw(events, new_folder(spark, "raw"), "events")
    return sources.read_source(spark, "events", {"events": path}, drop=["props"])


@query
def csv_roundtrip(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    path = sources.export_csv(documents, new_folder(spark, "csv"))
    return sources.read_csv(spark, path, documents.schema)


@query
def json_batches(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    landing = new_folder(spark, "landing")
    events.write.option("timestampNTZFormat", views.ISO).json(landing)
    return sources.read_json_batches(spark, landing, events.schema, lines=True)


@query
def warehouse_roundtrip(spark, sf_dir):
    root = new_folder(spark, "warehouse")
    sources.write_warehouse(_orders_for_contract(spark, sf_dir), ORDERS, root)
    return sources.read_warehouse(spark, ORDERS, root)


@query
def warehouse_append(spark, sf_dir):
    """Orders of even and of odd number, the second part appended to the first."""
    root, orders = new_folder(spark, "warehouse"), _orders_for_contract(spark, sf_dir)
    sources.write_warehouse(orders.filter("order_id % 2 = 0"), ORDERS, root)
    sources.write_warehouse(orders.filter("order_id % 2 = 1"), ORDERS, root, mode="append")
    return sources.read_warehouse(spark, ORDERS, root)


@query
def warehouse_append_fact(spark, sf_dir):
    """Pit stops in three loads of whole races, keys led by the driver; a repeat of the last load is refused."""
    root, contract = new_folder(spark, "warehouse"), WIDE_WAREHOUSE["PitStopsFT"]
    stops = plans.build_pit_stops(_single_stops(views.pit(spark, sf_dir)))
    for load in range(3):
        sources.write_warehouse(stops.filter(F.col("race_id") % 3 == load), contract, root, mode="append")
    refused = False
    try:
        sources.write_warehouse(stops.filter("race_id % 3 = 2"), contract, root, mode="append")
    except ops.ContractError:
        refused = True
    return sources.read_warehouse(spark, contract, root).withColumn("repeat_refused", F.lit(refused))


def _single_stops(landed):
    """One stop per car, session and second."""
    return landed.groupBy("driver_number", "session_key", "date").agg(
        F.min("meeting_key").alias("meeting_key"), F.min("lap_number").alias("lap_number"),
        F.min("pit_duration").alias("pit_duration"),
    )


# API descriptions of the six endpoints whose columns are declared.
CHAIN_SPECS = """[
    {"base_url": "https://example.org/v1/position?", "attributes_to_remove": [],
     "driver_numbers_range": {"start": 1, "end": 500}},
    {"base_url": "https://example.org/v1/drivers", "attributes_to_remove": ["headshot_url"]},
    {"base_url": "https://example.org/v1/sessions", "attributes_to_remove": []},
    {"base_url": "https://example.org/v1/pit", "attributes_to_remove": []},
    {"base_url": "https://example.org/v1/stints", "attributes_to_remove": []},
    {"base_url": "https://example.org/v1/weather", "attributes_to_remove": []}
]"""


@query
def warehouse_chain(spark, sf_dir):
    """Landed JSON to raw tables, to all eight stored tables, to CSV.

    All rows of both exported facts; rows and sum of an id of each exported dimension. Landed records repeat
    every name, so they lie compressed, as the export does; what all readers are done with is removed.
    """
    landing, raw, root, out = (new_folder(spark, n) for n in ("landing", "raw", "warehouse", "csv"))
    specs = sources.load_specs(CHAIN_SPECS)
    with brief_shuffles(spark):
        for spec in specs:
            landed = views.VIEWS[spec.name](spark, sf_dir)
            if spec.name == "weather":
                # Whole numbers come without a decimal point, and a contract wants every measure.
                landed = landed.withColumn("rainfall", F.coalesce("rainfall", F.lit(0)).cast("bigint"))
            if spec.name == "stints":
                landed = landed.withColumn("tyre_age_at_start", F.coalesce("tyre_age_at_start", F.lit(0)))
            if spec.name == "drivers":
                landed = landed.withColumn("headshot_url", F.lit("https://example.org/face.png"))
            if spec.name == "pit":
                landed = _single_stops(landed)
            if spec.name == "sessions":
                landed = landed.withColumn("session_name", F.coalesce("session_name", F.lit("")))
            # Compressed files are not split, so they are kept small.
            landed.write.option("maxRecordsPerFile", 1_000_000).json(f"{landing}/{spec.name}", compression="gzip")
        paths = plans.ingest_all(spark, landing, raw, specs, lines=True)
        remove_folder(spark, landing)
        paths["teams"] = sources.write_raw(views.teams(spark, sf_dir), raw, "teams")
        plans.build_warehouse(spark, paths, root, WIDE_WAREHOUSE)
        remove_folder(spark, raw)
        exported = plans.export_tables(spark, root, out, contracts=WIDE_WAREHOUSE, compression="gzip")
    found = []
    for name, path in exported.items():
        contract = WIDE_WAREHOUSE[name]
        rows = sources.read_csv(spark, path, contract.schema)
        if name == "PitStopsFT":
            rows = rows.withColumnRenamed("date", "moment")
        elif name != "ResultsFactsFT":
            rows = rows.agg(F.count("*").alias("n"), F.sum(contract.key[0]).alias("ids"))
        found.append(rows.withColumn("table_name", F.lit(name)))
    return ops.union_batches(found)


@query
def raw_ingest(spark, sf_dir):
    """The gap is a number in some records, text in others and missing in the rest."""
    kind = F.col("event_type")
    gap = F.when(kind == "click", '"+1 LAP"').when(kind == "view", "null").otherwise(F.col("value").cast("string"))
    record = F.format_string(
        '{"driver_number": %d, "session_key": %d, "gap_to_leader": %s, "interval": %s, "team_colour": "x"}',
        "user_id", "event_id", gap, F.col("value").cast("string"),
    )
    landing, root = new_folder(spark, "landing"), new_folder(spark, "raw")
    table(spark, sf_dir, "events").select(record.alias("value")).write.text(f"{landing}/intervals")
    spec = sources.SourceSpec("intervals", drop=("team_colour",), stringify=("gap_to_leader", "interval"))
    schema = (
        T.StructType()
        .add("driver_number", "long")
        .add("session_key", "long")
        .add("gap_to_leader", "string")
        .add("interval", "string")
        .add("team_colour", "string")
    )
    return spark.read.parquet(plans.ingest(spark, spec, landing, root, schema, lines=True))


GAPS = (
    T.StructType().add("driver_number", "long").add("session_key", "long").add("gap_to_leader", "string")
    .add("interval", "string").add("team_colour", "string")
)
GAP_SPECS = """[{"base_url": "https://example.org/v1/intervals?", "attributes_to_remove": ["team_colour"],
                  "session_keys_range": {"start": 1, "end": 9}}]"""


@query
def ingest_incremental(spark, sf_dir):
    """Two landings, each read once; of ten records one is cut off and one lacks its driver, which are set aside.

    The spec comes from an API description, whose name says that gaps are kept as text.
    """
    kind, odd = F.col("event_type"), F.col("event_id") % 10
    gap = F.when(kind == "click", '"+1 LAP"').when(kind == "view", "null").otherwise(F.col("value").cast("string"))
    driver = F.when(odd == 1, "null").otherwise(F.col("user_id").cast("string"))
    whole = F.format_string(
        '{"driver_number": %s, "session_key": %d, "gap_to_leader": %s, "interval": %s, "team_colour": "x"}',
        driver, "event_id", gap, F.col("value").cast("string"),
    )
    record = F.when(odd == 0, F.substring_index(whole, ",", 2)).otherwise(whole)
    landing, root, state = (new_folder(spark, n) for n in ("landing", "raw", "state"))
    events = table(spark, sf_dir, "events").select(record.alias("value"), (F.col("event_id") % 3 == 0).alias("late"))
    for landed in (events.filter("NOT late"), events.filter("late"), None):  # at the third run nothing is new
        if landed is not None:
            landed.select("value").write.mode("append").text(f"{landing}/intervals")
        plans.ingest_all_new(
            spark, landing, root, state, sources.load_specs(GAP_SPECS), {"intervals": GAPS}, lines=True,
            required={"intervals": ["driver_number"]}, most_bad=0.5,
        )
    kept = spark.read.parquet(f"{root}/intervals.parquet")
    aside = spark.read.parquet(f"{root}/quarantine/intervals.parquet").select(
        F.regexp_extract("record", '"session_key": ?([0-9]+)', 1).cast("long").alias("session_key"), "reason"
    )
    return kept.unionByName(aside, allowMissingColumns=True)


def _exported(spark, df, name):
    shown = plans.export_view(df, name)
    path = sources.export_csv(shown, new_folder(spark, name))
    return sources.read_csv(spark, path, shown.schema)


@query
def drivers_export(spark, sf_dir):
    drivers = plans.build_drivers(views.drivers(spark, sf_dir), views.teams(spark, sf_dir))
    return _exported(spark, drivers, "DriversDT")


@query
def results_export(spark, sf_dir):
    return _exported(spark, results_fact(spark, sf_dir), "ResultsFactsFT")


# Streaming


def _event_stream(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    # Only as a pattern may the path of a stream be one file as well as a folder of files.
    stream = streaming.open_stream(spark, f"{sf_dir}/events.parque[t]", events.schema)
    return stream.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


@query
def stream_latest(spark, sf_dir):
    keys, newest = ["user_id", "event_type"], ["ts", "event_id"]
    latest = streaming.latest_stream(_event_stream(spark, sf_dir), keys, newest)
    out = new_folder(spark, "changes")
    streaming.run_available(streaming.write_changes(latest, out, new_folder(spark, "checkpoint")))
    return streaming.read_changes(spark, out, keys, newest)


@query
def stream_upsert(spark, sf_dir):
    """Events in four micro-batches, then the four again; the second time none counts."""
    events = table(spark, sf_dir, "events")
    raw, out = new_folder(spark, "events"), new_folder(spark, "snapshot")
    events.repartition(4).write.parquet(raw)
    for _ in range(2):
        stream = streaming.open_stream(spark, raw, events.schema, max_files=1)
        streaming.run_available(
            streaming.write_snapshot(
                stream, out, new_folder(spark, "checkpoint"), ["user_id", "event_type"], ["ts", "event_id"], buckets=8
            )
        )
    return streaming.read_snapshot(spark, out, events.schema).select("event_id", "ts", "user_id", "event_type", "value")


@query
def stream_window_mean(spark, sf_dir):
    means = streaming.window_mean(_event_stream(spark, sf_dir), "ts", ["value"], "1 day", LATENESS)
    out = new_folder(spark, "windows")
    streaming.run_available(streaming.write_changes(means, out, new_folder(spark, "checkpoint")))
    return _rounded(streaming.read_changes(spark, out, ["window_start"]), ["value"])


@query
def bucketed_lookup(spark, sf_dir):
    """Lines with the customer and the day of their order; neither table is shuffled for the join."""
    root, mark = new_folder(spark, "buckets"), uuid.uuid4().hex
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), "o_custkey", F.col("o_orderstatus").alias("status")
    )
    fact, dim = f"lines_{mark}", f"orders_{mark}"
    sources.store_fact(lines, ["order_id"], fact, root, buckets=16)
    sources.store_dimension(orders, ["order_id"], fact, dim, root, buckets=16)
    return sources.lookup_stored(spark, fact, dim, ["order_id"], ["o_custkey", "status"])


@query
def curve_layout(spark, sf_dir):
    """Lines stored along a curve through part, supplier and day, read back."""
    out = new_folder(spark, "curve")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    ops.cluster_on_curve(lines, ["l_partkey", "l_suppkey", "l_shipdate"]).write.parquet(out)
    return spark.read.parquet(out)


@query
def raw_variant(spark, sf_dir):
    """Records whose gap is a number, text, null or absent, landed as JSON, stored as VARIANT, told apart again."""
    landing, stored = new_folder(spark, "landing"), new_folder(spark, "variants")
    gap = F.when(F.col("event_type") == "click", '"+1 LAP"').when(F.col("event_type") == "view", "null")
    gap = gap.otherwise(F.col("value").cast("string"))
    gap = F.when(F.col("event_id") % 10 == 0, "").otherwise(F.concat(F.lit(', "gap_to_leader": '), gap))
    line = F.concat(F.lit('{"session_key": '), F.col("event_id").cast("string"), gap, F.lit("}"))
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(landing)
    sources.read_json_records(spark, landing).write.parquet(stored)
    return spark.read.parquet(stored).select(
        sources.field("record", "session_key", "long").alias("session_key"), sources.mixed("record", "gap_to_leader").alias("gap")
    ).select("session_key", "gap.kind", "gap.number", F.when(F.col("gap.kind") == "text", F.col("gap.text")).alias("text"))


@query
def stream_late(spark, sf_dir):
    """Three landings that each span the whole month, so much of the second and third comes after its day has closed."""
    out, raw, checkpoint = (new_folder(spark, x) for x in ("late", "raw", "checkpoint"))
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    part = F.col("event_id") % 10
    for landing in (part > 4, part.between(1, 4), part == 0):
        events.filter(landing).write.mode("append").parquet(raw)
        stream = streaming.open_stream(spark, raw, events.schema, max_files=1_000_000)
        streaming.run_available(
            streaming.write_windows(stream, "ts", ["value"], "1 day", LATENESS, out, checkpoint)
        )
    day = F.window("ts", "1 day")["start"].alias("window_start")
    late = streaming.read_late(spark, out)
    counts = late.groupBy(day).agg(F.count("*").alias("late_rows"))
    sums = ops.read_partials(spark, f"{out}/means", streaming.WINDOW).drop("window_end")
    rest = ops.partial_sums(late.select(day, "value"), ["window_start"], ["value"])
    every = ops.means_of(ops.merge_partials(sums.unionByName(rest), ["window_start"]), ["window_start"])
    in_time = streaming.read_windows(spark, out).select("window_start", F.col("value").alias("in_time"))
    return _rounded(
        every.join(in_time, "window_start", "left").join(counts, "window_start", "left").fillna(0, ["late_rows"]),
        ["value", "in_time"],
    )


@query
def daily_mean_incremental(spark, sf_dir):
    """Three loads out of order, one of them given twice, merged before the last."""
    out = new_folder(spark, "means")
    samples = views.weather(spark, sf_dir).withColumn("day", written_day("date"))
    for load in (1, 0, 1, 2):
        if load == 2:
            ops.compact_partials(spark, out, ["day"], upto=1)
        ops.add_partials(samples.filter(F.col("session_key") % 3 == load), ["day"], MEASURES, out, load, digits=4)
    # Sums are exact, so no rounding hides their order.
    return ops.means_of(ops.read_partials(spark, out, ["day"]), ["day"]).withColumnRenamed("day", "date")


@query
def stream_dedupe(spark, sf_dir):
    polled = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    once = streaming.dedupe_stream(polled, ["event_id"], "ts", LATENESS)
    out = new_folder(spark, "deduped")
    streaming.run_available(streaming.land_stream(once, out, new_folder(spark, "checkpoint")))
    return spark.read.parquet(out)


@query
def stream_ingest(spark, sf_dir):
    out = new_folder(spark, "landed")
    stream = _event_stream(spark, sf_dir)
    streaming.run_available(streaming.land_stream(stream, out, new_folder(spark, "checkpoint")))
    return spark.read.parquet(out)


flagship = results_fact
