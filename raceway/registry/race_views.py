"""Race-shaped views over the given tables: whole tables, renamed and retyped row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def iso_text(moment: str | Column, offset: str = "+00:00") -> Column:
    return F.concat(F.date_format(moment, ISO), F.lit(offset))


def numbered(label: str, number: Column) -> Column:
    """A name such as Supplier#000000042."""
    return F.concat(F.lit(f"{label}#"), F.lpad(number.cast("string"), 9, "0"))


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities run from 1 to 50, so some positions lie outside the points table."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("driver_number"),
        F.col("l_linenumber").cast("bigint").alias("session_key"),
        iso_text("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("position"),
    )


def race_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``positions``, with an order as the session, as in ``drivers``."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("driver_number"),
        F.col("l_orderkey").alias("session_key"),
        iso_text("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("position"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stop some months before the last shipping date, so some days have no weather."""
    price, customer = F.col("o_totalprice"), F.col("o_custkey").cast("double")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("session_key"),
        F.col("o_custkey").alias("meeting_key"),
        iso_text("o_orderdate").alias("date"),
        price.alias("humidity"),
        customer.alias("pressure"),
        F.when(F.col("o_orderstatus") != "P", customer).alias("rainfall"),
        (price + customer).alias("air_temperature"),
        (price - customer).alias("track_temperature"),
        (customer / 2).alias("wind_speed"),
        F.col("o_orderkey").cast("double").alias("wind_direction"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer is a driver, an order one of their sessions; the price picks the team."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("driver_number"),
        F.col("o_orderkey").alias("session_key"),
        F.year("o_orderdate").cast("bigint").alias("meeting_key"),
        numbered("Customer", F.col("o_custkey")).alias("full_name"),
        F.col("o_orderpriority").alias("name_acronym"),
        numbered("Supplier", F.floor(F.col("o_totalprice") / 1_000)).alias("team_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("country_code"),
    )


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("team_id"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").cast("string").alias("country_code"),
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("acronym"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("session_key"),
        F.col("o_orderpriority").alias("session_name"),
        F.col("o_orderstatus").alias("session_type"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("circuit_short_name"),
        F.col("o_orderpriority").alias("location"),
        F.lit(None).cast("string").alias("country_name"),
        iso_text(start, "+02:00").alias("date_start"),
        iso_text(start, "-03:30").alias("date_end"),
        F.col("o_custkey").alias("circuit_key"),
        F.col("o_custkey").alias("country_key"),
        F.col("o_orderstatus").alias("country_code"),
        F.col("o_custkey").alias("meeting_key"),
        F.lit("02:00:00").alias("gmt_offset"),
        F.year(start).alias("year"),
    )


def pit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("driver_number"),
        F.col("l_linenumber").cast("bigint").alias("session_key"),
        F.col("l_orderkey").alias("meeting_key"),
        F.col("l_quantity").cast("bigint").alias("lap_number"),
        F.col("l_tax").alias("pit_duration"),
        iso_text("l_shipdate", "+01:00").alias("date"),
    )


def stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("driver_number"),
        F.col("l_orderkey").alias("session_key"),
        F.col("l_partkey").alias("meeting_key"),
        F.col("l_linenumber").cast("bigint").alias("stint_number"),
        F.col("l_quantity").cast("bigint").alias("lap_start"),
        (F.col("l_quantity") + 10).cast("bigint").alias("lap_end"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("compound"),
        F.when(F.col("l_linestatus") != "O", F.col("l_discount")).alias("tyre_age_at_start"),
    )


VIEWS = {
    "position": positions,
    "weather": weather,
    "drivers": drivers,
    "teams": teams,
    "sessions": sessions,
    "pit": pit,
    "stints": stints,
}
