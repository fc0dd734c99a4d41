"""Operators about keys: newest row, distinct rows, generated keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from raceway.functions import day_number
from raceway.session import exists, folder_names, new_folder, remove_folder, replace_folder


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the one with the largest ``newest`` values, compared left to right.

    NULL is smaller than any value. ``newest`` must order the rows of a key completely, else the
    choice among equal rows is open. Spark cuts each task's rows to one per key before the
    shuffle (``WindowGroupLimit``), so a hot key never meets in one task.
    """
    order = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in newest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_narrow(
    df: DataFrame,
    keys: Sequence[str],
    moment: Column,
    tie: str,
    take: Mapping[str, Column],
    last: Column | None = None,
) -> DataFrame:
    """``latest_per_key`` without a sort, for rows ordered by a time and then a 64-bit number.

    ``last`` decides among equal times and numbers, as a whole number from 0 to 3. All three fit
    one 38-digit number, as times end with the year 9999. The newest row is then a maximum that
    Spark keeps in a hash table, before and after the shuffle, as long as ``take`` has no text. A
    missing time comes before all others, a missing number before all numbers.
    """
    whole = "decimal(38,0)"
    micros = F.coalesce(F.unix_micros(moment), F.lit(-(10**17))).cast("decimal(18,0)")
    place = F.coalesce(F.col(tie).cast("decimal(20,0)") + F.lit(Decimal((1 << 63) + 1)), F.lit(0)).cast("decimal(20,0)")
    place = place * F.lit(4) + F.coalesce(last if last is not None else F.lit(0), F.lit(0)).cast("decimal(1,0)")
    at = (micros * F.lit(Decimal(1 << 66)) + place.cast("decimal(22,0)")).cast(whole)
    packed = df.select(*keys, *[c.alias(n) for n, c in take.items()], at.alias("_at"))
    return packed.groupBy(*keys).agg(*[F.max_by(n, "_at").alias(n) for n in take])


def dedupe_by(df: DataFrame, keys: Sequence[str], newest: Sequence[str | Column]) -> DataFrame:
    """Keep one row per key, chosen by a stated order instead of by arrival."""
    return latest_per_key(df, keys, newest)


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Collapse equal rows; copies already merge inside each task before the shuffle."""
    return df.distinct()


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def day_key(df: DataFrame, day: str, out: str) -> DataFrame:
    """Key of a day that does not depend on the other rows."""
    return df.withColumn(out, day_number(day))


def surrogate_key(
    df: DataFrame, order: Sequence[str], out: str, staging: str | None = None
) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of ``order``, then of the remaining columns.

    The rows should be distinct; their numbers then depend on nothing but the data. They are
    written once, sorted by ranges, to ``staging`` (by default below the shared folder), and the
    number is the row's place in its file plus the rows of the files before it. No task sees more
    than one range, and a lost executor cannot shift a number that has been given.
    """
    columns = [*order, *(c for c in df.columns if c not in order)]
    staging = staging or new_folder(df.sparkSession, "ordered")
    ranges = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    ranges.write.mode("overwrite").parquet(staging)

    stored = df.sparkSession.read.schema(df.schema).parquet(staging)
    # File names carry the number of their range and of the piece of it: part-00012-...-c000...
    name = F.col("_metadata.file_name")
    number, piece = (F.regexp_extract(name, p, 1).cast("int") for p in (r"^part-(\d+)", r"-c(\d+)\."))
    placed = stored.select(
        "*", number.alias("_number"), piece.alias("_piece"), F.col("_metadata.row_index").alias("_place")
    )
    starts = _starts(placed.groupBy("_number", "_piece").agg(F.count("*").alias("_rows")))
    # Two integers and a count per file: Spark sends them to all tasks if their size allows.
    return placed.join(starts, ["_number", "_piece"]).select(
        (F.col("_start") + F.col("_place")).alias(out), *df.columns
    )


def surrogate_key_append(
    df: DataFrame, order: Sequence[str], out: str, registry: str, load: int
) -> DataFrame:
    """Number the rows that earlier loads have not numbered; all rows that any load up to this one gave.

    ``registry`` is a folder of ``load=<n>`` tables, each the rows that load first brought, with their
    numbers. New rows are those that no earlier load holds (all columns compared, NULL equal to
    NULL). They continue after the largest number given, in the order of ``surrogate_key``, so a row keeps its
    number whatever comes later and wherever it would sort. A load's table appears by one rename.
    Repeating the last load gives the same numbers; repeating an older one is refused, since a later one
    has counted on it.
    """
    spark, columns = df.sparkSession, list(df.columns)
    names = folder_names(spark, registry) if exists(spark, registry) else []
    loads = [int(n[5:]) for n in names if n[:5] == "load=" and n[5:].isdigit()]
    if any(n > load for n in loads):
        raise ValueError(f"load {max(loads)} of {registry} came after load {load}")
    schema = df.select(F.lit(0).cast("long").alias(out), *columns).schema
    earlier = [f"{registry}/load={n}" for n in sorted(loads) if n < load]
    rows, start = df.distinct(), 0
    if earlier:
        known = spark.read.schema(schema).parquet(*earlier)
        start = known.agg(F.coalesce(F.max(out) + 1, F.lit(0))).first()[0]
        same = [F.col(f"new.{c}").eqNullSafe(F.col(f"known.{c}")) for c in columns]
        rows = rows.alias("new").join(known.select(*columns).alias("known"), same, "left_anti")
    ordered = new_folder(spark, "ordered")
    numbered = surrogate_key(rows, order, out, ordered).withColumn(out, F.col(out) + F.lit(start))
    made = f"{registry}/making-{load}"
    numbered.select(*schema.names).write.mode("overwrite").parquet(made)
    remove_folder(spark, ordered)
    replace_folder(spark, made, f"{registry}/load={load}")
    return spark.read.schema(schema).parquet(*earlier, f"{registry}/load={load}")


def _starts(sizes: DataFrame, width: int = 1000) -> DataFrame:
    """Rows before each file: summed inside blocks of ``width`` ranges, and over the blocks."""
    sizes = sizes.withColumn("_block", F.floor(F.col("_number") / width))
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = earlier.partitionBy("_block").orderBy("_number", "_piece")
    blocks = sizes.groupBy("_block").agg(F.sum("_rows").alias("_rows")).select(
        "_block", F.coalesce(F.sum("_rows").over(earlier.orderBy("_block")), F.lit(0)).alias("_before")
    )
    rows = sizes.withColumn("_inside", F.coalesce(F.sum("_rows").over(inside), F.lit(0)))
    return rows.join(blocks, "_block").select(
        "_number", "_piece", (F.col("_before") + F.col("_inside")).alias("_start")
    )
