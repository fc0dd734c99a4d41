"""Values that change over time: their intervals, and the value that held at a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from raceway.session import new_folder


def intervals(
    df: DataFrame, keys: Sequence[str], moment: str, values: Sequence[str], since: str = "valid_from", until: str = "valid_to"
) -> DataFrame:
    """Runs of equal ``values`` per key, each with the moment it begins and the moment the next one does.

    Of several rows at one moment the one with the largest values counts, NULL being smallest. NULL
    is a value like others, so a run of it ends the one before. Rows without a moment are left out. Each task
    first reduces its rows to one per key and moment.
    """
    at = df.filter(F.col(moment).isNotNull()).groupBy(*keys, moment).agg(F.max(F.struct(*values)).alias("_now"))
    along = Window.partitionBy(*keys).orderBy(moment)
    begun = at.withColumn("_before", F.lag("_now").over(along)).filter(
        F.col("_before").isNull() | ~F.col("_now").eqNullSafe(F.col("_before"))
    )
    return begun.select(*keys, "_now.*", F.col(moment).alias(since), F.lead(moment).over(along).alias(until))


def asof_left(
    df: DataFrame, changes: DataFrame, on: Sequence[str], moment: str, since: str, take: Sequence[str]
) -> DataFrame:
    """All rows and columns of ``df`` plus the ``take`` columns of the last change at or before ``moment``.

    Changes go by ``since``, of equals by the larger ``take``; a row before the first change of its key, or
    without a key or moment, gets NULLs. Both sides are laid out together in ranges of (key, time), written once,
    and each range is filled forward on its own. What a range needs from those before it is one
    change: the last one there is, if it has the key that the range begins with. So no pair of rows is
    formed, and a key with any number of rows or changes spreads over as many ranges as it fills.
    """
    clash = set(take) & set(df.columns)
    if clash:
        raise ValueError(f"looked-up columns already present: {sorted(clash)}")
    spark, key = df.sparkSession, F.struct(*on)
    # The row travels as one column, whatever its columns are called.
    rows = df.select(key.alias("k"), F.col(moment).alias("t"), F.lit(1).alias("kind"), F.struct(*df.columns).alias("row"))
    known = changes.dropna(subset=[*on, since]).select(
        key.alias("k"), F.col(since).alias("t"), F.lit(0).alias("kind"), F.struct(*take).alias("value")
    )
    order = ["k", "t", "kind", "value"]
    both = rows.unionByName(known, allowMissingColumns=True)
    path = new_folder(spark, "asof")
    # Rows of one key and moment may lie in several ranges; the changes there come before all of them.
    spread = both.withColumn("spread", F.when(F.col("kind") == 1, F.xxhash64("row")).otherwise(F.lit(0)))
    ranges = spread.repartitionByRange(*order, "spread").withColumn("part", F.spark_partition_id())
    ranges.write.parquet(path)
    laid = spark.read.schema(ranges.schema).parquet(path)
    inside = Window.partitionBy("part", "k").orderBy("t", "kind", "value").rowsBetween(Window.unboundedPreceding, 0)
    filled = laid.withColumn("held", F.last("value", ignorenulls=True).over(inside))
    # One row per range, over which the last change so far is carried on.
    ends = laid.groupBy("part").agg(F.max(F.when(F.col("kind") == 0, F.struct("k", "t", "value"))).alias("last"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", F.max("last").over(earlier).alias("carried"))
    held = F.coalesce("held", F.when(F.col("carried.k") == F.col("k"), F.col("carried.value")))
    held = F.when(F.col("t").isNotNull(), held)
    return filled.filter("kind = 1").join(carried, "part").select("row.*", *[held.getField(c).alias(c) for c in take])
