"""Means that are kept up load by load: each load stores counts and exact sums, which merge in any order."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from raceway.session import exists, folder_names, move_folder, remove_folder, replace_folder


def partial_sums(df: DataFrame, group: Sequence[str], measures: Sequence[str], digits: int = 9) -> DataFrame:
    """One row per group: of each measure a struct of the count of values and their sum.

    Sums are decimals of ``digits`` places, so that their order does not matter; a value is rounded to
    that many. One that is not finite, or of 10^17 and more with nine digits, fails the job.
    """
    exact = f"decimal(26,{digits})"
    sums = [
        F.struct(F.count(m).alias("n"), F.sum(F.col(m).cast(exact)).cast(f"decimal(38,{digits})").alias("sum")).alias(m)
        for m in measures
    ]
    return df.groupBy(*group).agg(*sums)


def merge_partials(partials: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group of rows that ``partial_sums`` made."""
    kept = [f for f in partials.schema if f.name not in group]
    return partials.groupBy(*group).agg(
        *[
            F.struct(
                F.sum(F.col(f.name)["n"]).alias("n"), F.sum(F.col(f.name)["sum"]).cast(f.dataType["sum"].dataType).alias("sum")
            ).alias(f.name)
            for f in kept
        ]
    )


def means_of(partials: DataFrame, group: Sequence[str]) -> DataFrame:
    """The mean of each measure, NULL where a group has no value."""
    measures = [c for c in partials.columns if c not in group]
    return partials.select(
        *group, *[F.try_divide(F.col(m)["sum"].cast("double"), F.col(m)["n"]).alias(m) for m in measures]
    )


def _loads(spark: SparkSession, out: str) -> tuple[list[int], int]:
    """Stored loads, and the number up to which they were merged (-1: none)."""
    names = folder_names(spark, out) if exists(spark, out) else []
    loads = sorted(int(n[5:]) for n in names if re.fullmatch(r"load=\d+", n))
    return loads, max((int(n[5:-2]) for n in names if re.fullmatch(r"load=\d+\.5", n)), default=-1)


def _folders(spark: SparkSession, out: str) -> list[str]:
    """What counts now: the last merged folder and the loads after it."""
    loads, merged = _loads(spark, out)
    return [f"{out}/load={merged}.5"] * (merged >= 0) + [f"{out}/load={n}" for n in loads if n > merged]


def add_partials(
    df: DataFrame, group: Sequence[str], measures: Sequence[str], out: str, load: int, digits: int = 9
) -> None:
    """Store what one load brings, below ``out``; no earlier row or group is read or written.

    Loads may come in any order. A load that is given again replaces what it gave before, so it may
    be repeated or corrected, until ``compact_partials`` has merged its number; then it is refused, as
    it cannot be taken out again.
    """
    spark = df.sparkSession
    if load <= _loads(spark, out)[1]:
        raise ValueError(f"load {load} of {out} was merged")
    made = f"{out}/making-{load}"
    partial_sums(df, group, measures, digits).write.mode("overwrite").parquet(made)
    replace_folder(spark, made, f"{out}/load={load}")


def read_partials(spark: SparkSession, out: str, group: Sequence[str]) -> DataFrame:
    """Counts and sums per group over all loads."""
    return merge_partials(spark.read.parquet(*_folders(spark, out)), group)


def compact_partials(spark: SparkSession, out: str, group: Sequence[str], upto: int) -> None:
    """Merge all loads numbered up to ``upto`` into one row per group.

    The merged rows appear by one rename, and count from then on instead of what they cover. That
    goes with the next compaction, so a reader that began before is not disturbed. A compaction that
    stopped anywhere can be repeated.
    """
    loads, merged = _loads(spark, out)
    covered = [n for n in loads if merged < n <= upto]
    if not covered:
        return
    names = [n for n in folder_names(spark, out) if re.fullmatch(r"load=\d+(\.5)?", n)]
    folders = [f"{out}/load={merged}.5"] * (merged >= 0) + [f"{out}/load={n}" for n in covered]
    made = f"{out}/making-{upto}.5"
    merge_partials(spark.read.parquet(*folders), group).write.mode("overwrite").parquet(made)
    move_folder(spark, made, f"{out}/load={upto}.5")
    for name in names:
        if float(name[5:]) < merged + 0.5:
            remove_folder(spark, f"{out}/{name}")
