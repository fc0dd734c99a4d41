"""Operators that bring several inputs together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def lookup_left(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    take: Sequence[str],
    unique: bool = False,
) -> DataFrame:
    """All rows and columns of ``df`` plus the ``take`` columns of the matching ``dim`` row.

    A row without a match gets NULLs. Equal ``dim`` rows count once; a key with two different
    rows fails the job that reads the result, since it would multiply the rows of ``df``. With
    ``unique`` the caller answers for the keys, as for a table that was written with its check.

    Nothing runs before the result is asked for. The join gets plain inputs: Spark broadcasts
    ``dim`` when its measured size is below the session's threshold, else sorts and merges, where
    adaptive execution splits a hot key of ``df`` over several tasks.
    """
    on = [on] if isinstance(on, str) else list(on)
    clash = set(take) & set(df.columns)
    if clash:
        raise ValueError(f"looked-up columns already present: {sorted(clash)}")
    rows = dim.select(*on, *take).dropna(subset=on)  # a NULL key matches nothing
    return df.join(rows if unique else _merged(rows, on, take), on, "left").select(*df.columns, *take)


def _merged(rows: DataFrame, on: list[str], take: Sequence[str]) -> DataFrame:
    """One row per key; a key whose rows differ raises.

    Grouping by one more column than the join needs keeps an exchange between the two, and with
    it adaptive splitting: the partitions of an aggregate right under a join cannot be read twice.
    """
    spread = []
    for c in take:
        spread += [F.min(c).alias(f"_min_{c}"), F.max(c).alias(f"_max_{c}"), F.count(c).alias(f"_set_{c}")]
    merged = rows.groupBy(*on, F.xxhash64(*on).alias("_apart")).agg(F.count("*").alias("_rows"), *spread)

    def value(c: str) -> Column:
        same = F.col(f"_min_{c}").eqNullSafe(F.col(f"_max_{c}")) & F.col(f"_set_{c}").isin(
            F.lit(0), F.col("_rows")
        )
        message = F.lit(f"lookup: {c} is not unique for {', '.join(on)}")
        return F.when(~same, F.raise_error(message)).otherwise(F.col(f"_min_{c}"))

    return merged.select(*on, *[value(c).alias(c) for c in take])


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Append by column name; a column a batch lacks is NULL there, duplicates stay."""
    if not batches:
        raise ValueError("no batches")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def request_manifest(
    base_url: str, seen: DataFrame | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """One row per request: the distinct keys it asks for and its URL.

    ``seen`` holds the ``keys`` that occur together, such as the cars of each session; a row that
    lacks one asks for nothing. Without keys there is one request.
    """
    if not keys:
        return SparkSession.active().range(1).select(F.lit(base_url).alias("url"))
    asked = seen.select(*keys).dropna().distinct()
    parts = []
    for c in keys:
        parts += [F.lit(f"{'&' if parts else '?'}{c}="), F.col(c).cast("string")]
    return asked.withColumn("url", F.concat(F.lit(base_url), *parts))
