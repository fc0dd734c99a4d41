"""Operators that work row by row, and the daily mean."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from raceway.functions import mapped, written_day


def reshape(
    df: DataFrame,
    drop: Iterable[str] = (),
    derive: Mapping[str, Column] | None = None,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Drop, then derive, then rename; dropping an absent column is no error."""
    df = df.drop(*drop)
    if derive:
        df = df.withColumns(dict(derive))
    return df.withColumnsRenamed(dict(rename)) if rename else df


def strip_attributes(df: DataFrame, attributes: Iterable[str]) -> DataFrame:
    """Remove the listed attributes; unknown ones are ignored."""
    return df.drop(*attributes)


def stringify(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Store mixed number/text columns as text; NULL stays NULL."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def fill_text(df: DataFrame, value: str = "Unknown") -> DataFrame:
    """Replace NULL in every text column; other types keep their NULLs."""
    return df.fillna(value)


def fill_sentinel(df: DataFrame, sentinels: Mapping[str, int]) -> DataFrame:
    """Replace NULL ids by a number, as whole-number columns."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("int"), F.lit(value)) for c, value in sentinels.items()}
    )


def map_lookup(df: DataFrame, column: str, values: Mapping, out: str) -> DataFrame:
    return df.withColumn(out, mapped(column, values))


def daily_mean(
    df: DataFrame, moment: str, measures: Iterable[str], day: str = "date"
) -> DataFrame:
    """Mean of each measure per written day; NULLs are left out of a mean.

    The means are partly summed before the shuffle, so a day that holds most of the rows costs
    one small record per task.
    """
    return df.groupBy(written_day(moment).alias(day)).agg(*[F.avg(m).alias(m) for m in measures])
