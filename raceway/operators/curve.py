"""Layout along a curve through all key columns, so that a filter on any one of them skips most of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _number(df: DataFrame, column: str) -> Column:
    """A key as a number of the same order, for its rank only."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(F.col(column).cast("date")).cast("double")
    raise ValueError(f"{column}: {kind.simpleString()} has no place on a curve")


def _rank(value: Column, bounds: list[float], bits: int) -> Column:
    """How many bounds are no larger than the value, by halving; 0 for NULL."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    stops = F.array(*[F.lit(float(x)) for x in bounds])
    return F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(stops, at + step - 1) <= value, at + step).otherwise(at)
    )


def _spread(rank: Column, bits: int, width: int, first: int) -> Column:
    """Every bit of the rank moved to ``first``, ``first + width``, and so on."""
    moved = F.lit(0).cast("long")
    for b in range(bits):
        moved = moved + F.shiftleft(F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long"), b * width + first)
    return moved


def place_on_curve(df: DataFrame, keys: Sequence[str], out: str, bits: int = 8) -> DataFrame:
    """``df`` with a number ``out``, the interleaved bits of its keys' ranks: rows near in it are near in every key.

    A rank is one of 2^``bits`` shares of about equal size, by approximate quantiles of all rows, so skewed and
    uneven keys are cut as finely as they are filled. One pass over the keys; the driver sees
    2^``bits`` numbers per key. Keys are numbers, days or times; NULL ranks lowest.
    """
    if len(keys) * bits > 62:
        raise ValueError(f"{len(keys)} keys of {bits} bits do not fit")
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    numbers = [_number(df, c) for c in keys]
    found = df.agg(*[F.percentile_approx(n, shares, 10 << bits).alias(f"b{k}") for k, n in enumerate(numbers)]).first()
    # Ranks are columns of their own, so that each is worked out once.
    names = [f"{out}{k}" for k in range(len(keys))]
    ranked = df.withColumns(
        {name: _rank(n, bounds, bits) if bounds else F.lit(0) for name, n, bounds in zip(names, numbers, found)}
    )
    place = F.lit(0).cast("long")
    for k, name in enumerate(names):
        place = place + _spread(F.col(name), bits, len(keys), len(keys) - 1 - k)
    return ranked.withColumn(out, place).drop(*names)


def cluster_on_curve(df: DataFrame, keys: Sequence[str], bits: int = 8) -> DataFrame:
    """Ranges along the curve, sorted along it; the keys themselves decide inside one cell, so a hot cell can be cut."""
    name = "_" * (1 + max(map(len, df.columns)))
    placed = place_on_curve(df, keys, name, bits)
    return placed.repartitionByRange(name, *keys).sortWithinPartitions(name, *keys).drop(name)
