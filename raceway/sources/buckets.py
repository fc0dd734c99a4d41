"""A fact and the dimension it looks up, stored in the same hashed buckets, so that their join moves no row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from raceway.operators.quality import check_unique

#: Spreads the rows of a hot key; 0 for all others.
SLICE = "bucket_slice"


def _store(df: DataFrame, on: Sequence[str], name: str, path: str, buckets: int) -> None:
    keys = [*on, SLICE]
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(name)
    )


def _marked(df: DataFrame, hot: DataFrame, on: Sequence[str]) -> DataFrame:
    """``df`` with a column that tells whether its key is hot."""
    known = hot.select(*[F.col(c).alias(f"hot_{c}") for c in on], F.lit(True).alias("is_hot"))
    match = F.lit(True)
    for c in on:
        match = match & df[c].eqNullSafe(known[f"hot_{c}"])
    # No more rows than buckets, see store_fact.
    return df.join(F.broadcast(known), match, "left").select(*df.columns, F.coalesce("is_hot", F.lit(False)).alias("is_hot"))


def store_fact(fact: DataFrame, on: Sequence[str], name: str, root: str, buckets: int) -> None:
    """Store ``fact`` as table ``name``, hashed by ``on`` into ``buckets``, one file each, below ``root``.

    A key with more rows than a bucket holds on average is hot, NULL too: its rows are spread over all buckets,
    by a slice number that is part of the bucket key. There are fewer such keys than buckets; they are
    stored beside the fact, since ``store_dimension`` copies their rows to every slice. Choose so many
    buckets that one is what a task can sort. A fact of other hot keys needs its dimension stored anew.
    """
    clash = {SLICE, "is_hot"} & set(fact.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    counts = fact.groupBy(*on).agg(F.count("*").alias("rows"))
    total = fact.count()
    hot = counts.filter(F.col("rows") * buckets > total).select(*on)
    path = f"{root}/{name}_hot"
    hot.coalesce(1).write.mode("overwrite").parquet(path)
    hot = fact.sparkSession.read.schema(hot.schema).parquet(path)
    slice_ = F.when(F.col("is_hot"), F.floor(F.rand(11) * buckets)).otherwise(0).cast("int")
    _store(_marked(fact, hot, on).select(*fact.columns, slice_.alias(SLICE)), on, name, f"{root}/{name}", buckets)


def store_dimension(dim: DataFrame, on: Sequence[str], fact_name: str, name: str, root: str, buckets: int) -> None:
    """Store ``dim`` beside the fact it serves, in as many buckets; rows of the fact's hot keys once per slice.

    Equal rows count once, rows with a NULL key match nothing and are left out, and a key with two
    different rows is refused.
    """
    rows = dim.dropna(subset=list(on)).distinct()
    check_unique(rows.select(*on), list(on), name)
    hot = dim.sparkSession.read.schema(dim.select(*on).schema).parquet(f"{root}/{fact_name}_hot")
    slices = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0)))
    copies = _marked(rows, hot, on).select(*rows.columns, F.explode(slices).alias(SLICE))
    _store(copies, on, name, f"{root}/{name}", buckets)


def lookup_stored(spark: SparkSession, fact_name: str, name: str, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    """All rows of a stored fact with the ``take`` columns of its stored dimension; NULL without a match.

    Bucket meets bucket: neither side is shuffled, whatever their sizes. Both tables must be in the session's catalogue.
    """
    fact = spark.table(fact_name)
    columns = [c for c in fact.columns if c != SLICE]
    clash = set(take) & set(columns)
    if clash:
        raise ValueError(f"looked-up columns already present: {sorted(clash)}")
    dim = spark.table(name).select(*on, SLICE, *take)
    return fact.join(dim, [*on, SLICE], "left").select(*columns, *take)
