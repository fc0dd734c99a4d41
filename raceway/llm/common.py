"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from raceway.session import new_folder, remove_folder

# Words are runs without these white-space bytes.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> SparkSession:
    """``spark``, after its Python workers were sent this package, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="raceway-"), "raceway")
        context.addPyFile(shutil.make_archive(base, "zip", root, "raceway"))
        _SHIPPED.add(context.applicationId)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """``base``, with underscores before it until no column of ``df`` begins like it."""
    while any(c.lower().startswith(base.lower()) for c in df.columns):
        base = f"_{base}"
    return base


def position(df: DataFrame, column: str) -> int:
    """Place of a column; its case counts only where two names differ in nothing else."""
    if column in df.columns:
        return df.columns.index(column)
    return [c.lower() for c in df.columns].index(column.lower())


def plain(df: DataFrame) -> DataFrame:
    """``df`` with its columns called c0, c1, ..., so that no private column can clash with their names."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def restored(df: DataFrame) -> list[Column]:
    """The columns of ``plain(df)`` under the names they have in ``df``."""
    return [F.col(f"c{k}").alias(c) for k, c in enumerate(df.columns)]


def staged(df: DataFrame, label: str, made: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: a cut of its lineage.

    The folder is added to ``made``, for ``discard`` once nothing reads it any more.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    if made is not None:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, made: list[str]) -> None:
    """Remove staged folders that all their readers are done with."""
    while made:
        remove_folder(spark, made.pop())


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def sampled(doc_id: Column, share: float) -> Column:
    """Whether the hash of an id is among the lowest ``share`` of all, told on a scale of 2^62 steps.

    At 10^12 times a sample's bound there are still steps enough to hold it.
    """
    return F.shiftrightunsigned(F.xxhash64(doc_id), 2) < F.lit(int(share * (1 << 62)))


def ranged(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """``df`` stored in ranges of ``order``; ``_part`` numbers the ranges in that order."""
    parts = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    return staged(parts, label)


def prefix_sums(
    df: DataFrame, order: Sequence[Column], sums: dict[str, Column], label: str
) -> DataFrame:
    """Running totals up to and with each row over all of ``df``, without a single-task window.

    Rows are summed inside their range; one row per range carries the total of the ranges before.
    """
    parts = ranged(df.withColumns(sums), order, label)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(c) for c in sums])
    offsets = totals.select(
        "_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums]
    )
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = parts.withColumns({c: F.sum(c).over(inside) for c in sums}).join(offsets, "_part")
    return running.withColumns({c: F.col(c) + F.col(f"_before_{c}") for c in sums}).drop(
        "_part", *[f"_before_{c}" for c in sums]
    )
