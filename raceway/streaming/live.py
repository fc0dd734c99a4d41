"""Structured Streaming counterparts of the batch operators."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from raceway.operators import latest_per_key
from raceway.session import folder_names, move_folder, remove_folder


def open_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = 1000,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files landing below a path; ``max_files`` bounds the work of one micro-batch."""
    reader = spark.readStream.schema(schema).options(**(options or {})).option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def latest_stream(stream: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Running newest row per key, ordered like ``latest_per_key``.

    Each task first reduces its rows to one per key; the state holds one row per key.
    """
    payload = [c for c in stream.columns if c not in keys]
    best = F.max_by(F.struct(*payload), F.struct(*newest)).alias("_row")
    return stream.groupBy(*keys).agg(best).select(*keys, "_row.*")


def write_changes(latest: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Append the keys each micro-batch changed to a change log.

    A batch owns its folder, so a batch repeated after a failure replaces its own rows only.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        latest.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(store)
    )


def read_changes(
    spark: SparkSession, out: str, keys: Sequence[str], newest: Sequence[str] = ()
) -> DataFrame:
    """The change log reduced to its newest row per key; of equals the later batch's."""
    return latest_per_key(spark.read.parquet(out), keys, [*newest, "batch"]).drop("batch")


def compact_changes(
    spark: SparkSession, out: str, keys: Sequence[str], newest: Sequence[str] = ()
) -> None:
    """Merge all but the last batch of a change log into one row per key.

    The last batch is left alone, since a restarted stream may write it again. The merged rows are made outside
    the log and appear in it by one rename, as batch N.5 after the youngest batch N that they cover; then
    the covered ones go. Readers find every key at any time, and order what they find as before. A compaction
    that stopped anywhere leaves nothing that the next one does not clear. Run between micro-batches, it
    keeps what ``read_changes`` reads in proportion to the keys.
    """
    names = [n[6:] for n in folder_names(spark, out) if re.fullmatch(r"batch=\d+(\.5)?", n)]
    batches = sorted(names, key=float)[:-1]
    if len(batches) < 2:
        return
    last = batches[-1]
    if not last.endswith(".5"):  # else all that lies before was merged into it, and only has to go
        folders = [f"{out}/batch={n}" for n in batches]
        covered = spark.read.option("basePath", out).parquet(*folders)
        merged = f"{out.rstrip('/')}.merged"
        latest_per_key(covered, keys, [*newest, "batch"]).drop("batch").write.mode("overwrite").parquet(merged)
        move_folder(spark, merged, f"{out}/batch={last}.5")
        batches.append(last)
    for batch in batches[:-1]:
        remove_folder(spark, f"{out}/batch={batch}")


def window_mean(
    stream: DataFrame, moment: str, measures: Sequence[str], width: str, lateness: str
) -> DataFrame:
    """Mean of each measure per tumbling window; rows later than ``lateness`` are left out."""
    windows = stream.withWatermark(moment, lateness).groupBy(F.window(moment, width).alias("_w"))
    means = windows.agg(*[F.avg(m).alias(m) for m in measures])
    return means.select(F.col("_w.start").alias("window_start"), *measures)


def dedupe_stream(
    stream: DataFrame, keys: Sequence[str], moment: str, lateness: str, salts: int = 1
) -> DataFrame:
    """Drop rows that repeat a key within the watermark, such as a repeated poll.

    The state holds the keys of the last ``lateness``. With ``salts`` above 1, copies of one key
    are first thinned out per slice, by the task that read them, so that a key with very many
    copies does not meet in one task until few are left; each slice then keeps state as well.
    """
    timed = stream.withWatermark(moment, lateness)
    if salts < 2:
        return timed.dropDuplicatesWithinWatermark(list(keys))
    salted = timed.withColumn("_salt", F.spark_partition_id() % salts)
    thinned = salted.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return thinned.dropDuplicatesWithinWatermark(list(keys))


def land_stream(stream: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Append arriving rows to Parquet; the checkpoint makes each file count once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
    )


def run_available(writer: DataStreamWriter) -> None:
    """Process everything that has arrived, then stop."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
