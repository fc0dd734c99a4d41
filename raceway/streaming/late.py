"""Window means of a stream that lose no row: what comes too late goes to a table of its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from raceway.operators.partials import add_partials, means_of, read_partials
from raceway.session import exists, folder_names, remove_folder, replace_folder

WINDOW = ("window_start", "window_end")


def _marks(spark: SparkSession, out: str) -> list[int]:
    """Batches that finished, ascending."""
    if not exists(spark, f"{out}/mark"):
        return []
    return sorted(int(n[6:]) for n in folder_names(spark, f"{out}/mark") if n[:6] == "batch=" and n[6:].isdigit())


def _newest(spark: SparkSession, out: str, batch: int | None) -> int | None:
    """Largest moment up to a batch, in microseconds."""
    if batch is None:
        return None
    return spark.read.schema("at long").parquet(f"{out}/mark/batch={batch}").first().at


def _behind(end: Column, newest: int | None, lateness: str) -> Column:
    """Whether a window had closed: its end lies ``lateness`` or more before the newest moment."""
    if newest is None:
        return F.lit(False)
    return end <= F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {lateness}")


def write_windows(
    stream: DataFrame, moment: str, measures: Sequence[str], width: str, lateness: str, out: str, checkpoint: str
) -> DataStreamWriter:
    """Keep the mean of each measure per tumbling window, and the rows that came after their window had closed.

    A window closes once a row of an *earlier* micro-batch is ``lateness`` past its end. The rows of a micro-batch
    that fall in an open window add to that window's counts and sums; others, and rows without a moment, are
    stored whole in the side table. Each row thus ends in exactly one of the two. A batch that is repeated finds the
    same windows open and replaces what it wrote. The mark of a batch, written last, holds the largest moment up to it.
    There is no state between batches but that mark. ``moment`` is a timestamp with time zone. The counts and sums in
    ``means`` may be merged with ``compact_partials`` up to the last batch but one, as the last may be repeated.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [n for n in _marks(spark, out) if n < batch_id]
        newest = _newest(spark, out, earlier[-1] if earlier else None)
        batch.persist()  # read for both tables and for the mark
        span = "_" * (1 + max(map(len, batch.columns)))
        placed = batch.withColumn(span, F.window(moment, width))
        late = _behind(F.col(span)["end"], newest, lateness)
        # Spark leaves rows without a moment out of any window.
        aside = placed.filter(late).drop(span).unionByName(batch.filter(F.col(moment).isNull()))
        aside.write.mode("overwrite").parquet(f"{out}/late/late_batch={batch_id}")
        timed = placed.filter(~late).select(
            F.col(span)["start"].alias(WINDOW[0]), F.col(span)["end"].alias(WINDOW[1]), *measures
        )
        add_partials(timed, WINDOW, measures, f"{out}/means", batch_id)
        found = batch.agg(F.greatest(F.max(F.unix_micros(moment)), F.lit(newest).cast("long")).alias("at"))
        made = f"{out}/mark/making-{batch_id}"
        found.coalesce(1).write.mode("overwrite").parquet(made)
        replace_folder(spark, made, f"{out}/mark/batch={batch_id}")
        for done in earlier[:-1]:
            remove_folder(spark, f"{out}/mark/batch={done}")
        batch.unpersist()

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)


def read_windows(spark: SparkSession, out: str, lateness: str | None = None) -> DataFrame:
    """Means per window; with ``lateness`` only those of closed windows, which no later row changes."""
    means = means_of(read_partials(spark, f"{out}/means", WINDOW), WINDOW)
    if lateness is None:
        return means
    marks = _marks(spark, out)
    return means.filter(_behind(F.col(WINDOW[1]), _newest(spark, out, marks[-1] if marks else None), lateness))


def read_late(spark: SparkSession, out: str) -> DataFrame:
    """The rows that came too late, or had no moment, with the batch they came in."""
    return spark.read.parquet(f"{out}/late")
