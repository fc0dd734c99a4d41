"""A live table kept as a bucketed snapshot: each micro-batch rewrites the buckets it touches, readers scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter

from raceway.session import exists, folder_names, remove_folder, replace_folder

_LEDGER = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("version", T.LongType())])


def _ledgers(spark: SparkSession, out: str) -> list[int]:
    """Numbers of the finished ledgers, ascending. One in the making has another name."""
    if not exists(spark, f"{out}/ledger"):
        return []
    return sorted(int(n[6:]) for n in folder_names(spark, f"{out}/ledger") if n[:6] == "batch=" and n[6:].isdigit())


def _versions(spark: SparkSession, out: str, batch: int) -> dict[int, int]:
    """Bucket to the batch that wrote its present rows; as many entries as there are buckets at most."""
    rows = spark.read.schema(_LEDGER).parquet(f"{out}/ledger/batch={batch}").collect()
    return {r.bucket: r.version for r in rows}


def _folders(out: str, versions: dict[int, int]) -> list[str]:
    return [f"{out}/data/batch={v}/_bucket={b}" for b, v in sorted(versions.items())]


def upsert(
    batch: DataFrame, batch_id: int, out: str, keys: Sequence[str], newest: Sequence[str], buckets: int
) -> bool:
    """Bring one micro-batch into the snapshot below ``out``; False if that was done before.

    ``keys`` hash into ``buckets``. Only buckets with a new row are read, merged (the largest
    ``newest`` counts, of equals the later batch) and written, to a folder of this batch. The ledger of the
    batch, which names each bucket's folder, then appears by one rename; without it nothing that was
    written counts, so a batch that stopped anywhere can be repeated, and one that was finished is skipped.
    Folders that neither this ledger nor the one before names are removed, so a reader that began with
    the ledger before is not disturbed. The number of buckets may not change later.
    """
    spark = batch.sparkSession
    done = _ledgers(spark, out)
    if done and done[-1] >= batch_id:
        return False
    before = _versions(spark, out, done[-1]) if done else {}
    payload = [c for c in batch.columns if c not in keys]
    order = [c for c in newest if c not in keys]
    rows = batch.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    # Each task keeps its own best row per key before the rows meet.
    best = F.max_by(F.struct(*payload), F.struct(*order, "_late")).alias("_row")
    found = rows.withColumn("_late", F.lit(1))
    touched = sorted(r[0] for r in rows.select("_bucket").distinct().collect())
    old = {b: before[b] for b in touched if b in before}
    if old:
        stored = spark.read.schema(batch.schema).parquet(*_folders(out, old))
        stored = stored.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        found = found.unionByName(stored.withColumn("_late", F.lit(0)))
    merged = found.groupBy("_bucket", *keys).agg(best).select(*keys, "_row.*", "_bucket")
    merged.select(*batch.columns, "_bucket").repartition("_bucket").write.mode("overwrite").partitionBy(
        "_bucket"
    ).parquet(f"{out}/data/batch={batch_id}")
    after = {**before, **{b: batch_id for b in touched}}
    making = f"{out}/ledger/making-{batch_id}"
    spark.createDataFrame(list(after.items()), _LEDGER).coalesce(1).write.mode("overwrite").parquet(making)
    replace_folder(spark, making, f"{out}/ledger/batch={batch_id}")
    if len(done) > 1:
        gone = set(_folders(out, _versions(spark, out, done[-2]))) - {*_folders(out, before), *_folders(out, after)}
        for folder in sorted(gone):
            remove_folder(spark, folder)
    for batch_done in done[:-1]:
        remove_folder(spark, f"{out}/ledger/batch={batch_done}")
    return True


def write_snapshot(
    latest: DataFrame, out: str, checkpoint: str, keys: Sequence[str], newest: Sequence[str], buckets: int = 64
) -> DataStreamWriter:
    """Keep the newest row per key of a stream as a snapshot, by ``upsert`` of each micro-batch.

    ``latest`` may be the plain stream, or one that was reduced to changed keys before. A bucket should be
    no larger than a task can merge: choose as many as the table will hold times 128 MB.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read for the touched buckets and for their merge
        upsert(batch, batch_id, out, keys, newest, buckets)
        batch.unpersist()

    return latest.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(store)


def read_snapshot(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The table as of the last finished batch: a plain scan of one folder per bucket."""
    done = _ledgers(spark, out)
    folders = _folders(out, _versions(spark, out, done[-1])) if done else []
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
