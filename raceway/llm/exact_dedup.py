"""Exact de-duplication as a stream with keyed state, hits checked byte for byte."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from raceway.llm.common import SPACE, staged
from raceway.session import new_folder

#: State on the executors' disks, without space reserved ahead in each of many small stores.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def normalised(text: Column) -> Column:
    """Each run of white space as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    """Digest, identifier, content locator (file and row) and normalised text of each row."""
    body = normalised(F.col(text_col))
    return docs.select(
        F.struct(
            F.col(id_col).isNull().alias("no_id"),
            F.col(id_col).alias("id"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ).alias("at"),
        digest(body).alias("digest"),
        body.alias("body"),
    )


def digest_state(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    max_files: int = 100_000,
) -> DataFrame:
    """Run the stream over the files at ``path`` and return its last state per digest.

    The state is one row per digest: the smallest identifier with its locator, and the count. It
    lives in RocksDB on the executors' disks, is checkpointed to the shared folder and never
    expires. Rows are reduced per task before they meet the state. Each micro-batch owns a folder
    of changed keys, so that a repeated batch replaces its own rows only.
    """
    log, checkpoint = new_folder(spark, "digest-log"), new_folder(spark, "digest-checkpoint")
    # As a pattern the path may name one file as well as a folder of files.
    pattern = f"{path[:-1]}[{path[-1]}]"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(pattern)
    state = located(stream, id_col, text_col, digest).groupBy("digest").agg(
        F.min("at").alias("keeper"), F.count(F.lit(1)).alias("n")
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).foreachBatch(store).start().awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    # Without input there is no batch; this keeps the folder readable.
    spark.createDataFrame([], state.schema).write.parquet(f"{log}/batch=-1")
    changes = spark.read.schema(state.schema).parquet(log)
    # Counts of a digest only grow and its keeper only shrinks: both ends need no batch number.
    return changes.groupBy("digest").agg(F.min("keeper").alias("keeper"), F.max("n").alias("n"))


def exact_dedup(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    max_files: int = 100_000,
) -> DataFrame:
    """One row per row of the Parquet files at ``path``: at, digest, text_sha256, keeper, n.

    ``keeper`` is the row that stays of all rows with equal normalised text: smallest identifier
    (NULL last), ties by locator, so of repeated rows one stays. NULL text counts as empty. Rows
    that share a digest with their keeper are compared with it byte for byte; where bytes differ,
    that digest's rows are grouped by their bytes instead. Columns beyond the two named are unread.
    """
    docs = spark.read.parquet(path)
    schema = docs.select(id_col, text_col).schema
    state = staged(digest_state(spark, path, schema, id_col, text_col, digest, max_files), "digests")
    rows = located(docs, id_col, text_col, digest)
    groups = state.filter("n > 1")
    pool = staged(
        rows.join(groups.select("digest", "keeper"), "digest").select("digest", "at", "keeper", "body"),
        "digest-hits",
    )
    kept = pool.filter("at = keeper").select("digest", F.col("body").alias("kept_body"))
    hits = pool.filter("at <> keeper")
    clash = staged(
        hits.join(kept, "digest").filter("body <> kept_body").select("digest"),
        "digest-clashes",
    )
    keys = rows.select("digest", "at", sha256(F.col("body")).alias("text_sha256"))
    sure = keys.join(state, "digest").join(clash, "digest", "left_anti")
    if clash.isEmpty():
        return keys.join(state, "digest").select("at", "digest", "text_sha256", "keeper", "n")
    unsure = pool.join(clash, "digest", "left_semi")
    by_bytes = unsure.groupBy("digest", "body").agg(
        F.min("at").alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    apart = unsure.drop("keeper").join(by_bytes, ["digest", "body"]).withColumn(
        "text_sha256", sha256(F.col("body"))
    )
    columns = ["at", "digest", "text_sha256", "keeper", "n"]
    return sure.select(*columns).unionByName(apart.select(*columns))
