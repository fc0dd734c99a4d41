"""A corpus pipeline of the training-data operators: STAGES over ``documents``, applied by ``run``.

Each stage works on all rows its predecessor kept and returns the columns it was given, except the
last. NULL and empty texts, NULL ids, repeated rows and columns beyond those of ``documents`` are
as in the operator's docstring; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from raceway.llm import bpe, line_dedup, mixing, quality, simhash
from raceway.llm.common import documents, fresh, staged

#: Documents with a lower quality score are rejected: for these label 0 is the likelier.
ACCEPTED = 0.5


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of low quality by a classifier fitted on ``labels``; texts are unchanged."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(quality.learnable(F.col("doc_id")))
    score = quality.scorer(quality.fit(docs, labels))
    return docs.filter(score("text") >= ACCEPTED)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes lines that repeat an earlier document; a document left without any line goes.

    ``n_chars`` follows the new text. Texts that were NULL or empty before stay.
    """
    out = fresh(docs, "_lines")
    found = line_dedup.line_dedup(docs, out=out)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(F.size(f"{out}.gone") > 0, length).otherwise(F.col("n_chars")))
    whole = (F.size(f"{out}.gone") > 0) & (F.size(f"{out}.gone") >= F.col(f"{out}.lines"))
    return found.filter(~whole).select(*docs.columns)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target: rows repeated by epoch, rows beyond the cut left out."""
    return mixing.mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, path: str | None = None) -> DataFrame:
    """Token ids per document, by the public byte-level vocabulary unless ``path`` names another."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    codec = bpe.Codec(spark, path)
    coded = codec.round_trip(docs.select("doc_id", "lang", "source", "text"), "text", "ids", "decoded")
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids",
        F.col("decoded").eqNullSafe(F.coalesce("text", F.lit(""))).alias("lossless"),
    )


STAGES = [
    ("quality classifier", accept_quality),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", keep_one_of_near),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", encode_tokens),
]

#: The classifier and the encoder cannot be said in SQL; tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``; what each stage returns is stored and reread."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
