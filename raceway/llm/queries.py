"""The operators over the given tables, ``opN_<name>``, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from raceway.llm import (
    alignment, bpe, exact_dedup, language, line_dedup, mixing, paragraph_dedup, ppm, quality, repair, setjoin, simhash, sketches,
)
from raceway.llm.common import documents, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_fingerprints(spark, sf_dir):
    return sketches.likeness(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query
def op2_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(quality.learnable(F.col("doc_id")))
    score = quality.scorer(quality.fit(docs, labels))
    return docs.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"),
        score("text").alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op3_simhash(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op4_mixing(spark, sf_dir):
    return mixing.mix(documents(spark, sf_dir).select("doc_id", "text", "source")).select(
        "doc_id", "_mix.size", "_mix.source_size", "_mix.target", "_mix.taken"
    )


ORACLES["op4_mixing"] = r"""
WITH d AS (
    SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k,
           CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS ss,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
    FROM d GROUP BY source
), l AS (
    SELECT *, 3 * ss <= w * ((SELECT sum(ss) FROM s) - before) / ((SELECT sum(w) FROM s) - w_before) AS capped
    FROM (SELECT *, coalesce(sum(3 * ss) OVER o, 0) AS before, coalesce(sum(w) OVER o, 0) AS w_before FROM s
          WINDOW o AS (ORDER BY 3 * ss / w, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
), t AS (
    SELECT source, ss,
           CASE WHEN capped THEN CAST(3 * ss AS DOUBLE)
                ELSE CAST(w * ((SELECT sum(ss) FROM s) - (SELECT coalesce(sum(3 * ss), 0) FROM l WHERE capped)) AS DOUBLE)
                     / CAST((SELECT sum(w) FROM l WHERE NOT capped) AS DOUBLE) END AS target
    FROM l
), b AS (
    SELECT source, ss, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
           CASE WHEN ss > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // ss ELSE 0 END AS epochs
    FROM t
), p AS (
    SELECT d.doc_id, d.size, b.ss, b.target, b.epochs, b.budget - b.epochs * b.ss AS cut,
           CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS start
    FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, ss AS source_size, target,
       CAST(epochs * size + greatest(0, least(size, cut - start)) AS BIGINT) AS taken
FROM p
"""


@query
def op5_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language.fit(docs.filter(language.learnable(F.col("doc_id"))))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        F.col("_lang.lang").alias("lang_pred"),
        "_lang.score",
    )


@query
def op6_exact_dedup(spark, sf_dir):
    found = exact_dedup.exact_dedup(spark, f"{sf_dir}/documents.parquet")
    return found.select(
        F.col("at.id").alias("doc_id"),
        F.col("keeper.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("at") == F.col("keeper")).alias("kept"),
        "text_sha256",
    )


ORACLES["op6_exact_dedup"] = r"""
WITH d AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, h AS text_sha256
FROM d WINDOW w AS (PARTITION BY h)
"""


@query
def op7_paragraph_dedup(spark, sf_dir):
    found = paragraph_dedup.repeated_paragraphs(documents(spark, sf_dir))
    return found.withColumnsRenamed({"id": "doc_id", "class_id": "first_doc_id", "class_paragraph": "first_paragraph"})


@query
def op8_ppm(spark, sf_dir):
    docs = documents(spark, sf_dir).select("doc_id", "text")
    left = remainder(F.col("doc_id"), 7) == 2
    scored = ppm.score_documents(docs, F.coalesce(~left, F.lit(False)))
    held = F.coalesce(left, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held, *[f"_lm.{c}" for c in ppm.COLUMNS])


@query
def op9_line_dedup(spark, sf_dir):
    found = line_dedup.line_dedup(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("_lines.lines").alias("n_lines"),
        F.col("_lines.gone").alias("removed_lines"),
        F.col("_lines.partners").alias("repeats_of"),
        "text",
    )


@query
def op10_bpe(spark, sf_dir):
    import public_tokenizers

    codec = bpe.Codec(spark, public_tokenizers.path("byte_bpe_50k.json"))
    coded = codec.round_trip(documents(spark, sf_dir).select("doc_id", "text"), "text", "ids", "decoded")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        exact_dedup.sha256(bpe.ids_text(F.col("ids"))).alias("ids_sha256"),
        exact_dedup.sha256(F.col("decoded")).alias("decoded_sha256"),
    )


@query
def op11_setjoin(spark, sf_dir):
    return setjoin.near_duplicates(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@query
def op12_repair(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = repair.Repair(repair.damaged(conversations), conversations).digests()
    return found.withColumnRenamed("conv", "conv_id")


@query
def op13_alignment(spark, sf_dir):
    import public_tokenizers

    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    found = alignment.aligned_counts(documents(spark, sf_dir), *paths, whole=False)
    return found.withColumnsRenamed({"id": "doc_id", "groups": "groups_sha256"})
