"""SimHash near-duplicates found by deletion-variant signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from raceway.llm.common import plain, position, restored, shipped, staged
from raceway.llm.components import components

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Most bits in which linked fingerprints differ.
DISTANCE = 3
#: Two segments, so that of three differing bits one segment holds at most one.
SEGMENT = 32
#: Fingerprints under one key that are still compared in pairs.
DENSE = 128
#: Hashes counted at once, which bounds memory for long texts.
BLOCK = 1 << 16


def simhash(text: str | None, size: int = 3) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without words. Signed 64-bit."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    last = (ends - 1).tolist()[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros(64, np.int64), len(last)
    for at in range(0, total, BLOCK):
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts[at : at + BLOCK], last[at : at + BLOCK])]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<i8")[0])


@F.pandas_udf(T.LongType())
def fingerprint(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([simhash(t) for t in batch], dtype="int64")


def differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segment(fp: Column, s: int) -> Column:
    return F.shiftrightunsigned(fp, SEGMENT * s).bitwiseAND(F.lit((1 << SEGMENT) - 1))


def variants(prints: DataFrame) -> DataFrame:
    """``(key, fp)``: each segment with each of its bits deleted, 64 keys per fingerprint.

    Segments that differ in at most one bit share the variant that deletes it.
    """
    keys = [
        _segment(F.col("fp"), s).bitwiseAND(F.lit(((1 << SEGMENT) - 1) ^ (1 << j)))
        .bitwiseOR(F.lit((s * SEGMENT + j) << SEGMENT))
        for s in range(64 // SEGMENT)
        for j in range(SEGMENT)
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _first_shared(a: Column, b: Column) -> Column:
    """Number of the first variant that two fingerprints share, so that a pair is made under one key."""
    out = F.lit(None).cast("long")
    for s in reversed(range(64 // SEGMENT)):
        apart = _segment(a, s).bitwiseXOR(_segment(b, s))
        # A single differing bit is its own position: count the bits below it.
        place = F.when(apart == 0, F.lit(0)).otherwise(F.bit_count(apart - 1)) + s * SEGMENT
        out = F.when(F.bit_count(apart) <= 1, place.cast("long")).otherwise(out)
    return out


def _pairs(keyed: DataFrame) -> DataFrame:
    """Linked pairs under the keys given, verified inside the join.

    Spark sizes exploded rows like the row they come from, 64 times too low, and would broadcast them.
    """
    a, b = keyed.alias("x"), keyed.alias("y").hint("merge")
    x, y = F.col("x.fp"), F.col("y.fp")
    return a.join(
        b,
        (F.col("x.key") == F.col("y.key")) & (x < y) & (differing(x, y) <= DISTANCE)
        & (_first_shared(x, y) == F.shiftrightunsigned(F.col("x.key"), SEGMENT)),
    ).select(x.alias("a"), y.alias("b"))


def _dense_links(keyed: DataFrame) -> DataFrame:
    """Links among fingerprints that share crowded keys, enough to join what belongs together.

    Two fingerprints at distance two or less meet in a value one bit away from both, which links
    each to the smallest that reaches it: 65 rows per fingerprint however many are alike. Pairs
    under a crowded key are then needed only across the components so found, and of those only
    the ones outside the key's largest component need partners.
    """
    prints = keyed.select("fp").distinct()
    near = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    balls = prints.select(F.explode(near).alias("value"), "fp")
    stars = staged(
        balls.join(balls.groupBy("value").agg(F.min("fp").alias("least")).hint("merge"), "value")
        .filter("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct(),
        "simhash-stars",
    )
    roots = components(stars).withColumnRenamed("node", "fp")
    placed = staged(
        keyed.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-dense"
    )
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("roots")
    ).filter("roots > 1").select("key", F.col("top.root").alias("top"))
    outside = placed.join(main, "key").filter("root <> top").alias("x")
    x, y = F.col("x.fp"), F.col("y.fp")
    across = outside.join(
        placed.alias("y").hint("merge"),
        (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root"))
        & (differing(x, y) <= DISTANCE),
    ).select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    return stars.unionByName(across)


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def links(prints: DataFrame, dense: int = DENSE) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all fingerprint pairs at distance 3 or less.

    ``prints`` holds distinct fingerprints ``fp``. Keys with up to ``dense`` fingerprints give all
    their linked pairs; the others are linked through common neighbours. No link is lost.
    """
    keyed = variants(prints)
    crowded = staged(
        keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > dense).select("key"),
        "simhash-crowded",
    )
    if crowded.isEmpty():
        return _pairs(keyed)
    loose = _pairs(keyed.join(crowded, "key", "left_anti"))
    tight = staged(keyed.join(crowded, "key", "left_semi"), "simhash-keys")
    return loose.unionByName(_dense_links(tight))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dense: int = DENSE
) -> DataFrame:
    """``(id, fp, component_id)`` per row of ``docs``; component_id is the smallest id reachable.

    NULL and empty texts have fingerprint 0 and link like others. Rows with equal fingerprints are
    one class, so copies are never paired. A NULL id counts as larger than any other; a component
    of NULL ids only has a NULL component_id. Other columns are not read.
    """
    shipped(docs.sparkSession)
    rows = staged(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col)).alias("fp")), "simhash")
    return rows.join(classes(rows, dense), "fp").select("id", "fp", "component_id")


def classes(rows: DataFrame, dense: int = DENSE) -> DataFrame:
    """``(fp, root, component_id)`` per distinct fingerprint of ``rows(id, fp)``."""
    prints = staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-prints")
    roots = components(links(prints.select("fp"), dense)).withColumnRenamed("node", "fp")
    rooted = staged(
        prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "simhash-roots"
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component: smallest id (NULL last), then smallest text digest.

    All columns pass through. Of rows that repeat each other exactly one stays. Each task first
    keeps its own best row per component, so a large component does not meet in one task.
    """
    shipped(docs.sparkSession)
    doc, text = F.col(f"c{position(docs, id_col)}"), F.col(f"c{position(docs, text_col)}")
    # Stored, as a join on the result of a Python function would call it once more to tell NULLs.
    rows = staged(plain(docs).withColumn("fp", fingerprint(text)), "simhash")
    root = classes(rows.select(doc.alias("id"), "fp")).select("fp", "root")
    first = Window.partitionBy("root").orderBy(doc.asc_nulls_last(), F.xxhash64(text), text)
    ranked = rows.join(root, "fp").withColumn("rank", F.row_number().over(first))
    return ranked.filter("rank = 1").select(*restored(docs))
