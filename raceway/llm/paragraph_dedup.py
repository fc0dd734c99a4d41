"""Substring de-duplication: paragraphs banded by MinHash, verified by exact Jaccard, clustered."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from raceway.llm.common import discard, shipped, staged
from raceway.llm.components import components
from raceway.llm.simhash import LOWER

#: Words per shingle, least similarity of linked paragraphs, least words of a paragraph that counts.
SHINGLE, SIMILAR, LEAST = 5, 0.8, 5
#: Bands of rows each: paragraphs as similar as SIMILAR share a band with probability 0.9992.
BANDS, ROWS = 10, 3
#: Bytes of text worked on at once.
RUN = 1_000_000
#: 64-bit words of a set's bitmap.
WORDS = 8


def _draws() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11)
    odd = draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(paragraphs: list[list[bytes]], known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words of each paragraph, and where each paragraph's begin.

    Every paragraph has five words at least. ``known`` keeps the hashes of words met before.
    """
    import xxhash

    for word in {w for p in paragraphs for w in p}.difference(known):
        known[word] = xxhash.xxh64_intdigest(word)
    words = np.fromiter((known[w] for p in paragraphs for w in p), np.uint64)
    code = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
    for k in range(SHINGLE):
        code = _mixed(code * np.uint64(3) + words[k : len(words) - SHINGLE + 1 + k])
    sizes = np.array([len(p) for p in paragraphs], np.int64)
    real = np.ones(len(code), bool)  # runs across the end of a paragraph are none
    ends = np.cumsum(sizes)[:-1]
    for back in range(1, SHINGLE):
        real[ends - back] = False
    return code[real], np.r_[0, np.cumsum(sizes - SHINGLE + 1)[:-1]]


def signatures(paragraphs: list[list[bytes]], known: dict[bytes, int]) -> np.ndarray:
    """Band keys per paragraph: a hash of the band's number and its minima."""
    code, starts = shingles(paragraphs, known)
    odd, shift = _draws()
    keys = np.zeros((len(paragraphs), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(paragraphs), band, np.uint64)
        for row in range(band * ROWS, (band + 1) * ROWS):
            key = _mixed(key * np.uint64(3) + np.minimum.reduceat(_mixed(code * odd[row] + shift[row]), starts))
        keys[:, band] = key
    return keys.astype(np.int64)


def _split(text: str | None) -> Iterator[tuple[int, int, bytes]]:
    """Number, first character and bytes of each line."""
    start = 0
    for number, line in enumerate((text or "").split("\n")):
        yield number, start, line.encode().translate(LOWER)
        start += len(line) + 1


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple]]:
    """Paragraphs that are long enough, as (id, number, start, length, bytes, words), in runs."""
    run, size = [], 0
    for batch in batches:
        for doc_id, text in zip(batch.id, batch.text):
            for number, start, line in _split(text):
                words = line.split()
                if len(words) >= LEAST:
                    run.append((doc_id, number, start, len(line.decode()), line, words))
                    size += len(line)
                    if size >= RUN:
                        yield run
                        run, size = [], 0
    if run:
        yield run


def _node(words: list[bytes]) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)


def _kept(known: dict) -> dict:
    if len(known) > 300_000:
        known.clear()
    return known


def _banded(least: float):
    """Paragraphs with their bands. A set too small to be similar to any but an equal one, which is one node, has none."""
    words = SHINGLE - 1 + least / (1 - least) - 1e-9 if least < 1 else np.inf

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[bytes, int] = {}
        for found in _runs(batches):
            keys = signatures([r[5] for r in found], _kept(known))
            yield pd.DataFrame({
                "id": pd.array([r[0] for r in found], "Int64"), "paragraph": [r[1] for r in found],
                "start": [r[2] for r in found], "length": [r[3] for r in found],
                "node": [_node(r[5]) for r in found],
                "bands": [k if len(r[5]) >= words else k[:0] for k, r in zip(keys, found)],
            })

    return run


def bitmaps(code: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per paragraph a bitmap in which each shingle sets one bit."""
    owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(code)]))
    bits = np.zeros((len(starts), 64 * WORDS), bool)
    bits[owner, (_mixed(code) % np.uint64(64 * WORDS)).astype(np.int64)] = True
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[bytes, int] = {}
    for run in _runs(batches):
        code, starts = shingles([r[5] for r in run], _kept(known))
        parts = [np.unique(p) for p in np.split(code.astype(np.int64), starts[1:])]
        yield pd.DataFrame({
            "node": [_node(r[5]) for r in run], "set": parts, "size": list(map(len, parts)),
            "bits": list(bitmaps(code, starts)),
        })


def _may_be_similar(least: float) -> Column:
    """Whether two sets, by size and bitmap, can have Jaccard similarity ``least``; never wrong with no.

    Every bit in which the bitmaps differ stems from a shingle that one set lacks, and similar sets
    lack few: with J = least, (1 - J) / (1 + J) of the sum of their sizes.
    """
    differ = sum(
        (F.bit_count(F.col("x.bits")[k].bitwiseXOR(F.col("y.bits")[k])) for k in range(WORDS)), F.lit(0)
    )
    return differ <= (F.col("x.size") + F.col("y.size")) * ((1 - least) / (1 + least)) + 1e-9


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs ``(a, b)`` whose shingle sets have Jaccard similarity ``least`` or more."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (
        pairs.distinct().join(left, "a").join(right, "b")
        .filter(both >= least * (F.size("x") + F.size("y") - both)).select("a", "b")
    )


def repeated_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR
) -> DataFrame:
    """Paragraphs of ``docs`` that occur more than once, exactly or nearly.

    One row per occurrence: id, paragraph (line number), start and length in characters, class_id
    and class_paragraph (id and line of the class's first occurrence), class_size, removed (all but
    the first occurrence). Paragraphs are lines of five words or more, with A-Z lower-cased and white
    space evened out; equal ones are one node (a 64-bit hash). Nodes that share a band are verified
    by the Jaccard similarity of their five-word shingles, and linked ones form components.

    In each bucket all nodes are first compared with the one that occurs most. Only buckets that then still
    hold several components are looked at again, and there only nodes outside the bucket's largest
    component are compared, with those of other components: links inside a component add nothing,
    so none that matters is lost, and a bucket of thousands alike costs one comparison each.

    NULL and empty texts have no paragraphs. Of one id, occurrences are ordered by line number.
    NULL ids come last. Other columns are not read.
    """
    shipped(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    made: list[str] = []  # folders that nothing reads once the links are found
    seen = staged(
        rows.mapInPandas(
            _banded(similar), "id long, paragraph int, start long, length long, node long, bands array<long>"
        ),
        "paragraphs",
    )
    # One row per different paragraph before any is multiplied by its bands.
    nodes = staged(
        seen.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.first("bands").alias("bands")).filter(F.size("bands") > 0),
        "paragraph-nodes", made,
    )
    buckets = nodes.select("node", "n", F.explode("bands").alias("band"))
    # Which of equally frequent nodes is taken changes the pairs compared, not the components.
    reps = buckets.groupBy("band").agg(F.max_by("node", "n").alias("rep"), F.count(F.lit(1)).alias("nodes"))
    members = staged(
        buckets.join(reps.filter("nodes > 1").select("band", "rep"), "band").select("node", "band", "rep"),
        "paragraph-buckets", made,
    )
    compared = members.select("node").distinct()
    # Texts are read again only for what shares a bucket; a node's words are the same everywhere.
    wanted = seen.join(compared, "node", "left_semi").groupBy("node").agg(F.min(F.struct("id", "paragraph")).alias("at"))
    places = wanted.select("node", F.col("at.id").alias("id")).filter("id IS NOT NULL")
    holders = rows.join(places.select("id").distinct(), "id", "left_semi").unionByName(rows.filter("id IS NULL"))
    sets = staged(
        holders.mapInPandas(_sets, "node long, set array<long>, size int, bits array<long>").join(compared, "node", "left_semi")
        .dropDuplicates(["node"]),
        "paragraph-sets", made,
    )
    known = sets.select("node", "size", "bits")
    spokes = members.filter("node <> rep").select(F.col("node").alias("a"), F.col("rep").alias("b")).distinct()
    x, y = known.withColumnRenamed("node", "a").alias("x"), known.withColumnRenamed("node", "b").alias("y")
    stars = spokes.join(x, "a").join(y, (F.col("y.b") == spokes["b"]) & _may_be_similar(similar)).select(
        "a", F.col("y.b").alias("b")
    )
    first = staged(_verified(stars, sets, similar), "paragraph-links", made)
    roots = components(first)
    rooted = staged(
        members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "paragraph-roots", made
    )
    sizes = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("n"))
    open_ = sizes.groupBy("band").agg(
        F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("roots")
    ).filter("roots > 1").select("band", F.col("top.root").alias("top"))
    left = staged(rooted.join(open_, "band").join(known, "node"), "paragraph-open", made)
    x, y = left.filter("root <> top").alias("x"), left.alias("y")
    # The most frequent node of a bucket was compared with all others already.
    more = x.join(
        y,
        (F.col("x.band") == F.col("y.band")) & (F.col("x.root") != F.col("y.root"))
        & (F.col("x.node") != F.col("x.rep")) & (F.col("y.node") != F.col("y.rep")) & _may_be_similar(similar),
    ).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
    links = first.unionByName(_verified(more, sets, similar))
    classes = components(links)
    discard(docs.sparkSession, made)
    occurrences = staged(
        seen.drop("bands").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
        .withColumn("at", F.struct(F.col("id").isNull().alias("no"), "id", "paragraph")),
        "paragraph-classes",
    )
    whole = occurrences.groupBy("root").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("class_size")
    ).filter("class_size > 1")
    return occurrences.join(whole, "root").select(
        "id", "paragraph", "start", "length",
        F.col("first.id").alias("class_id"), F.col("first.paragraph").alias("class_paragraph"), "class_size",
        (F.col("at") != F.col("first")).alias("removed"),
    )
