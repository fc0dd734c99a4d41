"""Line de-duplication by aligning pairs of documents that share rare lines."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from raceway.llm.common import WORD, discard, plain, position, restored, shipped, staged

#: A line is rare if at most so many different texts hold it; one shared rare line makes a pair.
RARE = 10
#: Words in a run of lines, or in all lines shared with one earlier holder, that make a pair, however many texts hold them.
WORDS = 20
#: Lines of any kind that make a pair when a text shares them with one earlier holder.
COMMON = 3
#: A line of fewer letters neither pairs documents nor is deleted without a longer neighbour.
LONG = 20
#: Base of the hash of a run; as an odd number it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15


def runs(lines: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of the shortest runs of several lines with ``WORDS`` words, one run from each line on.

    Lines without words are passed over. A run's hash depends on its lines only, wherever it stands.
    """
    spoken = words > 0
    lines, words = lines[spoken].view(np.uint64), words[spoken].astype(np.int64)
    ends = np.cumsum(words)
    after = np.searchsorted(ends, ends - words + WORDS) + 1
    starts = np.flatnonzero((after <= len(lines)) & (words < WORDS))
    power, inverse = (np.cumprod(np.full(len(lines), b, np.uint64)) for b in (BASE, pow(BASE, -1, 1 << 64)))
    sums = np.append(np.zeros(1, np.uint64), np.cumsum(lines * power))
    return np.unique((sums[after[starts]] - sums[starts]) * inverse[starts]).view(np.int64)


def _anchors(a: list[int], b: list[int], ax: int, ay: int, bx: int, by: int) -> list[tuple[int, int]]:
    """Longest rising run of lines that are unique in both stretches, as positions."""
    left, right = Counter(a[ax:ay]), Counter(b[bx:by])
    at = {line: i for i, line in enumerate(a[ax:ay], ax) if left[line] == 1 and right.get(line) == 1}
    pairs = [(at[line], j) for j, line in enumerate(b[bx:by], bx) if line in at]
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (i, _) in enumerate(pairs):
        place = bisect_left(tops, i)
        back.append(ends[place - 1] if place else -1)
        tops[place:], ends[place:] = [i, *tops[place + 1 :]], [k, *ends[place + 1 :]]
    run, k = [], ends[-1] if ends else -1
    while k >= 0:
        run.append(pairs[k])
        k = back[k]
    return run[::-1]


def patience(a: list[int], b: list[int]) -> list[int]:
    """Positions in ``b`` of the lines that a patience diff aligns with lines of ``a``."""
    kept: list[int] = []
    stretches = [(0, len(a), 0, len(b))]
    while stretches:
        ax, ay, bx, by = stretches.pop()
        while ax < ay and bx < by and a[ax] == b[bx]:
            kept.append(bx)
            ax, bx = ax + 1, bx + 1
        while ax < ay and bx < by and a[ay - 1] == b[by - 1]:
            ay, by = ay - 1, by - 1
            kept.append(by)
        if ax == ay or bx == by:
            continue
        run = _anchors(a, b, ax, ay, bx, by)
        if not run:
            continue
        for i, j in [*run, (ay, by)]:
            stretches.append((ax, i, bx, j))
            ax, bx = i, j
            if (i, j) != (ay, by):
                kept.append(j)
                ax, bx = i + 1, j + 1
    return sorted(kept)


def common_blocks(earlier: list[int], later: list[int]) -> list[int]:
    """Lines of ``later`` in aligned blocks that hold a long line. Hashes of long lines are odd."""
    out: list[int] = []
    block: list[int] = []
    for i in [*patience(earlier, later), -1]:
        if block and i != block[-1] + 1:
            if any(later[k] & 1 for k in block):
                out += block
            block = []
        block.append(i)
    return out


@F.pandas_udf(T.ArrayType(T.LongType()))
def _runs(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for lines, words in batches:
        yield pd.Series([runs(a, b) for a, b in zip(lines, words)], dtype=object)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _aligned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for earlier, later in batches:
        yield pd.Series([common_blocks(a.tolist(), b.tolist()) for a, b in zip(earlier, later)], dtype=object)


@F.pandas_udf(T.StringType())
def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The text less its lines with the given numbers."""
    for texts, gone in batches:
        out = []
        for text, lines in zip(texts, gone):
            drop = set() if lines is None else set(lines.tolist())
            out.append(text if not drop else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in drop))
        yield pd.Series(out, dtype=object)


def _place() -> Column:
    """Order of documents: ascending id with NULL last, then text hash."""
    return F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("id"), F.col("h").alias("h"))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(h, first, lines, gone, partners)`` per different text of ``docs``, stored.

    ``h`` is the text's hash, ``first`` the earliest document with it. ``gone`` are the numbers of
    its lines that repeat earlier documents, ``partners`` those documents' ids. Copies of a text
    are one class, so groups of copies are not compared with each other.

    Each long line, and each run of lines of ``WORDS`` words, is tied to its earliest holder, so one
    in most documents gives one link per document. A text and an earlier one are aligned if they share a run,
    a rare line, several lines, or lines of as many words. A block of ``WORDS`` words or more is thus found however many
    texts hold it, and wherever each of its runs was first seen.
    Hashes are 64-bit; the lowest bit of a line's says whether the line is long.
    """
    shipped(docs.sparkSession)
    made: list[str] = []
    body = F.coalesce(F.col(text_col), F.lit(""))
    split = F.split(body, "\n")
    line = lambda x: F.xxhash64(x).bitwiseAND(F.lit(-2)) + (F.char_length(x) >= LONG).cast("long")
    count = lambda x: F.regexp_count(x, F.lit(WORD))
    whole = lambda x: F.struct(line(x).alias("key"), F.lit(False).alias("run"), count(x).alias("words"))
    long = F.array_distinct(F.filter(split, lambda x: F.char_length(x) >= LONG))
    texts = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(body).alias("h"), F.transform(split, line).alias("lines"),
        F.transform(split, count).alias("words"), F.transform(long, whole).alias("long"),
    )
    first = texts.groupBy("h").agg(F.min(_place()).alias("first"))
    rows = staged(
        texts.join(first, "h").filter(_place() == F.col("first")).dropDuplicates(["h"])
        .select("h", "first", "lines", "words", "long"),
        "line-texts", made,
    )
    several = F.transform(_runs("lines", "words"), lambda x: F.struct(x.alias("key"), F.lit(True).alias("run"), F.lit(WORDS).alias("words")))
    held = rows.select("h", "first", several.alias("several"), "long").select("h", "first", F.inline(F.concat("long", "several")))
    # Grouped by one column more than the join needs, so that an exchange lies between the two and a hot key can be split.
    shared = held.groupBy("key", F.xxhash64("key").alias("apart")).agg(
        F.min("first").alias("earliest"), F.count(F.lit(1)).alias("n")
    ).filter("n > 1").drop("apart")
    links = held.join(shared, "key").filter("first <> earliest")
    pairs = links.groupBy("h", F.col("earliest.h").alias("g")).agg(
        F.count_if(~F.col("run") & (F.col("n") <= RARE)).alias("rare"), F.count_if(~F.col("run")).alias("lines"),
        F.sum("words").alias("words"),
    ).filter((F.col("rare") > 0) | (F.col("lines") >= COMMON) | (F.col("words") >= WORDS)).select("h", "g")
    later = rows.select("h", F.col("lines").alias("later"))
    earlier = rows.select(F.col("h").alias("g"), F.col("lines").alias("earlier"), F.col("first.id").alias("partner"))
    aligned = staged(
        pairs.join(later, "h").join(earlier, "g").select("h", "partner", _aligned("earlier", "later").alias("block")),
        "line-blocks", made,
    )
    per_text = aligned.filter(F.size("block") > 0).groupBy("h").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("block")))).alias("gone"),
        F.array_sort(F.collect_set("partner")).alias("partners"),
    )
    found = staged(
        rows.select("h", "first", F.size("lines").alias("lines")).join(per_text, "h", "left"), "line-removals"
    )
    discard(docs.sparkSession, made)
    return found


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "_lines"
) -> DataFrame:
    """``docs`` with the text less its repeated lines, and a struct ``out``: lines, gone, partners, text.

    A later copy of a whole text loses all its lines. The earliest document of any lines keeps them.
    Documents are ordered by id, NULL last, then by text hash; rows that repeat id and text are one
    document, and keep the same lines. NULL texts stay NULL, empty ones empty. ``gone`` holds line
    numbers from 0; ``text`` is the text before. Other columns pass through, whatever their names, except one
    called ``out``.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} is taken")
    at, kept = position(docs, text_col), plain(docs)
    doc, text = f"c{position(docs, id_col)}", F.col(f"c{at}")
    body = F.coalesce(text, F.lit(""))
    rows = kept.withColumn("h", F.xxhash64(body)).join(removals(kept, doc, f"c{at}"), "h")
    copy = ~F.col(doc).eqNullSafe(F.col("first.id")) & (body != "")
    gone = F.when(copy, F.sequence(F.lit(0), F.col("lines") - 1)).otherwise(
        F.coalesce("gone", F.array().cast("array<int>"))
    )
    partners = F.when(copy, F.array(F.col("first.id"))).otherwise(
        F.coalesce("partners", F.array().cast(f"array<{kept.schema[doc].dataType.simpleString()}>"))
    )
    marked = rows.withColumns({"gone": gone, "partners": partners})
    # Only texts that lose a line go through Python.
    some = F.size("gone") > 0
    part = _without(F.when(some, text), F.when(some, F.col("gone")))
    columns = restored(docs)
    columns[at] = F.when(some, F.col("part")).otherwise(text).alias(docs.columns[at])
    return marked.withColumn("part", part).select(
        *columns, F.struct("lines", "gone", "partners", text.alias("text")).alias(out)
    )
