"""Two tokenizations of one text aligned by divide and conquer at their shared cuts."""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from raceway.llm.batches import slices
from raceway.llm.bpe import byte_letters
from raceway.llm.common import shipped, staged

#: Bytes of text worked on at once; distinct links a task holds before it passes their counts on.
RUN, HELD = 400_000, 1_000_000
#: Most linked id pairs that are sent to every worker, picked by count; a join finds the rest.
PAIRS = 1 << 20
#: A linked pair as one number: A id, then B id in the low bits.
LOW = 20
#: Before a space after a letter both encodings have an end: A's words begin there, and no piece of B goes on.
WORD = re.compile(r"(?<=\S)(?= )")
#: Stretches encoded together, and letters of the stretches that a worker remembers.
MANY, KEPT = 4000, 12_000_000
#: Most tokens of a stretch whose shape is remembered, and most shapes that a worker remembers.
SHORT, SHAPES = 32, 100_000

Group = tuple[int, int, int, int]
#: n_a, n_b, n_groups, groups as text and linked pairs (64-bit numbers) of a stretch of text.
Stretch = tuple[int, int, int, str, bytes]


class Tokenizers:
    """The two encoders, the bytes of each of their tokens, and stretches aligned before. One per worker."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one worker per core already
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = {c: n for n, c in enumerate(byte_letters())}
        entries = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(entries.values(), default=-1) + 1)
        for token, i in entries.items():
            self.bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = ([*map(len, t)] for t in (self.bytes_a, self.bytes_b))
        self.apart = not any(re.search("[^▁]▁", self.b.id_to_piece(i)) for i in range(len(self.bytes_b)))
        self.known: dict[str, Stretch | None] = {}
        self.shapes: dict[tuple[int, ...], Shape] = {}
        self.letters = 0

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    def _encoded(self, stretches: list[str]) -> list[list[int]]:
        """A's ids of each stretch.

        As A's words begin before a space after a letter, all stretches that end in a letter are encoded as one
        text. Where tokens spell another text or run over an end, each is encoded alone.
        """
        joint = [s for s in stretches if not s[-1].isspace()]
        text, found = "".join(joint), {}
        ids = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        if joint and b"".join(map(self.bytes_a.__getitem__, ids)) == text.encode():
            ends = np.cumsum(np.fromiter(map(self.size_a.__getitem__, ids), np.int64, len(ids)))
            cuts = np.cumsum(np.fromiter((len(s.encode()) for s in joint), np.int64, len(joint)))
            at = np.searchsorted(ends, cuts)
            if np.array_equal(ends[at], cuts):
                edges = [0, *(at + 1).tolist()]
                found = {s: ids[i:j] for s, i, j in zip(joint, edges, edges[1:])}
        rest = [s for s in stretches if s not in found]
        found.update(zip(rest, (e.ids for e in self.a.encode_batch_fast(rest, add_special_tokens=False))))
        return [found[s] for s in stretches]

    def _learn(self, stretches: list[str]) -> None:
        """Align stretches that each begin with the space that B puts itself; None where tokens spell another text."""
        token_a, token_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        encoded_b = self.b.encode([s[1:] for s in stretches], num_threads=1)
        for text, a, b in zip(stretches, self._encoded(stretches), encoded_b):
            b = b or [self.b.piece_to_id("▁")]
            spelled_a, spelled_b = b"".join(map(token_a, a)), b"".join(map(token_b, b))
            found = self._stretch(a, b) if spelled_a == text.encode() == spelled_b else None
            self.known[text], self.letters = found, self.letters + len(text)

    def _stretch(self, a: list[int], b: list[int]) -> Stretch:
        sizes_a, sizes_b = [*map(self.size_a.__getitem__, a)], [*map(self.size_b.__getitem__, b)]
        if len(a) + len(b) > SHORT:
            return aligned(a, b, sizes_a, sizes_b)
        key = (len(a), *sizes_a, *sizes_b)
        shape = self.shapes.get(key)
        if shape is None:
            if len(self.shapes) >= SHAPES:
                self.shapes = {}
            shape = self.shapes[key] = Shape(sizes_a, sizes_b)
        return shape.filled(a, b)

    def align(self, texts: list[str | None]) -> list[list[Stretch]]:
        """The aligned stretches of each text; none where the tokens do not spell a space and the text."""
        if self.letters > KEPT:
            self.known, self.letters = {}, 0
        cut = [(WORD.split(" " + t) if self.apart else [" " + t]) if t else [] for t in texts]
        new = list(set().union(*cut).difference(self.known))
        for at in range(0, len(new), MANY):
            self._learn(new[at : at + MANY])
        found = [list(map(self.known.__getitem__, stretches)) for stretches in cut]
        return [[] if None in stretches else stretches for stretches in found]


def groups(ends_a: list[int], ends_b: list[int]) -> list[Group]:
    """``(a, a', b, b')``: runs of tokens between neighbouring shared ends, in order.

    An interval ends in a shared end. The shared end nearest its middle, by tokens of A, is looked for by
    bisecting the ends of B, and both sides are treated alike, the left one first; an interval without one is a group.
    """
    out, open_, a, a2, b, b2 = [], [], 0, len(ends_a), 0, len(ends_b)
    if not a2:
        return out
    while True:
        cut = -1
        if a2 - a > 1 and b2 - b > 1:
            i = middle = (a + a2 - 1) // 2
            for far in range(1, a2 - a + 1):
                if a <= i < a2 - 1:
                    end = ends_a[i]
                    cut = bisect_left(ends_b, end, b, b2 - 1)
                    if cut < b2 - 1 and ends_b[cut] == end:
                        break
                    cut = -1
                i = middle + (far + 1) // 2 if far & 1 else middle - far // 2
        if cut >= 0:
            open_.append((i + 1, a2, cut + 1, b2))
            a2, b2 = i + 1, cut + 1
            continue
        out.append((a, a2, b, b2))
        if not open_:
            return out
        a, a2, b, b2 = open_.pop()


def spelled(a: list[str], b: list[str], cut: list[Group]) -> str:
    """``a1,a2|b1;a3|b2,b3``: the groups' ids."""
    return ";".join([
        f"{a[i] if j - i == 1 else ','.join(a[i:j])}|{b[k] if l - k == 1 else ','.join(b[k:l])}" for i, j, k, l in cut
    ])


def links(a: list[int], b: list[int], ends_a: list[int], ends_b: list[int], cut: list[Group]) -> list[int]:
    """The id pair, as one number, of each two tokens that overlap, once: by going along both encodings in each group."""
    out: list[int] = []
    for i, i2, j, j2 in cut:
        here = a[i] << LOW
        if i2 - i == 1:  # one token overlaps all of the other side
            if j2 - j == 1:
                out.append(here | b[j])
            else:
                out += [here | y for y in b[j:j2]]
        elif j2 - j == 1:
            y = b[j]
            out += [x << LOW | y for x in a[i:i2]]
        else:
            while True:
                out.append(a[i] << LOW | b[j])
                if ends_a[i] < ends_b[j]:
                    i += 1
                elif j + 1 < j2:  # no end inside a group is shared
                    j += 1
                else:
                    break
    return out


def aligned(a: list[int], b: list[int], sizes_a: list[int], sizes_b: list[int]) -> Stretch:
    """A stretch from its token ids and their bytes."""
    ends_a, ends_b = [*accumulate(sizes_a)], [*accumulate(sizes_b)]
    cut = groups(ends_a, ends_b)
    text = spelled([*map(str, a)], [*map(str, b)], cut)
    return len(a), len(b), len(cut), text, array("q", links(a, b, ends_a, ends_b, cut)).tobytes()


class Shape:
    """The alignment of all stretches whose tokens have the same bytes, but for their ids.

    Where tokens end says which are grouped and linked, so it is worked out once for many stretches.
    """

    __slots__ = ("sizes", "text", "order", "pairs")

    def __init__(self, sizes_a: list[int], sizes_b: list[int]) -> None:
        n_a, n_b = len(sizes_a), len(sizes_b)
        ends_a, ends_b = [*accumulate(sizes_a)], [*accumulate(sizes_b)]
        cut = groups(ends_a, ends_b)
        self.sizes = n_a, n_b, len(cut)
        self.text = spelled(["%d"] * n_a, ["%d"] * n_b, cut)
        self.order = itemgetter(*[k for i, j, k2, l in cut for k in (*range(i, j), *range(n_a + k2, n_a + l))])
        numbered = links([*range(n_a)], [*range(n_b)], ends_a, ends_b, cut)
        self.pairs = [(p >> LOW, p & (1 << LOW) - 1) for p in numbered]

    def filled(self, a: list[int], b: list[int]) -> Stretch:
        pairs = array("q", [a[i] << LOW | b[j] for i, j in self.pairs])
        return *self.sizes, self.text % self.order(a + b), pairs.tobytes()


def _int_lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.r_[0, np.cumsum([len(p) for p in parts])].astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*parts, np.zeros(0, np.int64)]).astype(np.int64)))


ALIGNED = "id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
_MADE: dict[tuple[str, str], Tokenizers] = {}


def _aligned(paths: tuple[str, str], whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if paths not in _MADE:
            _MADE[paths] = Tokenizers(*paths)
        both = _MADE[paths]
        for batch in batches:
            for part in slices(batch, 1, RUN):
                rows: list[tuple] = []
                for found in both.align(part.column(1).to_pylist()):
                    a, b, cut, parts, pairs = zip(*found) if found else ((),) * 5
                    text = ";".join(parts)
                    text = text if whole or not found else hashlib.sha256(text.encode()).hexdigest()
                    pairs = np.frombuffer(b"".join(pairs), np.int64)
                    rows.append((sum(a), sum(b), sum(cut), len(pairs), text, *np.unique(pairs, return_counts=True)))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string()),
                        _int_lists(list(columns[5])), _int_lists(list(columns[6])),
                    ],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"],
                )

    return run


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", whole: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, groups, pairs, times.

    ``groups`` lists the ids of each group, ``a1,a2|b1;a3|b2,b3`` (its SHA-256 unless ``whole``); ``pairs``
    holds the distinct linked ids, A id times 2^20 plus B id, and ``times`` how many links of the text each has.

    A is a byte-level file of the tokenizers library, which reads a space and the text; B a
    sentencepiece model, which reads the text and puts the space itself. NULL and empty texts, and those
    whose tokens do not spell space and text, have no tokens: zeros and ''. The strings of special tokens
    are plain text. Where both are known to end, before a space after a letter, a text is cut first; each different
    stretch is then aligned by divide and conquer, once for all whose tokens have the same bytes in length, while a worker
    remembers it. Repeated rows and NULL ids are rows like others; other columns are not read.
    """
    shipped(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return texts.mapInArrow(_aligned((path_a, path_b), whole), ALIGNED)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per linked pair, summed within the task as far as memory allows."""
    pairs, times = [], []

    def summed() -> tuple[np.ndarray, np.ndarray]:
        unique, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
        return unique, np.bincount(inverse, weights=np.concatenate(times)).astype(np.int64)

    for batch in batches:
        pairs.append(batch.column(0).flatten().to_numpy())
        times.append(batch.column(1).flatten().to_numpy())
        if sum(map(len, pairs)) > 2 * HELD:
            pair, n = summed()
            pairs, times = [pair], [n]
            if len(pair) > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])
                pairs, times = [], []
    if pairs:
        pair, n = summed()
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: links of each id pair over all texts; whether no pair of its B id has more."""
    counted = aligned.select("pairs", "times").mapInArrow(_count, "pair long, n long").groupBy("pair").agg(
        F.sum("n").alias("n")
    )
    counted = staged(counted.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << LOW) - 1))), "alignment-counts")
    # One row per entry of B's vocabulary, so its size does not grow with the texts.
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _least_count(counts: DataFrame, room: int) -> int:
    """The least count that no more than ``room`` pairs reach, to a quarter of a power of two."""
    bins = counts.groupBy(F.floor(4 * F.log2("n")).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    total, least = 0, 1
    for row in bins.orderBy(F.desc("bin")).collect():
        total += row.rows
        if total > room:
            return int(np.ceil(2 ** ((row.bin + 1) / 4) - 1e-9))
    return least


def _weighed(model):
    """Sums over a text's links of their pairs' counts, and what the broadcast pairs leave open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = model.value
        for batch in batches:
            names = batch.schema.names
            for part in slices(batch, names.index("pairs"), HELD):
                lists = part.column(names.index("pairs"))
                pairs, times = lists.flatten().to_numpy(), part.column(names.index("times")).flatten().to_numpy()
                sizes = np.diff(lists.offsets.to_numpy())
                owner = np.repeat(np.arange(len(sizes)), sizes)
                at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
                hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
                at, got = at[hit], owner[hit]
                sums = np.zeros((2, len(sizes)), np.int64)
                np.add.at(sums[0], got, n[at] * times[hit])
                np.add.at(sums[1], got, best[at] * times[hit])
                missed = np.r_[0, np.cumsum(np.bincount(owner[~hit], minlength=len(sizes)))].astype(np.int32)
                rest = pa.StructArray.from_arrays([pa.array(pairs[~hit]), pa.array(times[~hit])], names=["pair", "times"])
                kept = [c for k, c in enumerate(part.columns) if names[k] not in ("pairs", "times")]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(missed, rest)],
                    names=[*(c for c in names if c not in ("pairs", "times")), "count_sum", "n_best", "open"],
                )

    return run


def weigh(aligned: DataFrame, room: int = PAIRS) -> DataFrame:
    """``aligned`` with count_sum and n_best in place of pairs and times.

    A pair's count is the number of links that hold it, over all texts. ``count_sum`` adds it up over a
    text's links; ``n_best`` counts the links whose pair no other pair of the same B id exceeds. Up to ``room``
    of the most frequent pairs are looked up in the worker, all others by a join, so the result does not depend
    on it. ``aligned`` must be stored, as it is read twice.
    """
    spark: SparkSession = aligned.sparkSession
    counts = staged(pair_counts(aligned), "alignment-pairs")
    least = _least_count(counts, room)
    frequent = counts.filter(F.col("n") >= least).toArrow()
    pair, n, best = (frequent.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pair)
    model = spark.sparkContext.broadcast((pair[order], n[order], best[order].astype(np.int64)))
    rows = aligned.withColumn("row", F.monotonically_increasing_id())
    plain = [c for c in rows.columns if c not in ("pairs", "times")]
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in plain)
    weighed = staged(
        rows.mapInArrow(_weighed(model), f"{schema}, count_sum long, n_best long, open array<struct<pair: long, times: long>>"),
        "alignment-weighed",
    )
    rare = weighed.select("row", F.explode("open").alias("at")).select("row", "at.pair", "at.times")
    found = rare.join(counts.filter(F.col("n") < least), "pair").groupBy("row").agg(
        F.sum(F.col("n") * F.col("times")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    more = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).alias(c)
    return weighed.join(found, "row", "left").select(
        *(c for c in plain if c != "row"), more("count_sum", "more_sum"), more("n_best", "more_best")
    )


def aligned_counts(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", whole: bool = True) -> DataFrame:
    """``align``, stored, and then ``weigh``."""
    return weigh(staged(align(docs, path_a, path_b, id_col, text_col, whole), "alignment"))
