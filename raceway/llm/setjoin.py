"""Near-duplicates by a chosen-path set similarity join: trees that branch on minwise shingles, exact links."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from raceway.llm.batches import slices
from raceway.llm.common import discard, shipped, staged
from raceway.llm.components import components
from raceway.llm.simhash import LOWER

#: Words per shingle; least similarity of linked sets in per cent.
SHINGLE, SIMILAR = 4, 80
#: Independent trees, and branches of a node. Two sets of similarity 0.8 part in a node with probability
#: 0.2 ** BRANCHES = 0.04 and stay together through a tree of any depth with 0.9375, the solution of
#: q = (0.2 + 0.8 q) ** 2 for what is lost; four trees then miss one such pair in 65,000.
TREES, BRANCHES = 4, 2
#: Minwise shingles drawn per set, from which a node chooses the ones it branches on.
DRAWN = 64
#: Sets of a node outside its largest component up to which they are compared with the whole node.
FEW = 2048
#: Larger nodes are compared as well where branching would leave more than this share of their comparisons,
#: that is where their sets are alike on average, but not enough for a link.
SPARED = 0.7
#: Levels of branching after which whatever is left in a node is compared, in the same way.
DEPTH = 6
#: 64-bit words of a set's bitmap. Bitmaps of long sets are full; those are told apart by their sketches:
#: of the 64 drawn shingles APART may differ in their last four bits. Of two sets of similarity 0.8 more differ
#: less than once in 10 ** 8 times (binomial, 64 of 0.19), which the trees' own misses outweigh.
WORDS, APART = 16, 32
#: Bytes of text worked on at once; bits of the filter of wanted texts.
RUN, FILTER = 1_000_000, 1 << 26


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_sets(texts: list[str | None], known: dict[bytes, int], size: int = SHINGLE) -> list[np.ndarray]:
    """Ascending 64-bit hashes of each text's different shingles; fewer words make one, no words none."""
    split = [(t or "").encode().translate(LOWER).split() for t in texts]
    if len(known) > 300_000:
        known.clear()
    for word in {w for words in split for w in words}.difference(known):
        known[word] = xxhash.xxh64_intdigest(word)
    flat = np.fromiter((known[w] for words in split for w in words), np.uint64)
    chained = [flat]  # chained[k][i]: the run of k + 1 words that begins at i
    for k in range(1, size):
        chained.append(mixed(chained[-1][: max(len(flat) - k, 0)] * np.uint64(3) + flat[k:]))
    out, at = [], 0
    for words in split:
        run, many = min(size, len(words)), max(len(words) - size + 1, 1)
        out.append(np.unique(chained[run - 1][at : at + many]) if words else flat[:0])
        at += len(words)
    return out


def _draws() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(23)
    odd = draw.integers(0, 1 << 63, DRAWN, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return odd, draw.integers(0, 1 << 63, DRAWN, dtype=np.uint64)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """Per set the least value of each of ``DRAWN`` hash functions, as 32 bits. No set is empty."""
    flat, starts = mixed(np.concatenate(sets)), np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(sets), DRAWN), np.int32)
    for k, (odd, shift) in enumerate(zip(*_draws())):
        out[:, k] = (np.minimum.reduceat(flat * odd + shift, starts) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Per set a bitmap in which each shingle sets one bit."""
    bits = np.zeros((len(sets), 64 * WORDS), bool)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bits[owner, (mixed(np.concatenate(sets)) % np.uint64(64 * WORDS)).astype(np.int64)] = True
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")


def sketches(drawn: np.ndarray) -> np.ndarray:
    """The last four bits of the 64 drawn shingles, a 64-bit word for each of the four."""
    bits = (drawn[:, None, :] >> np.arange(4)[:, None]) & 1
    return np.packbits(bits.astype(bool), axis=2, bitorder="little").reshape(len(drawn), -1).view("<i8")


def _digest(codes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(codes.tobytes()) if len(codes) else None


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel(), kind))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    for batch in batches:
        for part in slices(batch, 1, RUN):
            sets = shingle_sets(part.column(1).to_pylist(), known)
            some = [s if len(s) else np.zeros(1, np.uint64) for s in sets]
            drawn = minwise(some)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), pa.array(map(_digest, sets), pa.binary()), pa.array(map(len, sets), pa.int64()),
                    _lists(drawn, pa.int32()), _lists(np.hstack([bitmaps(some), sketches(drawn)]), pa.int64()),
                ],
                names=["id", "digest", "size", "drawn", "bits"],
            )


def _sets(bits: object):
    """The sets of the rows whose id the broadcast filter holds; rows without an id always."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            wanted = bits.value
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            if batch.column(0).null_count:
                none = np.asarray(batch.column(0).is_null())
                ids = np.where(none, 0, np.nan_to_num(ids)).astype(np.int64)
            else:
                none = np.zeros(len(ids), bool)
            spot = mixed(ids.astype(np.int64).view(np.uint64)) & np.uint64(64 * len(wanted) - 1)
            held = (wanted[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1)
            for part in slices(batch.take(pa.array(np.flatnonzero(none | (held > 0)))), 1, RUN):
                sets = shingle_sets(part.column(1).to_pylist(), known)
                ends = np.r_[0, np.cumsum([len(s) for s in sets])].astype(np.int32)
                flat = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(_digest, sets), pa.binary()), pa.ListArray.from_arrays(ends, pa.array(flat))],
                    names=["digest", "codes"],
                )

    return run


def _spots(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Words of the filter in which this task's ids set bits."""
    held = np.zeros(size // 64, np.uint64)
    for batch in batches:
        spot = mixed(batch.column(0).to_numpy().view(np.uint64)) & np.uint64(size - 1)
        np.bitwise_or.at(held, (spot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (spot & np.uint64(63)))
    at = np.flatnonzero(held)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at].view(np.int64))], names=["at", "bits"])


def id_filter(ids: DataFrame, most: int = FILTER) -> np.ndarray:
    """A bitmap that has a bit set for each id of the one column, of ``most`` bits at the most.

    Ids that are not there may be let through, the more of them the fuller it is.
    """
    size = 1 << 10
    while size < min(16 * ids.count(), most):
        size *= 2
    words = ids.mapInArrow(lambda batches: _spots(batches, size), "at long, bits long")
    found = words.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def _may_link(similar: int) -> Column:
    """Whether x and y are worth comparing whole, by size, bitmap and sketch.

    Where the bitmaps differ, a set has a shingle that the other lacks, and of those similar sets
    have few: (1 - J) / (1 + J) of both sizes.
    """
    differ = [F.col(f"x.b{k}").bitwiseXOR(F.col(f"y.b{k}")) for k in range(WORDS + 4)]
    bits = reduce(Column.__add__, map(F.bit_count, differ[:WORDS]))
    apart = F.bit_count(reduce(Column.bitwiseOR, differ[WORDS:]))
    x, y = F.col("x.size"), F.col("y.size")
    near = bits * (100 + similar) <= (x + y) * (100 - similar)
    return (100 * F.least(x, y) >= similar * F.greatest(x, y)) & (apart <= APART) & near


class _Join:
    """One run: the nodes (different sets), and the component each is in so far."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, similar: int) -> None:
        self.docs, self.similar = docs, similar
        # A set of few shingles has no similar one but itself: one more makes it too different.
        self.nodes = nodes.filter(100 * F.col("size") >= similar * (F.col("size") + 1))
        # Plain columns: a join's condition over arrays is too much code for the JVM to compile.
        bits = [F.get("bits", F.lit(k)).alias(f"b{k}") for k in range(WORDS + 4)]
        self.looks = staged(self.nodes.select("node", "size", *bits), "setjoin-bits")
        self.roots: DataFrame | None = None
        #: Folders read by the next confirmation, and folders that nothing reads after this one.
        self.held: list[str] = []
        self.made: list[str] = []

    def rooted(self, rows: DataFrame) -> DataFrame:
        if self.roots is None:
            return rows.withColumn("root", F.col("node"))
        return rows.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def children(self, front: DataFrame | None) -> DataFrame:
        """``(parent, path, node, copies)``: where the members of the given tree nodes go, of the roots if none are given.

        A tree node chooses by a hash of its path on which of a set's minwise shingles it branches.
        """
        if front is None:
            trees = F.explode(F.array(*[F.xxhash64(F.lit("tree"), F.lit(t)) for t in range(TREES)]))
            rows = self.nodes.select("node", "copies", "drawn", trees.alias("path"))
        else:
            rows = front.join(self.nodes.select("node", "copies", "drawn"), "node")

        def child(b: int) -> Column:
            chosen = F.pmod(F.xxhash64("path", F.lit(b)), F.lit(DRAWN)).cast("int")
            return F.xxhash64("path", F.lit(b), F.get("drawn", chosen))

        paths = F.explode(F.array(*[child(b) for b in range(BRANCHES)]))
        return rows.select(F.col("path").alias("parent"), paths.alias("path"), "node", "copies")

    def members(self, children: DataFrame) -> DataFrame:
        """``(path, node, rep)`` of tree nodes with more than one component; ``rep`` has the most copies."""
        rows = self.rooted(children)
        held = rows.groupBy("path").agg(
            F.max(F.struct("copies", "node")).alias("top"), F.min("root").alias("low"), F.max("root").alias("high")
        ).filter("low <> high").select("path", F.col("top.node").alias("rep"))
        return staged(rows.join(held, "path").select("path", "node", "rep"), "setjoin-nodes", self.held)

    def alike(self, children: DataFrame) -> DataFrame:
        """Parents whose children have nearly as many pairs together as they have: sets in them do not part."""
        size = F.count(F.lit(1)).cast("double")
        pairs = children.groupBy("parent", "path").agg(size.alias("n")).groupBy("parent").agg(
            F.sum(F.col("n") * F.col("n")).alias("below"), (F.sum("n") / BRANCHES).alias("n")
        )
        return pairs.filter(F.col("below") > SPARED * F.col("n") * F.col("n")).select(F.col("parent").alias("path"))

    def stars(self, members: DataFrame) -> DataFrame:
        """Pairs of a tree node's members with its representative that may be links."""
        tied = self.rooted(members.filter("node <> rep").select("node", "rep").distinct())
        reps = self.rooted(members.select(F.col("rep").alias("node")).distinct())
        y = reps.select(F.col("node").alias("rep"), F.col("root").alias("other")).join(
            self.looks.withColumnRenamed("node", "rep"), "rep"
        )
        return tied.join(self.looks, "node").alias("x").join(
            y.alias("y"), (F.col("x.rep") == F.col("y.rep")) & (F.col("root") != F.col("other")) & _may_link(self.similar)
        ).select(F.least("x.node", "y.rep").alias("a"), F.greatest("x.node", "y.rep").alias("b"))

    def opened(self, members: DataFrame) -> DataFrame:
        """Members of tree nodes with several components, with the largest one and the number of sets outside it."""
        rows = staged(self.rooted(members), "setjoin-rooted", self.made)
        sizes = rows.groupBy("path", "root").agg(F.count(F.lit(1)).alias("n"))
        still = sizes.groupBy("path").agg(
            F.max(F.struct("n", "root")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("roots")
        ).filter("roots > 1")
        still = still.select("path", F.col("top.root").alias("top"), (F.col("n") - F.col("top.n")).alias("outside"))
        return staged(rows.join(still, "path"), "setjoin-open", self.held)

    def crossed(self, rows: DataFrame) -> DataFrame:
        """Pairs across the components of a tree node that may be links, its largest component not with itself.

        The representative has been compared with all others.
        """
        rows = rows.filter("node <> rep").join(self.looks, "node")
        x, y = rows.filter("root <> top").alias("x"), rows.alias("y")
        return x.join(
            y,
            (F.col("x.path") == F.col("y.path")) & (F.col("x.root") != F.col("y.root"))
            & ((F.col("y.root") == F.col("y.top")) | (F.col("x.node") < F.col("y.node"))) & _may_link(self.similar),
        ).select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))

    def confirm(self, pairs: DataFrame) -> None:
        """Link those of the pairs whose whole sets are similar enough."""
        spark: SparkSession = self.docs.sparkSession
        pairs = staged(pairs.distinct(), "setjoin-pairs", self.made)
        if pairs.isEmpty():
            return
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = staged(self.nodes.select("node", "digest", "least").join(ends, "node", "left_semi"), "setjoin-wanted", self.made)
        bits = spark.sparkContext.broadcast(id_filter(wanted.select("least").filter("least IS NOT NULL")))
        read = self.docs.mapInArrow(_sets(bits), "digest binary, codes array<long>").dropDuplicates(["digest"])
        sets = staged(read.join(wanted.select("node", "digest"), "digest").select("node", "codes"), "setjoin-sets", self.made)
        both = F.size(F.array_intersect("x", "y"))
        found = staged(
            pairs.join(sets.select(F.col("node").alias("a"), F.col("codes").alias("x")), "a")
            .join(sets.select(F.col("node").alias("b"), F.col("codes").alias("y")), "b")
            .filter(100 * both >= self.similar * (F.size("x") + F.size("y") - both)).select("a", "b"),
            "setjoin-links", self.made,
        )
        # The components so far are as good as all the links that made them.
        before = [] if self.roots is None else [self.roots.filter("node <> root").toDF("a", "b")]
        self.roots = staged(components(reduce(DataFrame.unionByName, before, found)), "setjoin-roots")
        discard(spark, self.made)

    def run(self) -> None:
        """Find all links and components."""
        members, pending, depth = self.members(self.children(None)), None, 1
        while True:
            pairs = self.stars(members)
            self.confirm(pairs if pending is None else pairs.unionByName(pending))
            rows = self.opened(members)
            many = rows.filter(F.col("outside") > FEW).select("path", "node")
            if depth == DEPTH or many.isEmpty():
                self.confirm(self.crossed(rows))
                discard(self.docs.sparkSession, self.held)
                return
            self.held, read = [], self.held
            children = staged(self.children(many), "setjoin-children", self.made)
            alike = staged(self.alike(children), "setjoin-alike", self.held)
            parting = many.select("path").distinct().join(alike, "path", "left_anti")
            pending = self.crossed(rows.join(parting, "path", "left_anti"))
            members = self.members(children.join(alike.withColumnRenamed("path", "parent"), "parent", "left_anti"))
            self.made += read
            depth += 1


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: int = SIMILAR
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` per row of ``docs``; component_id is the smallest id reachable.

    A text's set holds its different four-word shingles, A-Z lower-cased; fewer words make one
    shingle. Sets are linked when their Jaccard similarity is ``similar`` per cent or more, which is
    confirmed on whole sets (64-bit hashes of shingles). Equal sets (by a 128-bit digest) are one node
    before anything is compared. NULL, empty and blank texts have no set and are linked with nothing.

    Trees are grown level by level over all nodes at once. A tree node's members are first compared with
    their representative. A tree node whose members are then one component is done; where few members lie outside
    the largest component, those are compared with all; only the others branch again. Links inside a
    component add nothing, so a group of thousands alike costs one comparison each and branch.

    NULL ids come last: a component of NULL ids only has no component_id, and its rows are kept. Rows that
    repeat each other share their result. An empty table gives an empty one. Other columns are not read.
    """
    shipped(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = staged(
        texts.mapInArrow(_described, "id long, digest binary, size long, drawn array<int>, bits array<long>"), "setjoin"
    )
    nodes = staged(
        rows.filter("size > 0").groupBy("digest").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"),
            F.first("drawn").alias("drawn"), F.first("bits").alias("bits"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "setjoin-sets",
    )
    join = _Join(texts, nodes, similar)
    join.run()
    placed = staged(join.rooted(nodes.select("node", "digest", "least")), "setjoin-classes")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = placed.join(least, "root").select("digest", "component_id")
    found = rows.select("id", "digest", "size").join(classes, "digest", "left")
    component = F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        "id", F.col("size").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
