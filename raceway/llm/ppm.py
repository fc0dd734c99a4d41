"""Prediction by partial matching over bytes: counts from the corpus, a trie of them, log probabilities."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from raceway.llm.batches import slices
from raceway.llm.common import discard, plain, position, restored, shipped, staged
from raceway.llm.simhash import LOWER

#: Bytes of context of the longest trie path.
ORDER = 5
#: Most longest trie paths, and most words, that are sent to every worker, picked by count; a join finds the rest.
NODES, WORDS = 1 << 20, 1 << 17
#: The end of a text. No word holds it; before a text stand as many of it as the context is long.
END = b"\n"
#: Bytes worked on at once; distinct words, and distinct paths, a task holds before it passes their counts on.
RUN, HELD = 400_000, 250_000
COLUMNS = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lower-cased."""
    return (text or "").encode().translate(LOWER).split()


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << (8 * (order + 1))) - 1)


def paths(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the texts with the ``order`` bytes before it, as one number, and where texts start."""
    pad = END * order
    joined = np.frombuffer(b"".join([pad + t for t in texts]), np.uint8)
    code = np.zeros(len(joined) - order, np.uint64)
    for back in range(order + 1):
        code |= joined[order - back : len(joined) - back].astype(np.uint64) << np.uint64(8 * back)
    lengths = np.array([len(t) for t in texts])
    real = np.ones(len(code), bool)  # windows that end in the padding of a later text are none
    at = np.cumsum(lengths + order)[:-1] - order
    for back in range(order):
        real[at + back] = False
    return code[real], np.r_[0, np.cumsum(lengths)[:-1]]


def spelled(words: list[bytes]) -> bytes:
    """The text the model reads: words one space apart, then the end."""
    return b" ".join(words) + END


def _counts(n, path=None, token=None) -> pa.RecordBatch:
    size = len(n)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(size, pa.int64()) if path is None else pa.array(path.astype(np.int64)),
            pa.nulls(size, pa.string()) if token is None else pa.array(token, pa.string()),
            pa.array(n, pa.int64()),
        ],
        names=["path", "token", "n"],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of trie paths and of words, summed within the task as far as memory allows."""
    words, codes, counts = Counter(), [], []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        unique, inverse = np.unique(np.concatenate(codes), return_inverse=True)
        return unique, np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)

    for batch in batches:
        for part in slices(batch, 0, RUN):
            texts = [words_of(t) for t in part.column(0).to_pylist()]
            for text in texts:
                words.update(text)
            words[END] += len(texts)
            code, many = np.unique(paths([spelled(t) for t in texts])[0], return_counts=True)
            codes.append(code)
            counts.append(many)
            if sum(map(len, codes)) > 2 * HELD:
                code, many = merged()
                codes, counts = [code], [many]
                if len(code) > HELD:
                    yield _counts(many, path=code)
                    codes, counts = [], []
            if len(words) > HELD:
                yield _counts(list(words.values()), token=[w.decode() for w in words])
                words = Counter()
    if codes:
        code, many = merged()
        yield _counts(many, path=code)
    if words:
        yield _counts(list(words.values()), token=[w.decode() for w in words])


def gather(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(path, token, n)``: counts of all trie paths of the longest order, and of all words."""
    shipped(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_count, "path long, token string, n long")
    return staged(counted.groupBy("path", "token").agg(F.sum("n").alias("n")), "ppm-counts")


def _fit_count(counts: DataFrame, room: int) -> int:
    """The least count that no more than ``room`` rows reach, to a quarter of a power of two."""
    bins = counts.groupBy(F.floor(4 * F.log2("n")).alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    total, least = 0, 1
    for row in bins.orderBy(F.desc("bin")).collect():
        total += row.rows
        if total > room:
            return int(np.ceil(2 ** ((row.bin + 1) / 4) - 1e-9))
    return least


class Table:
    """Open-addressing hash table from 64-bit keys to row numbers, for whole arrays at once."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, EMPTY)
        self.rows = np.full(1 << self.bits, -1, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == EMPTY
            _, first = np.unique(slot[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slot[put]] = keys[left[put]]
            self.rows[slot[put]] = left[put]
            stay = np.ones(len(left), bool)
            stay[put] = False
            left, slot = left[stay], (slot[stay] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        held = self.keys[slot]
        out = np.where(held == keys, self.rows[slot], -1)
        open_ = np.flatnonzero((held != keys) & (held != EMPTY))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            held = self.keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.rows[slot[open_[hit]]]
            open_ = open_[~hit & (held != EMPTY)]
        return out


class Cache:
    """Log probabilities of the most frequent paths of the longest order."""

    def __init__(self, paths_: np.ndarray, logs: np.ndarray) -> None:
        self.table, self.logs = Table(paths_), logs

    def score(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability per path, 0 where it is not held; and where it is held."""
        row = self.table.find(code)
        out, held = np.zeros(len(code)), row >= 0
        out[held] = self.logs[row[held]]
        return out, held


_BUILT: list[tuple[object, Cache]] = []


def _built(held) -> Cache:
    """The look-up table of what was broadcast, built once per worker."""
    if not _BUILT or _BUILT[0][0] is not held:
        _BUILT[:] = [(held, Cache(*held))]
    return _BUILT[0][1]


def nodes_of(counts: DataFrame, order: int = ORDER, made: list[str] | None = None) -> DataFrame:
    """``(k, path, n)``: all trie nodes, from the counts of all longest paths. Shorter paths sum the longer ones."""
    full = counts.filter("path IS NOT NULL").select("path", "n")
    levels = None
    for k in range(order + 1):
        level = full.groupBy(F.col("path").bitwiseAND(F.lit(int(_mask(k)))).alias("path")).agg(
            F.sum("n").alias("n")
        ).withColumn("k", F.lit(k)) if k < order else full.withColumn("k", F.lit(k))
        levels = level if levels is None else levels.unionByName(level)
    return staged(levels, "ppm-levels", made)


def _last(x: Column, length: Column) -> Column:
    """The last so many bytes of a path."""
    return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (8 * length).cast("int")) - 1)


def contexts_of(levels: DataFrame, made: list[str] | None = None) -> DataFrame:
    """``(k, context, total, escape, rest, escape_rest)`` per context, as logarithms.

    ``total`` divides the count of a byte seen after the context, ``escape`` is the cost of any other byte. ``rest``
    and ``escape_rest`` are the same one byte shorter, where bytes seen after this context are excluded.
    """
    shorter = levels.select((F.col("k") + 1).alias("k"), F.col("path").alias("tail"), F.col("n").alias("m"))
    own = levels.withColumn("tail", _last(F.col("path"), F.col("k"))).join(shorter, ["k", "tail"], "left").groupBy(
        "k", F.shiftright("path", 8).alias("context")
    ).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("size"), F.sum("m").alias("seen"))
    own = staged(own, "ppm-followers", made)
    above = own.select(
        (F.col("k") + 1).alias("k"), F.col("context").alias("tail"), F.col("n").alias("t"), F.col("size").alias("u")
    )
    # Of the shorter context, what the followers of the longer one leave; 0 kinds cost nothing.
    kinds = F.col("u") - F.col("size")
    total, rest = F.log10(F.col("n") + F.col("size")), F.log10(F.col("t") - F.col("seen") + kinds)
    return staged(
        own.withColumn("tail", _last(F.col("context"), F.greatest(F.col("k") - 1, F.lit(0))))
        .join(above, ["k", "tail"], "left")
        .select(
            "k", "context", total.alias("total"), (F.log10("size") - total).alias("escape"), rest.alias("rest"),
            F.when(kinds > 0, F.log10(kinds) - rest).otherwise(0.0).alias("escape_rest"),
        ),
        "ppm-contexts",
        made,
    )


def trained_of(levels: DataFrame, contexts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(path, n, log)``: every longest path seen in training and its log10 probability, which its context alone decides."""
    full = levels.filter(F.col("k") == order).withColumn("context", F.shiftright("path", 8))
    totals = contexts.filter(F.col("k") == order).select("context", "total")
    return staged(
        full.join(totals, "context").select("path", "n", (F.log10("n") - F.col("total")).alias("log")), "ppm-trained"
    )


def solved(wanted: DataFrame, levels: DataFrame, contexts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(path, log)``: log10 probability of each of the different paths ``wanted``, from all nodes.

    A byte not seen after a context costs the context's escape and is looked for after the context one byte
    shorter. There, bytes seen after the longer context cannot come and are excluded. Paths of one or two bytes are few
    whatever the input, and crowded, so they are broadcast.
    """
    steps = wanted.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(order)))).withColumn(
        "own", _last(F.col("path"), F.col("k") + 1)
    ).withColumn("context", F.shiftright("own", 8))
    nodes = levels.withColumnRenamed("path", "own")
    low, high = (lambda x: F.broadcast(x.filter("k < 2"))), (lambda x: x.filter("k >= 2"))
    found = steps.filter("k < 2").join(low(nodes), ["k", "own"], "left").join(low(contexts), ["k", "context"], "left")
    found = found.unionByName(
        steps.filter("k >= 2").join(high(nodes), ["k", "own"], "left").join(high(contexts), ["k", "context"], "left")
    )
    steps = found.groupBy("path").agg(
        F.coalesce(F.max(F.when(F.col("n").isNotNull(), F.col("k"))), F.lit(-1)).alias("hit"),
        F.max(F.when(F.col("total").isNotNull(), F.col("k"))).alias("known"),
        F.array_sort(F.collect_list(F.struct("k", "n", "total", "escape", "rest", "escape_rest"))).alias("at"),
    )
    at = lambda k, c: F.get("at", k).getField(c)
    hit, known = F.col("hit"), F.col("known")
    floor = -float(np.log10(max(256 - levels.filter("k = 0").count(), 1)))
    passed = sum(
        (F.when((known >= k) & (hit < k - 1), at(F.lit(k), "escape_rest")).otherwise(0.0) for k in range(1, order + 1)),
        F.coalesce(at(known, "escape"), F.lit(0.0)),  # nothing was learned
    )
    last = F.when(hit >= 0, F.log10(at(hit, "n")) - at(hit + 1, "rest")).otherwise(floor)
    return steps.select(
        "path", F.when(hit == known, F.log10(at(hit, "n")) - at(hit, "total")).otherwise(passed + last).alias("log")
    )


def score_documents(
    docs: DataFrame, train: Column, text_col: str = "text", out: str = "_lm", room: int = NODES
) -> DataFrame:
    """Every row of ``docs`` with a struct ``out``: n_tokens, n_known, train_tokens, base_score, score.

    Rows where ``train`` holds are learned from. ``score`` is the log10 probability of the words,
    one space apart, and the end of the text, under the trie of all paths. Workers get the ``room`` most
    frequent longest paths. All others seen in training are looked up by one join, and only paths never seen
    there go through the shorter contexts; the score does not depend on ``room``. ``base_score`` uses word counts with
    one added: the most frequent words are looked up in the worker, the rest by a join on the word.
    NULL counts as empty, whose only token is the end. Without a row to learn from the byte model
    is uniform. Other columns pass through, whatever their names, except one called ``out``.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} is taken")
    spark = shipped(docs.sparkSession)
    place, rows = position(docs, text_col), plain(docs.select("*", train.alias("train")))
    train = F.col(f"c{len(docs.columns)}")
    counts = gather(rows.filter(train), f"c{place}")
    tokens = counts.filter("token IS NOT NULL").select("token", "n")
    size = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    least = _fit_count(tokens, WORDS)
    frequent = tokens.filter(F.col("n") >= least).toArrow()
    logs = np.log10(frequent.column("n").to_numpy() + 1.0).tolist()
    words = {t.as_py().encode(): x for t, x in zip(frequent.column("token"), logs)}
    made: list[str] = []
    levels = nodes_of(counts, made=made)
    contexts = contexts_of(levels, made)
    trained = trained_of(levels, contexts)
    sent = F.col("n") >= _fit_count(trained, room)
    held = trained.filter(sent).toArrow()
    held = held.column("path").to_numpy().astype(np.uint64), held.column("log").to_numpy()
    model = spark.sparkContext.broadcast((held, words))

    fields = "n_tokens long, n_known long, base double, score double, rare array<string>, open array<long>"
    rows = rows.drop(rows.columns[-1])
    schema = T.StructType([*rows.schema.fields, T.StructField("found", T.StructType.fromDDL(fields))])
    names = [*rows.columns, "found"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = model.value
        cache = _built(held)
        for batch in batches:
            for part in slices(batch, place, RUN):
                texts = [words_of(t) for t in part.column(place).to_pylist()]
                code, starts = paths([spelled(t) for t in texts])
                logs, met = cache.score(code)
                sums = np.add.reduceat(logs, starts)
                ends = np.r_[0, np.cumsum(np.add.reduceat((~met).astype(np.int32), starts))].astype(np.int32)
                for words in texts:
                    words.append(END)
                common = [[known[w] for w in words if w in known] for words in texts]
                rare = [[w.decode() for w in words if w not in known] for words in texts]
                columns = {
                    "n_tokens": pa.array(map(len, texts), pa.int64()), "n_known": pa.array(map(len, common), pa.int64()),
                    "base": pa.array(map(sum, common), pa.float64()), "score": pa.array(sums),
                    "rare": pa.array(rare, pa.list_(pa.string())),
                    "open": pa.ListArray.from_arrays(ends, code[~met].astype(np.int64)),
                }
                found = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=names)

    scored = staged(rows.mapInArrow(score, schema).withColumn("row", F.monotonically_increasing_id()), "ppm-scored")
    seldom = scored.select("row", F.explode("found.rare").alias("token"))
    met = seldom.join(tokens.filter(F.col("n") < least), "token").groupBy("row").agg(
        F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1.0)).alias("base")
    )
    missed = scored.select("row", F.explode("found.open").alias("path"))
    unseen = missed.select("path").distinct().join(trained, "path", "left_anti")
    logs = staged(solved(unseen, levels, contexts), "ppm-unseen").unionByName(
        trained.filter(~sent).select("path", "log")
    )
    discard(spark, made)
    looked = missed.join(logs, "path").groupBy("row").agg(F.sum("log").alias("log"))
    added = lambda c: F.coalesce(F.col(c), F.lit(0))
    unknown = float(np.log10(size.n + size.v + 1.0))
    return scored.join(met, "row", "left").join(looked, "row", "left").select(
        *restored(docs),
        F.struct(
            F.col("found.n_tokens").alias("n_tokens"),
            (F.col("found.n_known") + added("more")).alias("n_known"),
            F.lit(size.n).cast("long").alias("train_tokens"),
            (F.col("found.base") + added("base") - F.col("found.n_tokens") * unknown).alias("base_score"),
            (F.col("found.score") + added("log")).alias("score"),
        ).alias(out),
    )
