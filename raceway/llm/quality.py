"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from raceway.llm.common import remainder, sampled, shipped, staged

#: Bytes of one kind; their share of a text is a feature.
KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:",
    "mark": b"!?",
    "sign": b"#$%&*@^~+=<>\\/",
    "bar": b"|_",
    "paired": b"()[]{}\"'`",
    "line": b"\n",
    "space": b" \t\x0b\x0c\r",
}
#: Statistics per document.
SIZE = len(KINDS) + 10
#: Largest number of labelled rows the classifier is fitted on (taken by hash of the id).
MAX_ROWS = 40_000
#: Random features; partitions whose sums are added up; bins of scores for the calibration.
FEATURES, PARTS, BINS = 256, 8, 256
RIDGE, SEED = 1.0, 7


def statistics(text: str | None) -> list[float]:
    """Shares of byte kinds, word and line figures of the whole text; all finite, also when empty."""
    raw = (text or "").encode()
    size = max(len(raw), 1)
    out = [1 - len(raw.translate(None, kind)) / size for kind in KINDS.values()] if raw else [0.0] * len(KINDS)
    words, lines = raw.split(), raw.split(b"\n")
    n, m = max(len(words), 1), len(lines)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    different = len(set(words))
    out += [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        float(lengths.mean()),
        float(lengths.std()),
        float(lengths.max()) ** 0.5,
        float((lengths <= 3).mean()),
        different / n,
        np.log1p(different) / np.log1p(n) if words else 0.0,
        len(set(lines)) / m,
        np.log1p(size / m),
    ]
    return out


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def document_statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([np.array(statistics(t)) for t in batch], dtype=object)


@dataclass
class Model:
    """A fitted classifier of a few hundred numbers; without labels every score is ``prior``."""

    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    knots: np.ndarray | None = None
    levels: np.ndarray | None = None

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _fourier((stats - self.mean) / self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(stats), self.prior)
        raw = self.raw(stats)
        # A hundredth of the raw score keeps the order inside the flat steps of the calibration.
        level = np.interp(raw, self.knots, self.levels)
        return np.clip(0.99 * level + 0.01 * np.clip(raw, 0, 1), 0.0, 1.0)


def _fourier(x: np.ndarray) -> np.ndarray:
    """Features whose inner products approach a Gaussian kernel, and a constant.

    The kernel's width grows with the number of statistics. The draws come from a fixed seed.
    """
    draw = np.random.default_rng(SEED)
    slope = draw.normal(size=(SIZE, FEATURES)) / np.sqrt(2.0 * SIZE)
    phase = draw.uniform(0, 2 * np.pi, FEATURES)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(x @ slope + phase), np.ones((len(x), 1))])


def _isotonic(scores: np.ndarray, good: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins sorted by score: middle of each block and its share."""
    blocks: list[list[float]] = []
    for s, g, n in zip(scores, good, rows):
        blocks.append([s * n, g, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", max_rows: int = MAX_ROWS,
) -> Model:
    """Fit on labelled documents; rows with a NULL id, or a label that is not 0 or 1, are left out.

    Of the labelled ids those with the smallest hashes are taken, ``max_rows`` in expectation, so
    the ids broadcast to the scan are bounded, and only their texts are read. One row in five
    calibrates, the rest give normal equations, summed per partition and then over ``PARTS``.
    """
    spark = shipped(docs.sparkSession)
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y")
    )
    share = min(1.0, max_rows / max(known.count(), 1))
    picked = known.filter(sampled(F.col("id"), share))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = staged(
        texts.join(F.broadcast(picked), "id").select(
            "id", "y", document_statistics("text").alias("x"),
            (F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(5)) == 0).alias("held"),
        ),
        "quality-rows",
    )
    place = [F.col("x")[i] for i in range(SIZE)]
    first = rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg("y").alias("y"),
        F.array(*[F.avg(p) for p in place]).alias("mean"),
        F.array(*[F.stddev_pop(p) for p in place]).alias("scale"),
    ).first()
    if not first.n or first.y in (0.0, 1.0):
        return Model(prior=0.5 if not first.n else float(first.y))
    scale = np.array(first.scale)
    model = Model(float(first.y), np.array(first.mean), np.where(scale > 1e-9, scale, 1.0))

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        gram, right = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            if len(batch):
                z = _fourier((np.stack(batch.x.tolist()) - model.mean) / model.scale)
                gram += z.T @ z
                right += z.T @ batch.y.to_numpy()
        yield pd.DataFrame({"gram": [gram.tobytes()], "right": [right.tobytes()]})

    # The rows are few, so few partitions hold them, and as few sums of fixed size reach the driver.
    fitted = rows.filter("not held").select("x", "y").coalesce(PARTS)
    parts = fitted.mapInPandas(sums, "gram binary, right binary").collect()
    gram = sum(np.frombuffer(p.gram) for p in parts).reshape(FEATURES + 1, FEATURES + 1)
    ridge = RIDGE * np.diag([*[1.0] * FEATURES, 1e-6])
    model.weights = np.linalg.solve(gram + ridge, sum(np.frombuffer(p.right) for p in parts))

    @F.pandas_udf(T.DoubleType())
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(model.raw(np.stack(x.tolist()))) if len(x) else pd.Series([], dtype=float)

    bins = rows.filter("held").select("y", F.round(raw("x"), 6).alias("s")).groupBy(
        F.floor(F.greatest(F.lit(-0.5), F.least(F.lit(1.5), F.col("s"))) * BINS).alias("bin")
    ).agg(F.avg("s").alias("s"), F.sum("y").alias("good"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect()
    if bins:
        model.knots, model.levels = _isotonic(*(np.array([b[c] for b in bins]) for c in ("s", "good", "n")))
    else:
        model.knots, model.levels = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def scorer(model: Model):
    """A column function: score of a text from 0 to 1; NULL and empty texts have one too."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            stats = np.array([statistics(t) for t in batch]).reshape(-1, SIZE)
            yield pd.Series(np.round(model.score(stats), 9))

    return score


def learnable(doc_id: Column) -> Column:
    """Whether labels of this id may be learned from: crc32 modulo 4 is not 2; not for a NULL id."""
    return F.coalesce(remainder(doc_id, 4) != 2, F.lit(False))
