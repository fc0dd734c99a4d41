"""Language identification: a linear-chain conditional random field over the words of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from raceway.llm.common import remainder, sampled, shipped, staged

#: Slots of hashed n-gram weights; lengths of n-grams, which with word ends are affixes as well.
SLOTS, GRAMS = 1 << 15, (2, 3, 4)
#: Words of the lexicon at most; least count, and least share in one language, of a lexicon word.
LEXICON, LEAST, SURE = 20_000, 3, 0.8
#: Largest number of labelled texts, and of partitions, for fitting; steps of gradient ascent.
MAX_TEXTS, PARTS, STEPS = 4_000, 8, 10
RATE, SHRINK = 0.5, 1e-4
#: Words per stretch of a text that is scanned side by side with others; words worked on at once.
STRETCH, RUN = 64, 250_000
MIX = np.uint64(0x9E3779B97F4A7C15)
NO_LANGUAGE = "und"


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words with a letter."""
    found = (text or "").lower().split()
    return [w.encode() for w in found if w.isalpha() or any(c.isalpha() for c in w)]


@dataclass
class Features:
    """Where each word's features lie: slots of n-grams (0: none) with the word's first, and lexicon rows."""

    slots: np.ndarray
    starts: np.ndarray
    lexicon: np.ndarray


def features(words: list[bytes], lexicon: dict[bytes, int]) -> Features:
    """Affix and n-gram slots, and the lexicon entry (0: none), of each word.

    N-grams are cut from the words joined by blanks; one with a blank at an end is an affix, one
    with a blank inside belongs to no word.
    """
    joined = np.frombuffer(b" " + b" ".join(words) + b" " * max(GRAMS), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = int(ends[-1])
    blank = joined == 32
    slots = []
    for size in GRAMS:
        code = np.zeros(n, np.uint64)
        inner = np.zeros(n, bool)
        for k in range(size):
            code = (code << np.uint64(8)) | joined[k : n + k]
            if 0 < k < size - 1:
                inner |= blank[k : n + k]
        slot = ((code + np.uint64(size)) * MIX) >> np.uint64(64 - SLOTS.bit_length() + 1)
        slots.append(np.where(inner, 0, np.maximum(slot, 1)).astype(np.int32))
    starts = np.r_[0, ends[:-1]]
    return Features(np.stack(slots), starts, np.fromiter(map(lexicon.get, words, [0] * len(words)), np.int64, len(words)))


def emissions(found: Features, weights: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Score per word and language."""
    total = sum(np.add.reduceat(weights[s], found.starts, axis=0) for s in found.slots)
    return total + entries[found.lexicon]


def _stretches(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each stretch (-1: none), the stretch's text, and its number in that text."""
    counts = -(-sizes // STRETCH)
    text = np.repeat(np.arange(len(sizes)), counts)
    number = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    first = (np.cumsum(sizes) - sizes)[text] + number * STRETCH
    index = first[:, None] + np.arange(STRETCH)
    return np.where(index < np.cumsum(sizes)[text][:, None], index, -1), text, number


def marginals(scores: np.ndarray, sizes: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each language per word, and the expected number of each transition.

    ``scores`` are the words' emissions, text after text; ``sizes`` (all above 0) the texts' words.
    Forward and backward sums run over all stretches at once: products of transition matrices per
    stretch first, then from stretch to stretch, then inside.
    """
    index, text, number = _stretches(sizes)
    n, width = len(index), scores.shape[1]
    real = index >= 0
    weight = np.exp(scores - scores.max(axis=1, keepdims=True))
    cell = np.where(real[:, :, None], weight[index], 1.0)
    move = np.exp(transitions - transitions.max())

    product = np.tile(np.eye(width), (n, 1, 1))
    for t in range(STRETCH):
        step = (product.reshape(-1, width) @ move).reshape(n, width, width) * cell[:, t, None, :]
        step /= step.sum(axis=(1, 2), keepdims=True)
        product = np.where(real[:, t, None, None], step, product)
    enter = np.full((n, width), 1.0 / width)
    leave = np.ones((n, width))
    order = np.argsort(number, kind="stable")
    bounds = np.searchsorted(number[order], np.arange(number.max() + 2))
    levels = [order[a:b] for a, b in zip(bounds, bounds[1:])]
    for here in levels[1:]:
        vector = np.einsum("ni,nij->nj", enter[here - 1], product[here - 1])
        enter[here] = vector / vector.sum(axis=1, keepdims=True)
    for here in levels[:0:-1]:
        vector = np.einsum("nij,nj->ni", product[here], leave[here])
        leave[here - 1] = vector / vector.sum(axis=1, keepdims=True)

    forward = np.empty((STRETCH, n, width))
    state = enter
    for t in range(STRETCH):
        step = (state @ move) * cell[:, t]
        state = np.where(real[:, t, None], step / step.sum(axis=1, keepdims=True), state)
        forward[t] = state
    out, expected = np.empty_like(scores), np.zeros((width, width))
    state = leave
    for t in range(STRETCH - 1, -1, -1):
        here = real[:, t]
        share = forward[t] * state
        share /= share.sum(axis=1, keepdims=True)
        out[index[here, t]] = share[here]
        arriving = cell[:, t] * state
        before = forward[t - 1] if t else enter
        joint = before[:, :, None] * move * arriving[:, None, :]
        counted = here & ((number > 0) | (t > 0))  # a text's first word has no word before it
        joint = joint[counted]
        expected += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        back = arriving @ move.T
        state = np.where(here[:, None], back / back.sum(axis=1, keepdims=True), state)
    return out, expected


@dataclass
class Model:
    """Languages, n-gram weights, lexicon words with their row of ``entries``, and transitions."""

    languages: list[str]
    lexicon: dict[bytes, int]
    weights: np.ndarray
    entries: np.ndarray
    transitions: np.ndarray

    def label(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """Language probabilities per word of each text; no text is empty."""
        found = features([w for t in texts for w in t], self.lexicon)
        sizes = np.array([len(t) for t in texts])
        shares, _ = marginals(emissions(found, self.weights, self.entries).astype(float), sizes, self.transitions)
        return np.split(shares, np.cumsum(sizes)[:-1])


def _runs(texts: pd.Series) -> Iterator[list[list[bytes]]]:
    run, size = [], 0
    for text in texts:
        run.append(words_of(text))
        size += len(run[-1])
        if size >= RUN:
            yield run
            run, size = [], 0
    if run:
        yield run


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", max_texts: int = MAX_TEXTS
) -> Model:
    """Fit on the texts of ``docs`` with a label; every word of a text has the text's label.

    Of the ids the smallest hashes are taken, ``max_texts`` in expectation, whole. Gradients of the
    likelihood are summed per partition of those, and over at most ``PARTS``; steps are scaled by
    past gradients. Rows with a NULL label, or a NULL id, are left out.
    """
    spark = shipped(docs.sparkSession)
    known = docs.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(text_col).alias("text")
    )
    by_label = {r.label: r.n for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(by_label)
    share = min(1.0, max_texts / max(sum(by_label.values()), 1))
    rows = staged(known.filter(sampled(F.col("id"), share)).select("label", "text"), "language-rows")
    width = len(languages)

    word = F.explode(F.split(F.lower("text"), r"\s+")).alias("word")
    seen = rows.select("label", word).filter(F.length("word").between(1, 64)).groupBy("word", "label").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = seen.groupBy("word").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top"))
    typical = total.filter((F.col("n") >= LEAST) & (F.col("top.n") >= SURE * F.col("n")))
    picked = typical.orderBy(F.desc("n"), "word").limit(LEXICON).select("word", "top.label").collect()
    lexicon = {r.word.encode(): 1 + languages.index(r.label) for r in picked}

    model = Model(
        languages, lexicon, np.zeros((SLOTS, width), np.float32), np.zeros((width + 1, width), np.float32),
        np.zeros((width, width)),
    )
    if width < 2:
        return model
    sums = [np.full_like(a, 1e-2, dtype=float) for a in (model.weights, model.entries, model.transitions)]
    few = rows.coalesce(PARTS)
    for _ in range(STEPS):
        sent = spark.sparkContext.broadcast(model)

        def gradient(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            now = sent.value
            grams, entries = np.zeros((SLOTS, width)), np.zeros((width + 1, width))
            moves, many = np.zeros((width, width)), 0
            for batch in batches:
                labels = batch.label.map(now.languages.index).to_numpy()
                at = 0
                for run in _runs(batch.text):
                    own = labels[at : at + len(run)]
                    at += len(run)
                    texts = [(t, y) for t, y in zip(run, own) if t]
                    if not texts:
                        continue
                    sizes = np.array([len(t) for t, _ in texts])
                    truth = np.repeat([y for _, y in texts], sizes)
                    found = features([w for t, _ in texts for w in t], now.lexicon)
                    shares, expected = marginals(
                        emissions(found, now.weights, now.entries).astype(float), sizes, now.transitions
                    )
                    error = -shares
                    error[np.arange(len(truth)), truth] += 1
                    spread = np.diff(np.r_[found.starts, found.slots.shape[1]])
                    for k in range(width):
                        each = np.repeat(error[:, k], spread)
                        for slots in found.slots:
                            grams[:, k] += np.bincount(slots, each, SLOTS)
                        entries[:, k] += np.bincount(found.lexicon, error[:, k], width + 1)
                    for (_, y), size in zip(texts, sizes):
                        moves[y, y] += size - 1
                    moves -= expected
                    many += len(truth)
            grams[0], entries[0] = 0, 0
            yield pd.DataFrame({
                "grams": [grams.astype(np.float32).tobytes()], "entries": [entries.tobytes()],
                "moves": [moves.tobytes()], "n": [many],
            })

        got = few.mapInPandas(gradient, "grams binary, entries binary, moves binary, n long").collect()
        sent.destroy()
        many = max(sum(g.n for g in got), 1)
        steps = (
            (model.weights, sum(np.frombuffer(g.grams, np.float32).astype(float) for g in got)),
            (model.entries, sum(np.frombuffer(g.entries) for g in got)),
            (model.transitions, sum(np.frombuffer(g.moves) for g in got)),
        )
        for past, (value, slope) in zip(sums, steps):
            slope = slope.reshape(value.shape) / many * 100 - SHRINK * value
            past += slope**2
            value += RATE * slope / np.sqrt(past)
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", out: str = "_lang") -> DataFrame:
    """Every row of ``docs`` with a struct ``out``: lang (the language of most words), score (their share).

    Shares are sums of the words' probabilities. A text that is NULL or without a letter is ``und``
    with score 0, as is every text under a model without languages. Other columns pass through,
    except one called ``out``.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} is taken")
    sent = shipped(docs.sparkSession).sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        now = sent.value
        for batch in batches:
            found = []
            for run in _runs(batch):
                texts = [t for t in run if t] if now.languages else []
                shares = iter(now.label(texts)) if texts else iter(())
                for words in run:
                    if not words or not now.languages:
                        found.append((NO_LANGUAGE, 0.0))
                        continue
                    mean = next(shares).mean(axis=0)
                    best = int(mean.argmax())
                    found.append((now.languages[best], min(1.0, round(float(mean[best]), 9))))
            yield pd.DataFrame(found, columns=["lang", "score"])

    return docs.withColumn(out, label(F.col(text_col)))


def label_words(texts: list[str], model: Model) -> list[list[tuple[str, str]]]:
    """Each text's words with a letter, each with its likeliest language, as in code-switched text."""
    words = [words_of(t) for t in texts]
    shares = iter(model.label([w for w in words if w]) if any(words) else [])
    return [
        [(w.decode(), model.languages[k]) for w, k in zip(own, next(shares).argmax(axis=1))] if own else []
        for own in words
    ]


def learnable(doc_id: Column) -> Column:
    """Whether the label of this id may be learned from: crc32 modulo 5 is not 0; not for a NULL id."""
    return F.coalesce(remainder(doc_id, 5) != 0, F.lit(False))
