"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs, and decoding."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from raceway.llm.batches import slices
from raceway.llm.common import shipped

#: Fixed values of the public byte-level format: how a text is cut before merging, and which bytes
#: stand for themselves in the vocabulary (the others follow from 256 on, in order).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: White space before a space, or at either end of a text: its chunks are more than the gaps of split(" ").
UNEVEN = re.compile(r"\s |\A\s|\s\Z")
CHUNK = re.compile(r"\s*\S+|\s+")

NONE = np.iinfo(np.int64).max
#: Words encoded together hold about so many leaves; words kept by a worker.
LEAVES, KEPT = 1 << 16, 250_000
#: Bytes of text, or ids, worked on at once.
RUN = 2_000_000
IDS = T.ArrayType(T.IntegerType())


def byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary file."""
    moved = iter(range(256, 512))
    return [chr(b) if b in PLAIN else chr(next(moved)) for b in range(256)]


def _chunks(text: str) -> list[str]:
    """``text`` cut before each white space that follows a letter that is none."""
    if UNEVEN.search(text):
        return CHUNK.findall(text)
    first, *rest = text.split(" ")
    return [first, *[" " + c for c in rest]] if first else [" " + c for c in rest]


class Vocabulary:
    """Merge ranks, token bytes and added tokens of a byte-level BPE file (its JSON text)."""

    def __init__(self, text: str) -> None:
        spec = json.loads(text)
        ids, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        of = {c: b for b, c in enumerate(letters)}
        self.first = np.array([ids[c] for c in letters], np.int64)
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.size = max([*ids.values(), *added.values()]) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = bytes(of[c] for c in token)
        for token, i in added.items():
            self.bytes[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        codes = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks = codes[order], order.astype(np.int64)
        self.added = added
        names = sorted(added, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words = regex.compile(PATTERN)
        self.pieces = pa.array(self.bytes, pa.binary())
        self.kept: dict[str, bytes] = {}

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair of tokens, NONE where they do not merge (negative: no token)."""
        code = left * self.size + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.codes[at] == code), self.ranks[at], NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, as the bytes of 32-bit numbers.

        Every word has a segment tree whose leaf p holds the rank of the pair that starts at byte p,
        joined with p, so that its root is the leftmost pair of lowest rank. Merging it updates
        three leaves and their ancestors. Words of about one length are worked on side by side.
        """
        out = [b""] * len(words)
        widths: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            widths.setdefault(1 << max(1, (len(w) - 1).bit_length()), []).append(i)
        for width, members in widths.items():
            step = max(1, LEAVES // width)
            for at in range(0, len(members), step):
                group = members[at : at + step]
                tokens = self._merge([words[i] for i in group], width)
                left = tokens >= 0
                flat = tokens[left].astype("<i4").tobytes()
                ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
                for i, a, b in zip(group, [0, *ends], ends):
                    out[i] = flat[a:b]
        return out

    def _merge(self, words: list[bytes], width: int) -> np.ndarray:
        n, kind = len(words), np.int32 if (len(self.merged) + 1) * width < np.iinfo(np.int32).max else np.int64
        none = np.iinfo(kind).max
        lengths = np.array([len(w) for w in words])
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(n, width)
        place = np.arange(width)
        token = np.full((n, width + 1), -1, np.int64)  # the last column stands for "no token"
        token[:, :width] = np.where(place < lengths[:, None], self.first[raw], -1)
        after = np.tile(np.minimum(np.arange(1, width + 2), width), (n, 1))
        before = np.tile(np.r_[width, np.arange(width)], (n, 1))
        tree = np.full((n, 2 * width), none, kind)
        tree[:, width:] = self._leaves(token[:, :width], token[:, 1:], place, width, none)
        low = width
        while low > 1:
            low //= 2
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        # From here on all cells have one number each: that of a row's first cell, and a place in the row.
        tokens, afters, befores, cells = token.ravel(), after.ravel(), before.ravel(), tree.ravel()
        rows = np.flatnonzero(tree[:, 1] != none)
        while len(rows):
            line, root = rows * (width + 1), rows * (2 * width)
            rank, at = np.divmod(cells[root + 1].astype(np.int64), width)
            gone = afters[line + at]
            follow, prior = afters[line + gone], befores[line + at]
            made = self.merged[rank]
            tokens[line + at] = made
            tokens[line + gone] = -1
            afters[line + at] = follow
            befores[line + follow] = at
            cells[root + width + gone] = none
            cells[root + width + at] = self._leaves(made, tokens[line + follow], at, width, none)
            real = prior < width
            some, first = root[real], prior[real]
            cells[some + width + first] = self._leaves(tokens[line[real] + first], made[real], first, width, none)
            for roots, place in ((root, gone), (root, at), (some, first)):
                node = place + width
                step = 1
                while step < width:
                    step, node = 2 * step, node >> 1
                    pair = roots + 2 * node
                    cells[roots + node] = np.minimum(cells[pair], cells[pair + 1])
            rows = rows[cells[root + 1] != none]
        return token[:, :width]

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, width: int, none: int) -> np.ndarray:
        """Ranks of pairs joined with their places; ``none`` where they do not merge."""
        rank = self.rank(left, right)
        return np.where(rank == NONE, none, rank * width + at)

    def _learn(self, chunks: set[str]) -> None:
        """Encode chunks not met before: cut by the pattern, then merge each different word once."""
        cut = {c: self.words.findall(c) for c in chunks}
        words = list({w for ws in cut.values() for w in ws})
        ids = dict(zip(words, self.merge([w.encode() for w in words])))
        self.kept.update((c, b"".join([ids[w] for w in ws])) for c, ws in cut.items())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text; strings of added tokens give their own id.

        No word of the pattern spans the end of a run of non-space letters, so a text is the join of
        its chunks (white space, then none), and a chunk's ids do not depend on where it stands.
        """
        parts = []
        for text in texts:
            names = self.cut.split(text) if self.cut and self.cut.search(text) else [text]
            parts.append([(n, None) if n in self.added else (None, _chunks(n)) for n in names])
        seen = set()
        for part in parts:
            for _, chunks in part:
                if chunks:
                    seen.update(chunks)
        missing = seen.difference(self.kept)
        if missing:
            if len(self.kept) + len(missing) > KEPT:
                missing = seen
                self.kept.clear()
            self._learn(missing)
        ids = self.kept.__getitem__
        return [
            np.frombuffer(b"".join([
                self.added[name].to_bytes(4, "little") if chunks is None else b"".join(map(ids, chunks))
                for name, chunks in part
            ]), "<i4")
            for part in parts
        ]

    def decode(self, ids: list[int]) -> str:
        """The text of token ids, special ones included; broken UTF-8 gives replacement letters."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decode_lists(self, ids: pa.ListArray) -> pa.Array:
        """``decode`` of each list at once: the bytes of all tokens lie in one buffer, cut where a list ends."""
        joined = self.pieces.take(ids.values)
        ends = np.frombuffer(joined.buffers()[1], np.int32)[ids.offsets.to_numpy()]
        raw = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(ends), joined.buffers()[2]])
        try:
            return raw.cast(pa.string())  # refuses broken UTF-8
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


_LOADED: dict[int, Vocabulary] = {}


def _shared(vocabulary) -> Callable[[], Vocabulary]:
    """The vocabulary of a broadcast file, parsed once per worker."""

    def load() -> Vocabulary:
        text = vocabulary.value
        if hash(text) not in _LOADED:
            _LOADED.clear()
            _LOADED[hash(text)] = Vocabulary(text)
        return _LOADED[hash(text)]

    return load


class Codec:
    """Encoding and decoding of DataFrame columns with the byte-level BPE file at ``path``.

    The driver reads the file and broadcasts its text, whose size is that of a vocabulary whatever
    the data. All work is by row; other columns pass through. A NULL text counts as empty and has
    no ids, NULL ids decode to the empty text. New columns must have names of their own.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            self.load = _shared(shipped(spark).sparkContext.broadcast(file.read()))

    def encode(self, df: DataFrame, text: str, ids: str) -> DataFrame:
        """``df`` with a column ``ids``: token ids as ``array<int>``."""
        return self._added(df, text, {ids: IDS}, lambda v, rows: [_arrays(v.encode(_texts(rows)))])

    def decode(self, df: DataFrame, ids: str, text: str) -> DataFrame:
        """``df`` with a column ``text``: the text of its ids."""
        return self._added(
            df, ids, {text: T.StringType()},
            lambda v, rows: [pa.array([v.decode(x or []) for x in rows.to_pylist()], pa.string())],
        )

    def round_trip(self, df: DataFrame, text: str, ids: str, decoded: str) -> DataFrame:
        """Both in one pass: ``ids`` of the text, and the text that those ids decode to."""

        def make(v: Vocabulary, rows: pa.Array) -> list[pa.Array]:
            encoded = _arrays(v.encode(_texts(rows)))
            return [encoded, v.decode_lists(encoded)]

        return self._added(df, text, {ids: IDS, decoded: T.StringType()}, make)

    def _added(self, df: DataFrame, column: str, new: dict[str, T.DataType], make) -> DataFrame:
        if taken := new.keys() & set(df.columns):
            raise ValueError(f"columns {sorted(taken)} are taken")
        place, names, load = df.columns.index(column), [*df.columns, *new], self.load

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = load()
            for batch in batches:
                for part in slices(batch, place, RUN):
                    arrays = make(vocabulary, part.column(place))
                    yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=names)

        fields = [T.StructField(name, kind) for name, kind in new.items()]
        return df.mapInArrow(run, T.StructType([*df.schema.fields, *fields]))


def _texts(rows: pa.Array) -> list[str]:
    return [t or "" for t in rows.to_pylist()]


def _arrays(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else np.zeros(0, np.int32))


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
