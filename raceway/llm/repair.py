"""Conversation repair: least edits towards a role grammar, solved once per node of a suffix-shared automaton."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from raceway.llm.common import shipped, staged

#: White space; a turn of nothing else is blank.
BLANKS = " \t\n\x0b\x0c\r"
#: A turn that does not end in one of these is cut short.
ENDS = ".!?"
#: Costs of the edits. Keeping is free; a cut turn that is not deleted costs CUT more.
RELABEL, DELETE, INSERT, CUT = 1, 2, 5, 5
#: Turns whose signature is solved as one word; longer conversations are several words.
BLOCK = 256

#: What was said so far: 0 nothing, 1 a system turn, 2 a user turn last, 3 an assistant turn last.
STATES, ENDINGS = range(4), (0, 3)
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
#: The state after the only turn that may be inserted, or relabelled, and that turn's role.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")

Best = tuple[int, str] | None
Table = list[list[Best]]


def _chain(state: int) -> list[tuple[int, int]]:
    """States reached by inserting up to two turns; more never pay."""
    return [(0, state), (1, NEXT[state]), (2, NEXT[NEXT[state]])]


def nothing() -> Table:
    """The node of the empty suffix: least (cost, audit) from each state to each, by inserted turns only."""
    table: Table = [[None] * 4 for _ in STATES]
    for q in STATES:
        for many, r in reversed(_chain(q)):
            table[q][r] = (INSERT * many, "I" * many)
    return table


def preceded(symbol: str, rest: Table) -> Table:
    """The node of ``symbol`` before a suffix, from the suffix's node.

    Symbols: ``x`` must go; s, u, a, o are turns by role (o: any other), in capitals if cut short.
    Of equal costs the ASCII-least audit wins. Two audits of one suffix that cost the same are
    never one the beginning of the other, so the least whole is made of least parts.
    """
    low, cut = symbol.lower(), CUT * symbol.isupper()
    table: Table = [[None] * 4 for _ in STATES]
    for q in STATES:
        for many, r in _chain(q):
            spent, begun = INSERT * many, "I" * many
            ways = [(spent + DELETE, begun + "D", r)]
            if low != "x":
                if (r, low) in MOVES:
                    ways.append((spent + cut, begun + "K", MOVES[r, low]))
                ways.append((spent + RELABEL + cut, begun + "R", NEXT[r]))
            for cost, letters, to in ways:
                for e in STATES:
                    if rest[to][e] is not None:
                        whole = (cost + rest[to][e][0], letters + rest[to][e][1])
                        if table[q][e] is None or whole < table[q][e]:
                            table[q][e] = whole
    return table


def joined(first: Table, second: Table) -> Table:
    """Table of two stretches, one after the other."""
    table: Table = [[None] * 4 for _ in STATES]
    for q in STATES:
        for e in STATES:
            ways = [
                (first[q][m][0] + second[m][e][0], first[q][m][1] + second[m][e][1])
                for m in STATES if first[q][m] is not None and second[m][e] is not None
            ]
            table[q][e] = min(ways, default=None)
    return table


class Automaton:
    """Nodes of words that come sorted by their reverse: those of the last word's suffixes are at hand.

    Words that share a suffix are neighbours, so a node is made once and dropped when no later word
    can end like it. Memory is one word's nodes.
    """

    def __init__(self) -> None:
        self.word, self.nodes = "", [nothing()]

    def table(self, word: str) -> Table:
        turned = word[::-1]
        same = 0
        while same < min(len(turned), len(self.word)) and turned[same] == self.word[same]:
            same += 1
        del self.nodes[same + 1 :]
        for symbol in turned[same:]:
            self.nodes.append(preceded(symbol, self.nodes[-1]))
        self.word = turned
        return self.nodes[-1]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = Automaton()
    for batch in batches:
        names = batch.schema.names
        tables = [automaton.table(w) for w in batch.column(names.index("word")).to_pylist()]
        flat = [[b for row in t for b in row] for t in tables]
        costs = pa.array([[-1 if b is None else b[0] for b in t] for t in flat], pa.list_(pa.int32()))
        audits = pa.array([["" if b is None else b[1] for b in t] for t in flat], pa.list_(pa.string()))
        yield pa.RecordBatch.from_arrays([*batch.columns, costs, audits], names=[*names, "costs", "audits"])


def _illegal(chars: str) -> int:
    """Neighbouring roles that may not follow each other."""
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(chars, chars[1:]))


class _Conversation:
    """Sums over the blocks of a conversation, in order; tables merge like a binary counter."""

    COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def __init__(self, marker: dict) -> None:
        self.key, self.last, self.held = marker["conv"], "", []
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.low = self.high = None
        self.turns = 0

    def add(self, row: dict) -> None:
        for c in ("blank", "duplicate", "truncated"):
            self.sums[c] += row[c]
        self.sums["illegal"] += _illegal(self.last + row["chars"])
        self.last = row["chars"][-1]
        if row["high"] is not None:
            self.low = row["low"] if self.low is None else self.low
            self.turns += row["turns"] - (self.high == row["low"])
            self.high = row["high"]
        cells = [None if c < 0 else (c, a) for c, a in zip(row["costs"], row["audits"])]
        table, size = [cells[4 * q : 4 * q + 4] for q in STATES], 1
        while self.held and self.held[-1][1] == size:
            table, size = joined(self.held.pop()[0], table), 2 * size
        self.held.append((table, size))

    def result(self) -> dict:
        table = nothing()
        for part, _ in reversed(self.held):
            table = joined(part, table)
        cost, audit = min(table[0][e] for e in ENDINGS if table[0][e] is not None)
        gaps = 0 if self.high is None else self.high - self.low + 1 - self.turns
        return {"conv": self.key, "gaps": gaps, **self.sums, "cost": cost, "audit": audit}


def _assemble(key: T.DataType):
    schema = pa.schema([
        ("conv", _arrow(key)), *[(c, pa.int64()) for c in _Conversation.COUNTS], ("audit", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    if open_ is not None:
                        out.append(open_.result())
                    open_ = _Conversation(row)
                else:
                    open_.add(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([open_.result()], schema)

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


class _Editor:
    """Applies an audit to turns that come one by one."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            yield ROLE[self.state], "", "I"
            self.at, self.state = self.at + 1, NEXT[self.state]

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The turns (role, text, edit) that stand for this one, those inserted before it too."""
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = MOVES[self.state, role[:1]]
            yield role, text, edit
        elif edit == "R":
            role, self.state = ROLE[self.state], NEXT[self.state]
            yield role, text, edit

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict | None, list]]:
    """Conversation markers, each with the turns that the last one ended in, and the turns row by row."""
    editor = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                yield row, [] if editor is None else list(editor.end())
                editor = _Editor(row["audit"])
            else:
                yield None, list(editor.turn(row["role"], row["text"]))
    if editor is not None:
        yield None, list(editor.end())


#: Rows that a task passes on at once.
PAGE = 1000


def _digests(fields: list[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, row, digest, any_ = [], None, None, False

        def closed() -> dict:
            return {**{c: row[c] for c in fields}, "repaired_sha256": digest.hexdigest()}

        for marker, turns in _edits(batches):
            for role, text, _ in turns:
                digest.update(f"{chr(10) if any_ else ''}{role}:{text}".encode())
                any_ = True
            if marker is not None:
                if row is not None:
                    out.append(closed())
                row, digest, any_ = marker, hashlib.sha256(), False
                if len(out) >= PAGE:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        if row is not None:
            out.append(closed())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _turns(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, place = [], None, 0
        for marker, turns in _edits(batches):
            for role, text, edit in turns:
                out.append({"conv": key, "place": place, "role": role, "text": text, "edit": edit})
                place += 1
            if marker is not None:
                key, place = marker["conv"], 0
            if len(out) >= PAGE:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


class Repair:
    """The least edits of every conversation of ``rows(conv, turn, role, text)``.

    Turns go by ``turn`` (NULL first), then role, then text; rows that repeat each other stay side by
    side. A NULL role or text counts as one space. ``conversations`` lists all ids there are, among
    them such as have no turn left; by default those of ``rows``. NULL is an id like any other.

    A turn's first fault counts: blank, duplicate (role and text came earlier in the conversation, by
    SHA-256), truncated. Blank and duplicate turns must go. What stays must read, by the first letters of
    the roles, as one system turn or none and then pairs of user and assistant; a role that
    begins otherwise, an empty one too, has to be relabelled or deleted.

    Rows are stored once in ranges of (conversation, turn, role, text), so a conversation of any length
    lies in many files. Signatures of up to ``BLOCK`` turns are solved in the order of their reverse,
    which is where a common signature meets itself, split over tasks when it is very common. Only a
    conversation's few letters per turn are put together in one task; its texts pass through
    one as a stream, since a digest is made from the first byte to the last.
    """

    def __init__(
        self, rows: DataFrame, conversations: DataFrame | None = None,
        conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    ) -> None:
        shipped(rows.sparkSession)
        gap = F.lit(" ")
        self.key = rows.schema[conv_col].dataType
        self.rows = _in_order(rows.select(
            F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col), gap).alias("role"), F.coalesce(F.col(text_col), gap).alias("text"),
        ))
        every = self.rows.select("conv") if conversations is None else conversations.select(F.col(conv_col).alias("conv"))
        self.every = every.distinct()
        self._audits: DataFrame | None = None

    def _blocks(self) -> DataFrame:
        """One row per run of turns: their signature and what is counted over them."""
        rows = self.rows
        body = F.rtrim("text", F.lit(BLANKS))
        digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
        first = F.substring("role", 1, 1)
        thin = rows.select(
            "at", "conv", "turn", digest.alias("digest"), (body == "").alias("blank"),
            (~F.substring(body, -1, 1).isin(*ENDS)).alias("cut"),
            F.when(first.isin("s", "u", "a"), first).otherwise("o").alias("char"),
        )
        heads = thin.groupBy("conv", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("head"))
        fault = F.when(F.col("blank"), "blank").when(F.col("head").isNull(), "duplicate").when(F.col("cut"), "truncated")
        marked = thin.drop("digest").join(heads, "at", "left").withColumn("fault", fault).withColumn(
            "symbol",
            F.when(F.col("fault").isin("blank", "duplicate"), "x")
            .when(F.col("fault") == "truncated", F.upper("char")).otherwise(F.col("char")),
        )
        some = lambda name: F.count_if(F.coalesce(F.col("fault") == name, F.lit(False))).alias(name)
        blocks = marked.groupBy("conv", F.floor(F.col("at") / BLOCK).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("at", "symbol", "char"))).alias("turns_"),
            some("blank"), some("duplicate"), some("truncated"),
            F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"),
        )
        return blocks.select(
            "conv", "block", "blank", "duplicate", "truncated", "low", "high", "turns",
            F.array_join("turns_.symbol", "").alias("word"), F.array_join("turns_.char", "").alias("chars"),
        )

    def audits(self) -> DataFrame:
        """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit``: one row per conversation, stored."""
        if self._audits is None:
            turned = F.reverse("word")
            blocks = self._blocks()
            fields = [*blocks.schema.fields, *T.StructType.fromDDL("costs array<int>, audits array<string>").fields]
            # The block's number comes after the word, so that a very common word is split as well.
            solved = blocks.repartitionByRange(turned, "block").sortWithinPartitions(turned, "block").mapInArrow(
                _solve, T.StructType(fields)
            ).drop("word").withColumn("kind", F.lit(1))
            marks = self.every.withColumn("kind", F.lit(0))
            both = marks.unionByName(solved, allowMissingColumns=True)
            order = both.repartition("conv").sortWithinPartitions("conv", "kind", "block")
            counts = [T.StructField(c, T.LongType()) for c in _Conversation.COUNTS]
            out = T.StructType([T.StructField("conv", self.key), *counts, T.StructField("audit", T.StringType())])
            self._audits = staged(order.mapInArrow(_assemble(self.key), out), "repair-audits")
        return self._audits

    def _stream(self) -> DataFrame:
        marks = self.audits().withColumn("kind", F.lit(0))
        both = marks.unionByName(self.rows.drop("turn").withColumn("kind", F.lit(1)), allowMissingColumns=True)
        return both.repartition("conv").sortWithinPartitions("conv", "kind", "at")

    def digests(self) -> DataFrame:
        """``audits`` with ``repaired_sha256``, the digest of the repaired ``role:text`` lines."""
        schema = T.StructType([*self.audits().schema.fields, T.StructField("repaired_sha256", T.StringType())])
        arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in schema.fields])
        return self._stream().mapInArrow(_digests(self.audits().columns, arrow), schema)

    def turns(self) -> DataFrame:
        """The repaired conversations: ``conv, place, role, text, edit`` (K, R or I), place from 0."""
        more = T.StructType.fromDDL("place long, role string, text string, edit string").fields
        schema = T.StructType([T.StructField("conv", self.key), *more])
        arrow = pa.schema([(f.name, _arrow(f.dataType)) for f in schema.fields])
        return self._stream().mapInArrow(_turns(arrow), schema)


def _in_order(rows: DataFrame) -> DataFrame:
    """``rows`` stored in order; ``at`` numbers them, with gaps between files.

    Long texts are told apart by their beginning and a hash when the ranges are cut, and copies by
    where they were read, so that neither a conversation nor a turn has to fit one range.
    """
    apart = [F.substring("text", 1, 64), F.xxhash64("text"), F.col("_read")]
    parts = rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(
        "conv", "turn", "role", *apart
    ).sortWithinPartitions("conv", "turn", "role", F.substring("text", 1, 64), "text")
    return staged(parts.drop("_read").withColumn("at", F.monotonically_increasing_id()), "repair-turns")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with a fault in one of four, told by the crc32 of conversation and turn.

    NULL counts as one space, in the text that is hashed too.
    """
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    what = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    marked = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), what.alias("what"))
    return marked.filter("what <> 0").select(
        "conv_id", "turn",
        F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "").when(F.col("what") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("what") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
