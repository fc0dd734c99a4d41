"""Document fingerprints: invertible Bloom lookup sketches of paragraphs, compared by peeling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from raceway.llm.common import ranged, staged

#: Hash tables per sketch: an item has one cell in each.
TABLES = 3
#: Cells per table of the printed fingerprint and of the first comparison; a failed one gets FACTOR as many.
CELLS, FACTOR = 16, 4
#: Tables are peeled in turn, so many times in all.
ROUNDS = 12
#: Bits of an item: digest, then check.
DIGEST, CHECK = 40, 16
#: A distinct document: whether its id is NULL, its id (else 0), and the hash of its text. None is NULL, so
#: all joins, windows and groups of documents share one partitioning.
KEY = ["no", "id", "h"]


def paragraphs(text: Column) -> Column:
    """64-bit hashes of the lines of a text, in order; none for an empty text."""
    lines = F.transform(F.split(text, "\n"), lambda line: F.xxhash64(line))
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(lines)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check")).bitwiseAND(F.lit((1 << CHECK) - 1))


def _place(digest: Column, table: int, cells: int) -> Column:
    """The digest's cell in one table, numbered over all tables."""
    return (F.xxhash64(digest, F.lit(table)).bitwiseAND(F.lit(cells - 1)) + table * cells).cast("int")


def _key(row: Column | str) -> list[Column]:
    return [F.col(f"{row}.{k}").alias(k) for k in KEY]


def _neighbours(keys: DataFrame) -> DataFrame:
    """Distinct documents with their length, and the key and length of the one before and the next.

    Order is ascending id (NULL last), then h; after the last comes the first. Ranges are stored
    sorted, neighbours are found inside each, and one row per range bridges to the next range.
    """
    order = [F.col(k) for k in KEY]
    rows = ranged(keys, order, "sketch-order")
    inside = Window.partitionBy("_part").orderBy(*order)
    here = F.struct(*KEY, "n")
    placed = rows.withColumns({"next": F.lead(here).over(inside), "prev": F.lag(here).over(inside)})
    ends = rows.groupBy("_part").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    across = Window.orderBy("_part")
    whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bridge = ends.select(
        "_part",
        F.coalesce(F.lead("first").over(across), F.first("first").over(whole)).alias("after"),
        F.coalesce(F.lag("last").over(across), F.last("last").over(whole)).alias("ahead"),
    )
    return placed.join(bridge, "_part").select(
        *KEY, "n", F.coalesce("next", "after").alias("next"), F.coalesce("prev", "ahead").alias("prev")
    )


def edited(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents with their neighbours' paragraphs, one row per row of ``docs``, stored.

    ``copy`` numbers the rows that share id and text, ``n`` is the length in code points. The
    edited text is the text with its last floor(n/2) code points replaced by the first as many (or
    all) of the next document. Only the lengths are ordered; texts are sent once, by their key, and
    of a neighbour's text just that beginning. ``d0``, ``d1``, ``d2`` are the paragraphs of the
    text, of the edited text and of the next document.
    """
    body = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).isNull().alias("no"), F.coalesce(F.col(id_col), F.lit(0)).alias("id"), body.alias("text")
    ).withColumn("h", F.xxhash64("text"))
    keys = keyed.groupBy(*KEY).agg(F.max(F.char_length("text")).cast("long").alias("n"))
    near = staged(_neighbours(keys), "sketch-neighbours")
    copies = F.row_number().over(Window.partitionBy(*KEY).orderBy("n"))
    own = keyed.join(near, KEY).withColumn("copy", copies)
    half = F.floor(F.col("prev.n") / 2).cast("int")
    heads = own.filter("copy = 1").select(*_key("prev"), F.substring(F.col("text"), F.lit(1), half).alias("head"))
    keep = (F.col("n") - F.floor(F.col("n") / 2)).cast("int")
    changed = own.join(heads, KEY).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), keep), F.col("head"))
    )
    sides = staged(
        changed.select(
            *KEY, "n", "copy", "prev", F.unhex(F.sha2(F.col("edited").cast("binary"), 256)).alias("sha"),
            paragraphs(F.col("text")).alias("d0"), paragraphs(F.col("edited")).alias("d1"),
        ),
        "sketch-paragraphs",
    )
    following = sides.filter("copy = 1").select(*_key("prev"), F.col("d0").alias("d2"))
    return staged(sides.drop("prev").join(following, KEY), "sketch-sides")


def _items(sides: DataFrame) -> DataFrame:
    """``(key, side, digest)``: each different paragraph of a side, told apart by how often it occurs."""
    def of(side: int) -> Column:
        return F.transform(f"d{side}", lambda d: F.struct(F.lit(side).alias("side"), d.alias("d")))

    every = F.explode(F.concat(*[of(s) for s in range(3)])).alias("p")
    counted = sides.select(*KEY, every).groupBy(*KEY, "p.side", "p.d").agg(F.count(F.lit(1)).alias("c"))
    return counted.select(
        *KEY, "side", F.xxhash64("d", "c").bitwiseAND(F.lit((1 << DIGEST) - 1)).alias("digest")
    )


def sketches(items: DataFrame, cells: int) -> DataFrame:
    """``(key, side, cell, x, c)``: XOR of the items of a cell, and their count."""
    digest = F.col("digest")
    item = F.shiftleft(digest, CHECK).bitwiseOR(_check(digest))
    dealt = items.select(
        *KEY, "side", item.alias("x"),
        F.explode(F.array(*[_place(digest, t, cells) for t in range(TABLES)])).alias("cell"),
    )
    return dealt.groupBy(*KEY, "side", "cell").agg(F.bit_xor("x").alias("x"), F.count(F.lit(1)).alias("c"))


def printed(cells: DataFrame) -> DataFrame:
    """``(key, side, fingerprint)``: the occupied cells as cell:count:items, by cell."""
    cell = F.concat_ws(":", F.lpad(F.hex("cell"), 2, "0"), F.hex("c"), F.hex("x"))
    listed = cells.groupBy(*KEY, "side").agg(F.array_sort(F.collect_list(cell)).alias("all"))
    return listed.select(*KEY, "side", F.lower(F.array_join("all", " ")).alias("fingerprint"))


def subtract(cells: DataFrame) -> DataFrame:
    """``(key, pair, cell, x, c)``: the text's sketch less that of the edited text (1) and the next (2)."""
    pairs = F.when(F.col("side") == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.col("side")))
    sign = F.when(F.col("side") == 0, F.col("c")).otherwise(-F.col("c"))
    signed = cells.select(*KEY, F.explode(pairs).alias("pair"), "cell", "x", sign.alias("c"))
    return signed.groupBy(*KEY, "pair", "cell").agg(F.bit_xor("x").alias("x"), F.sum("c").alias("c"))


def peel(cells: DataFrame, size: int) -> DataFrame:
    """``(key, pair, found, left)``: items recovered from a subtracted sketch, and cells that stay.

    A cell with a count of 1 or -1 whose check and place fit its digest holds one item; it is taken
    out of the other tables. An item has one cell per table, so with one table at a time no item
    is taken twice. Cell -1 counts what was found. ``left`` is 0 if the sketch was resolved whole.
    """
    x, c, cell = F.col("x"), F.col("c"), F.col("cell")
    digest = F.shiftrightunsigned(x, CHECK)
    for turn in range(ROUNDS):
        t = turn % TABLES
        pure = (
            (cell >= t * size) & (cell < (t + 1) * size) & (F.abs(c) == 1)
            & (x.bitwiseAND(F.lit((1 << CHECK) - 1)) == _check(digest)) & (cell == _place(digest, t, size))
        )
        row = lambda place, value, count: F.struct(
            place.cast("int").alias("cell"), value.alias("x"), count.cast("long").alias("c")
        )
        taken = F.array(
            row(F.lit(-1), F.lit(0).cast("long"), F.lit(1)),
            *[row(_place(digest, u, size), x, -c) for u in range(TABLES) if u != t],
        )
        step = cells.select(*KEY, "pair", F.explode(F.when(pure, taken).otherwise(F.array(row(cell, x, c)))).alias("r"))
        cells = step.groupBy(*KEY, "pair", F.col("r.cell").alias("cell")).agg(
            F.bit_xor("r.x").alias("x"), F.sum("r.c").alias("c")
        ).filter("x <> 0 OR c <> 0")
    found = F.coalesce(F.sum(F.when(cell == -1, c)), F.lit(0))
    return cells.groupBy(*KEY, "pair").agg(found.alias("found"), F.count_if(cell >= 0).alias("left"))


def _among(rows: DataFrame, wanted: DataFrame | None, columns: list[str]) -> DataFrame:
    """The rows whose key is wanted; all of them without ``wanted``."""
    return rows if wanted is None else rows.join(wanted.select(*columns).distinct(), columns, "left_semi")


def _spread(sides: DataFrame) -> DataFrame:
    """Rows by key over all shuffle partitions, however small they are: cells take far more room."""
    return sides.repartition(int(sides.sparkSession.conf.get("spark.sql.shuffle.partitions")), *KEY)


def differences(sides: DataFrame, cells: int = CELLS) -> DataFrame:
    """``(key, pair, found)``: how many items differ, per document and comparison where any does.

    Comparisons that do not resolve are repeated with sketches ``FACTOR`` times as large, until
    none is left. Paragraph hashes are read from storage each time, for those documents only.
    """
    done, wanted = None, None
    while True:
        spread = _spread(_among(sides, wanted, KEY))
        peeled = _among(peel(subtract(sketches(_items(spread), cells)), cells), wanted, [*KEY, "pair"])
        peeled = staged(peeled, "sketch-peeled")
        whole = peeled.filter("left = 0").select(*KEY, "pair", "found")
        done = whole if done is None else done.unionByName(whole)
        wanted = peeled.filter("left > 0")
        if wanted.isEmpty():
            return done
        cells *= FACTOR


def likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", cells: int = CELLS) -> DataFrame:
    """Per row of ``docs``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A fingerprint is the sketch of a text's paragraphs (its lines), so that equal texts have equal
    ones. Two sketches are subtracted and peeled, which gives the number of paragraphs that differ;
    likeness is the share that both have of all they have: 1 for equal texts (two empty ones, too).

    A NULL text counts as empty. Rows that repeat id and text count as one document for the order
    and are all returned; of one id, texts are ordered by hash. NULL ids come last. A document
    alone is its own next one. Texts of one id are told apart by 64-bit hashes. Other columns
    are not read.
    """
    sides = edited(docs, id_col, text_col)
    first = sides.filter("copy = 1").select(*KEY, "d0", "d1", "d2")
    own = _spread(first.withColumn("d2", F.array().cast("array<bigint>")))
    prints = printed(sketches(_items(own), cells))
    wide = prints.groupBy(*KEY).agg(
        *[F.max(F.when(F.col("side") == s, F.col("fingerprint"))).alias(f"f{s}") for s in (0, 1)]
    )
    apart = differences(first, cells).groupBy(*KEY).agg(
        *[F.max(F.when(F.col("pair") == s, F.col("found"))).alias(f"apart{s}") for s in (1, 2)]
    )
    out = sides.join(wide, KEY, "left").join(apart, KEY, "left")
    sizes = {s: F.size(F.array_distinct(f"d{s}")) for s in range(3)}

    def near(other: int) -> Column:
        both, gap = sizes[0] + sizes[other], F.coalesce(F.col(f"apart{other}"), F.lit(0))
        return F.when(both == 0, F.lit(1.0)).otherwise((both - gap) / (both + gap))

    return out.select(
        F.when(~F.col("no"), F.col("id")).alias("id"),
        F.col("n").alias("n_chars"),
        F.lower(F.hex("sha")).alias("edited_sha256"),
        F.coalesce("f0", F.lit("")).alias("fingerprint"),
        F.coalesce("f1", F.lit("")).alias("edited_fingerprint"),
        near(1).alias("near_edited"),
        near(2).alias("near_next"),
    )
