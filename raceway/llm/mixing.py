"""Mix sources to target weights: hash-random order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from raceway.llm.common import WORD, plain, position, prefix_sums, restored

#: Hex digits of the random key that name a range; 16**3 ranges per source share its rows evenly.
RANGE_DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, max_epochs: int = 3
) -> DataFrame:
    """Target per source from ``(source, source_size)``, one row per source.

    Sources ordered by code point, NULL last, take ``weights`` in turn. Together they get ``share``
    of all sizes. A target stops at ``max_epochs`` times its source; the excess goes to the others
    by weight. That is one water level: with sources ordered by cap over weight, those below it
    are a prefix, found from prefix sums.
    """
    place = [F.col("source").asc_nulls_last()]
    pick = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    numbered = prefix_sums(sizes, place, {"_n": F.lit(1).cast("long")}, "mix-sources")
    weighted = numbered.select(
        "source",
        "source_size",
        F.element_at(pick, ((F.col("_n") - 1) % len(weights) + 1).cast("int")).alias("_w"),
        (F.col("source_size") * max_epochs).alias("_cap"),
    )
    ratio = [(F.col("_cap") / F.col("_w")).asc(), F.col("source").asc_nulls_last()]
    level = prefix_sums(
        weighted, ratio, {"_caps": F.col("_cap"), "_ws": F.col("_w")}, "mix-levels"
    )
    whole = weighted.agg(F.sum("source_size").alias("size"), F.sum("_w").alias("w")).first()
    amount = share * (whole.size or 0)
    amount = int(amount) if amount == int(amount) else amount
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    room = F.lit(whole.w or 0) - (wide("_ws") - wide("_w"))
    left = F.lit(amount) - (wide("_caps") - wide("_cap"))
    level = level.withColumn("_capped", wide("_cap") * room <= wide("_w") * left)
    capped = level.filter("_capped").agg(
        F.coalesce(F.sum("_cap"), F.lit(0)).alias("cap"), F.coalesce(F.sum("_w"), F.lit(0)).alias("w")
    ).first()
    rest, open_weight = amount - capped.cap, (whole.w or 0) - capped.w
    shared = F.col("_w") * F.lit(rest) / F.lit(max(open_weight, 1))
    return level.select(
        "source",
        "source_size",
        F.when(F.col("_capped"), F.col("_cap").cast("double"))
        .otherwise(shared.cast("double"))
        .alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.0,
    max_epochs: int = 3,
    seed: str = "mix",
    out: str = "_mix",
) -> DataFrame:
    """Every row of ``docs`` with a struct ``out``: size, source_size, target, taken, repeats.

    Each row gets a hash-random key from its id (without one, from its text). The rows of a source are cut in ranges of that
    key, so that a source with most rows still spreads over all tasks; sizes are summed per range,
    then inside each range, and the source is cut exactly at its rounded target. Whole epochs come
    first: ``taken`` is the words the mix takes of the row, ``repeats`` how often the row goes in
    (the row at the cut goes in whole).

    A NULL text has size 0, a NULL source is a source of its own, rows with a NULL id spread like others.
    Rows with equal keys are ordered by size, then text; equal rows are interchangeable.
    Other columns pass through, whatever their names, except one called ``out``.
    """
    if out in docs.columns:
        raise ValueError(f"column {out} is taken")
    name, text, source = (F.col(f"c{position(docs, c)}") for c in (id_col, text_col, source_col))
    named = F.coalesce(name.cast("string"), F.when(text.isNull(), "null").otherwise(F.concat(F.lit("null:"), text)))
    key = F.md5(F.concat(F.lit(f"{seed}:"), named).cast("binary"))
    keyed = plain(docs).select(
        "*",
        key.alias("key"),
        F.substring(key, 1, RANGE_DIGITS).alias("range"),
        source.isNull().alias("none"),
        F.coalesce(source, F.lit("")).alias("source"),
        word_count(text).alias("size"),
        F.xxhash64(text).alias("tie"),
    )
    names = ["none", "source", "range"]
    ranges = keyed.groupBy(*names).agg(F.sum("size").alias("sum"))
    per_source = ranges.groupBy("none", "source").agg(F.sum("sum").alias("source_size"))
    targets = source_targets(
        per_source.select(F.when(~F.col("none"), F.col("source")).alias("source"), "source_size"),
        weights, share, max_epochs,
    ).select(
        F.col("source").isNull().alias("none"),
        F.coalesce("source", F.lit("")).alias("source"),
        "source_size",
        "target",
    )
    earlier = Window.partitionBy("none", "source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    offsets = (
        ranges.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0)))
        .join(targets, ["none", "source"])
        .select(
            *names, "source_size", "target", "before",
            epochs.cast("long").alias("epochs"),
            (budget - epochs * F.col("source_size")).cast("long").alias("cut"),
        )
    )
    running = Window.partitionBy(*names).orderBy("key", "size", "tie").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    summed = keyed.withColumn("run", F.sum("size").over(running)).join(offsets, names)
    size, start, cut = F.col("size"), F.col("before") + F.col("run") - F.col("size"), F.col("cut")
    return summed.select(
        *restored(docs),
        F.struct(
            size.alias("size"),
            F.col("source_size"),
            F.col("target"),
            (F.col("epochs") * size + F.greatest(F.lit(0), F.least(size, cut - start))).cast("long").alias("taken"),
            (F.col("epochs") + F.when((size > 0) & (start < cut), 1).otherwise(0)).cast("int").alias("repeats"),
        ).alias(out),
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options
) -> DataFrame:
    """The rows of the mix: each row of ``docs`` as often as its mix repeats it."""
    roles = [f"c{position(docs, c)}" for c in (id_col, text_col, source_col)]
    drawn = mix(plain(docs), *roles, **options, out="mix")
    times = F.col("mix.repeats")
    repeated = drawn.filter(times > 0).withColumn("mix", F.explode(F.sequence(F.lit(1), times)))
    return repeated.select(*restored(docs))
