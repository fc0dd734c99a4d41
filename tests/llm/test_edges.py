"""NULLs, empty and long texts, ties, repeated rows, empty tables, other columns; and the methods' parts."""

import random

import numpy as np
import pytest
from brute import (
    bpe as plain_bpe, edited, forward_backward, paragraph_likeness, ppm as plain_ppm, repeated_paragraphs,
    simhash_components, targets,
)
from conftest import plan
from hypothesis import given, settings, strategies as st

from raceway.llm import (
    bpe, exact_dedup, language, line_dedup, mixing, paragraph_dedup, ppm, quality, simhash, sketches,
)
from raceway.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, size int, root long"
LONG = "\n".join(f"line {k} of a long text that goes on and on with words {k * k} and more words" for k in range(3000))
PASSAGE = " ".join(f"word{k}" for k in range(60))
ROWS = [
    (1, None), (2, ""), (3, "   \n\t "), (4, "a"), (4, "a"), (4, "b"), (None, "no id"), (None, None),
    (5, LONG), (6, LONG), (7, PASSAGE), (8, f"{PASSAGE}\nand another line that stands alone here"),
    (9, "<|endoftext|> é 中 \U0001f600 's"), (-3, "1234 5678 ..."), (10, "\n\n\n"), (11, PASSAGE.upper()),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, None if k % 3 else "en", None if k % 4 == 0 else f"s{k % 2}", None, "x", k, k) for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(rows, *columns):
    return sorted((tuple(r[c] for c in columns) for r in rows), key=lambda r: [(v is not None, v) for v in r])


def test_sketches(edge, empty):
    rows = sketches.likeness(edge).collect()
    assert len(rows) == len(ROWS) and sketches.likeness(empty).count() == 0
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    text = {r.id: r for r in rows}
    assert text[2].n_chars == 0 and text[2].near_edited == 1.0
    assert text[5].fingerprint == text[6].fingerprint and text[5].near_next == 1.0
    # The last in order is followed by the first: the rows without an id come last.
    assert text[11].n_chars == len(PASSAGE)


def test_a_small_sketch_is_retried_larger(spark):
    docs = [(k, "\n".join(f"line {n % (k + 3)}" for n in range(9 * k))) for k in range(6)]
    rows = sketches.likeness(spark.createDataFrame(docs, "doc_id long, text string"), cells=2).collect()
    got = {r.id: (r.near_edited, r.near_next) for r in rows}
    assert got == {
        i: (pytest.approx(paragraph_likeness(t, e)), pytest.approx(paragraph_likeness(t, n)))
        for i, t, e, n in edited(docs)
    }


def test_quality(spark, edge, empty):
    labels = spark.createDataFrame([(5, 1), (7, 0), (6, 1), (None, 1), (4, None)], "doc_id long, quality int")
    for model in (quality.fit(edge, labels), quality.fit(empty, labels), quality.fit(edge, labels.filter("quality = 1"))):
        scores = [r[0] for r in edge.select(quality.scorer(model)("text")).collect()]
        assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)


def test_isotonic_levels_rise():
    scores = np.linspace(0, 1, 40)
    knots, levels = quality._isotonic(scores, np.array([random.Random(k).random() < k / 40 for k in range(40)], float), np.ones(40))
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()


def test_simhash(edge, empty):
    rows = simhash.near_duplicates(edge).collect()
    assert len(rows) == len(ROWS) and simhash.near_duplicates(empty).count() == 0
    assert {r.component_id for r in rows if r.fp == 0} == {1}
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns
    kept = [r.doc_id for r in kept.collect()]
    assert set(kept) == {r.component_id for r in rows} and kept.count(4) == 2 and len(kept) == len(set(kept)) + 1
    assert simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("dense", [2, 8, 1000])
def test_simhash_links_keep_all_components(spark, dense):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(20)}
    for _ in range(150):  # crowds around some centres, up to six bits away
        p = draw.choice(sorted(prints)[:4])
        for _ in range(draw.randint(1, 6)):
            p ^= 1 << draw.randrange(64)
        prints.add(p)
    signed = {p: simhash._signed(p) for p in prints}
    table = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(table, dense)).collect()}
    found = {}
    for p, c in simhash_components(prints).items():
        found.setdefault(c, set()).add(roots.get(signed[p], signed[p]))
    assert all(len(r) == 1 for r in found.values()) and len(set.union(*found.values())) == len(found)


def test_simhash_does_not_broadcast_exploded_rows(spark, monkeypatch):
    """Few rows, which Spark would broadcast; their 64 keys each are sized like the rows, so only a hint tells."""
    plans, keep = {}, simhash.staged

    def noted(df, label, *made):
        plans[label] = plan(df)
        return keep(df, label, *made)

    monkeypatch.setattr(simhash, "staged", noted)
    prints = spark.createDataFrame([(k,) for k in range(64)], "fp long")
    found = plan(simhash.links(prints, dense=2))
    assert "BroadcastHashJoin" not in plans["simhash-stars"]
    for joins in (plan(simhash.links(prints)), found):
        compared = [line for line in joins.split("\n") if "Join" in line and "bit_count" in line]
        assert compared and all("SortMergeJoin" in line for line in compared)


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 300)] + [(7, 7000)]
    random.Random(3).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, 7000: 0, **{k: 100 for k in range(100, 300)}}


def test_mixing(edge, empty):
    rows = mixing.mix(edge).select("doc_id", "source", "_mix.*").collect()
    assert len(rows) == len(ROWS) and mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    sizes, taken = {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    mixed = mixing.mixed(edge)
    assert mixed.columns == edge.columns and mixed.count() == sum(r.repeats for r in rows)


@settings(max_examples=4, deadline=None)
@given(sizes=st.lists(st.integers(0, 1000), min_size=1, max_size=9))
def test_targets(spark, sizes):
    named = {f"s{k}": n for k, n in enumerate(sizes)}
    table = spark.createDataFrame(list(named.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(table).collect()}
    assert got == {s: pytest.approx(t) for s, t in targets(named).items()}


def test_language(edge, empty):
    for model in (language.fit(edge), language.fit(empty)):
        rows = language.identify(edge, model).collect()
        assert len(rows) == len(ROWS) and all(0 <= r._lang.score <= 1 for r in rows)
        assert {r._lang.lang for r in rows if r.doc_id in (1, 2, 3, -3)} == {"und"}
    assert language.identify(empty, model).count() == 0


def test_marginals(monkeypatch):
    monkeypatch.setattr(language, "STRETCH", 3)
    draw = np.random.default_rng(0)
    for _ in range(10):
        sizes = draw.integers(1, 9, 3)
        scores, moves = draw.normal(size=(sizes.sum(), 3)), draw.normal(size=(3, 3))
        got, expected = language.marginals(scores, sizes, moves)
        parts = [forward_backward(s, moves) for s in np.split(scores, np.cumsum(sizes)[:-1])]
        assert np.allclose(got, np.vstack([p[0] for p in parts])) and np.allclose(expected, sum(p[1] for p in parts))


def test_code_switched_words(spark):
    english = "the house and the garden with that there when would think"
    german = "das haus und der garten mit dem schule wenn würde denken"
    rows = [(k, e, lang) for k, (e, lang) in enumerate([(english, "en"), (german, "de")] * 8)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    (found,) = language.label_words([f"{english} {german}"], model)
    assert [lang for _, lang in found] == ["en"] * 11 + ["de"] * 11


def weak(body):
    """A digest under which most texts collide."""
    from pyspark.sql import functions as F

    return F.substring(F.sha2(body.cast("binary"), 256), 1, 1)


@pytest.mark.parametrize("digest, files", [(exact_dedup.sha256, 100), (exact_dedup.sha256, 1), (weak, 2)])
def test_exact_dedup(spark, edge, tmp_path, digest, files):
    edge.repartition(3).write.parquet(str(tmp_path / "in"))
    rows = exact_dedup.exact_dedup(spark, str(tmp_path / "in"), digest=digest, max_files=files).collect()
    groups = {}
    for i, t in ROWS:
        groups.setdefault(" ".join(exact(t)), []).append(i)
    want = [
        (i, min((x for x in g if x is not None), default=None), len(g)) for g in groups.values() for i in g
    ]
    got = [(r.at.id, r.keeper.id, r.n) for r in rows]
    order = lambda rows: sorted(rows, key=lambda r: [(v is not None, v or 0) for v in r])
    assert order(got) == order(want)
    assert sum(r.at == r.keeper for r in rows) == len(groups)


def exact(text):
    import re

    return re.split("[\x20\x09-\x0D]+", text or "")


def test_exact_dedup_of_nothing(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "in"))
    assert exact_dedup.exact_dedup(spark, str(tmp_path / "in")).count() == 0


def test_paragraphs(edge, empty):
    rows = paragraph_dedup.repeated_paragraphs(edge).collect()
    assert paragraph_dedup.repeated_paragraphs(empty).count() == 0
    assert pairs([r for r in rows if r.class_id == 7], "id", "paragraph", "class_size", "removed") == [
        (7, 0, 3, False), (8, 0, 3, True), (11, 0, 3, True)
    ]


def test_short_paragraphs(spark):
    lines = [" ".join(f"w{n}x{k}" for k in range(n)) for n in (3, 4, 5, 9, 20, 21)]
    near = lines[4].replace("w20x19", "other")  # 15 of 17 shingles
    docs = [(1, "\n".join(lines)), (2, "\n".join([*lines[::-1], near])), (3, f"{lines[2]} more\n{lines[3].upper()}")]
    got = {
        (r.id, r.paragraph): ((r.class_id, r.class_paragraph), r.class_size, r.removed)
        for r in paragraph_dedup.repeated_paragraphs(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    }
    assert got == repeated_paragraphs(docs, least=5) and {(1, 2), (2, 3), (1, 4), (2, 6), (3, 1)} <= got.keys()
    assert not {(1, 0), (1, 1), (3, 0)} & got.keys()


def test_ppm(edge, empty):
    from pyspark.sql import functions as F

    rows = ppm.score_documents(edge, F.col("doc_id") > 4).select("doc_id", "_lm.*").collect()
    assert len(rows) == len(ROWS) and ppm.score_documents(empty, F.lit(True)).count() == 0
    train = [ppm.spelled(ppm.words_of(t)) for i, t in ROWS if (i or 0) > 4]
    for r in rows:
        if r.doc_id in (2, 4, 9) and r.n_tokens < 3:
            text = next(t for i, t in ROWS if i == r.doc_id)
            assert r.score in [
                pytest.approx(plain_ppm(train, ppm.spelled(ppm.words_of(t)), ppm.ORDER)) for i, t in ROWS if i == r.doc_id
            ], text
    nothing = ppm.score_documents(edge, F.lit(False)).select("doc_id", "_lm.*").collect()
    assert {(r.n_known, r.train_tokens, r.base_score) for r in nothing} == {(0, 0, 0.0)}


@pytest.mark.parametrize("room", [1, 40, 1 << 20])
def test_ppm_uses_all_counts_whatever_the_room(spark, room):
    from pyspark.sql import functions as F

    draw = random.Random(4)
    texts = ["".join(draw.choice("aab bé ") for _ in range(draw.randint(0, 60))) for _ in range(30)] + ["xyz", "", "abzab \U0001f600"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = [ppm.spelled(ppm.words_of(t)) for t in texts[:20]]
    got = {r.doc_id: r.score for r in ppm.score_documents(docs, F.col("doc_id") < 20, room=room).select("doc_id", "_lm.score").collect()}
    assert got == {
        k: pytest.approx(plain_ppm(train, ppm.spelled(ppm.words_of(t)), ppm.ORDER)) for k, t in enumerate(texts)
    }


def test_ppm_returns_other_columns_whatever_their_names(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(
        [(1, "one two", 77, 7, 5, 4), (2, "one", 78, 8, 6, 3)], "doc_id long, text string, _lm_row long, row int, found int, `a.b` int"
    )
    got = ppm.score_documents(docs, F.col("doc_id") == 1).orderBy("doc_id").collect()
    assert got[0].asDict().keys() == {*docs.columns, "_lm"}
    assert [tuple(r)[:6] for r in got] == [(1, "one two", 77, 7, 5, 4), (2, "one", 78, 8, 6, 3)]


def test_line_dedup(edge, empty):
    found = line_dedup.line_dedup(edge)
    rows = found.select("doc_id", "text", "_lines.*").collect()
    assert len(rows) == len(ROWS) and line_dedup.line_dedup(empty).count() == 0
    text = {r[0]: r[1] for r in rows if r[0] not in (4, None)}
    assert text[1] is None and text[2] == "" and text[5] == LONG and text[6] == "" and text[10] == "\n\n\n"
    assert text[7] == PASSAGE and text[8] == "and another line that stands alone here"


def test_long_lines_of_many_texts_are_deleted(spark):
    short, halves = "a short line that many hold", [" ".join(f"{h}{k}" for k in range(10)) for h in "ab"]
    docs = [(k, f"own line of the text number {k}\n{PASSAGE}\nother line of number {k}") for k in range(50)]
    docs += [(100 + k, f"{short}\nown line of text number {100 + k}") for k in range(50)]
    docs += [(200 + k, "\n".join([halves[0], f"own line of text number {200 + k}", halves[1]])) for k in range(50)]
    rows = line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    gone = {r.doc_id: (r._lines.gone, r._lines.partners) for r in rows}
    assert {k: gone[k] for k in range(50)} == {0: ([], []), **{k: ([1], [0]) for k in range(1, 50)}}
    assert {str(gone[100 + k]) for k in range(50)} == {"([], [])"}
    assert {k: gone[200 + k] for k in range(50)} == {0: ([], []), **{k: ([0, 2], [200]) for k in range(1, 50)}}


@pytest.mark.parametrize("holders", [6, 20, 60])
def test_a_block_goes_however_many_hold_it_and_wherever_its_lines_were_seen(spark, holders):
    block = [" ".join(f"word{n}{k}" for k in range(8)) for n in range(4)]
    # Each line of the block was first seen in a text of its own, so no earlier text holds two of them but by the block.
    docs = [(n, f"some other text number {n}\n{x}\nand its end {n}") for n, x in enumerate(block)]
    docs += [(100 + k, "\n".join([f"own line of text {k}", *block, f"own end of text {k}"])) for k in range(holders)]
    rows = line_dedup.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    gone = {r.doc_id: r._lines.gone for r in rows}
    assert all(gone[100 + k] == [1, 2, 3, 4] for k in range(1, holders))
    assert all(gone[n] == [] for n in range(4))


def test_runs_have_enough_words_and_no_place():
    lines, words = np.array([1, 3, 5, 7, 9, 11], np.int64), np.array([9, 9, 0, 9, 30, 9], np.int64)
    # 9 + 9 + 9, then 9 + 9 + 30 and 9 + 30; the line of 30 words is a line, and no run begins with the last.
    assert len(line_dedup.runs(lines, words)) == 3
    moved = line_dedup.runs(np.append([77, 79], lines), np.append([30, 30], words))
    assert set(line_dedup.runs(lines, words)) <= set(moved)
    assert line_dedup.runs(lines[:0], words[:0]).size == 0 and line_dedup.runs(lines, words * 0).size == 0


CLASH = ["__mix_run", "_mix_none", "range", "size", "run", "source_size", "a.b", "_lines_first", "h", "gone", "c0", "TEXT2"]


@pytest.mark.parametrize("apply", [mixing.mix, line_dedup.line_dedup, mixing.mixed, simhash.keep_one])
def test_columns_of_any_name_come_back(spark, apply):
    docs = [(k, f"own text number {k}\n{PASSAGE}", "s", *[f"{c}{k}" for c in CLASH]) for k in range(4)]
    schema = ["doc_id long", "text string", "source string", *[f"`{c}` string" for c in CLASH]]
    df = spark.createDataFrame(docs, ", ".join(schema))
    found = apply(df)
    assert found.columns[: len(df.columns)] == df.columns
    rows = {tuple(r)[0]: tuple(r)[2 : 3 + len(CLASH)] for r in found.collect()}
    assert rows == {d[0]: d[2:] for d in docs if d[0] in rows}
    assert len(rows) == len(docs) or apply is simhash.keep_one and 0 in rows


@settings(max_examples=60, deadline=None)
@given(a=st.lists(st.integers(0, 6), max_size=14), b=st.lists(st.integers(0, 6), max_size=14))
def test_patience_aligns_equal_lines_in_order(a, b):
    kept = line_dedup.patience(a, b)
    assert kept == sorted(set(kept))
    rest = iter(a)
    assert all(b[k] in rest for k in kept)  # a subsequence of both
    assert line_dedup.patience(b, b) == list(range(len(b)))


@pytest.fixture(scope="module")
def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def test_bpe(spark, edge, empty, path):
    codec = bpe.Codec(spark, path)
    ids = codec.encode(edge.select("doc_id", "text"), "text", "ids")
    both = codec.decode(ids, "ids", "back").collect()
    assert len(both) == len(ROWS) and all(r.back == (r.text or "") for r in both)
    assert codec.round_trip(empty, "text", "ids", "back").count() == 0
    with pytest.raises(ValueError):
        codec.encode(edge, "text", "fp")


def test_merges_are_leftmost_of_lowest_rank(path):
    import json

    with open(path, encoding="utf-8") as file:
        spec = file.read()
    vocabulary, letters = bpe.Vocabulary(spec), bpe.byte_letters()
    model = json.loads(spec)["model"]
    ranks = {tuple(m): k for k, m in enumerate(model["merges"])}
    draw = random.Random(2)
    texts = ["".join(draw.choice("aeinrst é") for _ in range(draw.randint(1, 40))).encode() for _ in range(300)]
    got = vocabulary.merge(texts)
    for word, ids in zip(texts, got):
        want = [model["vocab"][p] for p in plain_bpe([letters[b] for b in word], ranks)]
        assert np.frombuffer(ids, "<i4").tolist() == want


def test_a_sample_far_below_the_table_is_not_empty(spark):
    """The share of 4000 in 5 * 10^10 texts, which a scale of a million steps rounds to nothing."""
    from raceway.llm.common import sampled

    ids = spark.range(3_000_000)
    for share, low, high in ((1.0, 3_000_000, 3_000_000), (1e-3, 2700, 3300), (8e-7, 0, 12), (0.0, 0, 0)):
        assert low <= ids.filter(sampled(ids.id, share)).count() <= high
    assert int(4000 / 5e10 * (1 << 62)) > 10**11


def test_lists_of_tokens_are_decoded_at_once():
    import public_tokenizers
    import pyarrow as pa

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    whole = vocabulary.encode(["", "Été 東京 😀 <|endoftext|>  x\n", "word"])
    for lists in (whole, [*whole, vocabulary.encode(["é"])[0][:0], vocabulary.first[[0xC3, 0x28, 0xED, 0xA0, 0x80]].astype("<i4")]):
        stored = bpe._arrays(lists)
        want = [vocabulary.decode(x.tolist()) for x in lists]
        assert vocabulary.decode_lists(stored).to_pylist() == want
        assert vocabulary.decode_lists(stored.slice(1)).to_pylist() == want[1:]
    assert "�" in want[-1] and vocabulary.decode_lists(bpe._arrays([])) == pa.array([], pa.string())


def test_a_word_of_many_bytes_needs_wider_ranks():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    words = [b" the", b"x", b"ononon", b"\xc3\xa9" * 9]
    narrow = [vocabulary._merge(words, 32), vocabulary._merge(words, 1 << 16)]
    assert [w[w >= 0].tolist() for w in narrow[0]] == [w[w >= 0].tolist() for w in narrow[1]]
