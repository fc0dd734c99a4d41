"""The set similarity join: crowds of near copies, forced branching, NULLs, short and repeated texts, empty tables."""

import random

import numpy as np
import pytest
from brute import shingle_classes

from raceway.llm import setjoin


def crowd(draw, centres, members, changes):
    """Texts of 40 to 90 words around some centres that share a passage; copies of some; short ones."""
    passage = [f"common{k}" for k in range(25)]
    base = [[*passage, *(f"c{c}w{k}" for k in range(draw.randint(15, 65)))] for c in range(centres)]
    texts = []
    for _ in range(members):
        w = list(draw.choice(base))
        for _ in range(draw.randint(0, changes)):
            w[draw.randrange(len(w))] = f"x{draw.randrange(10**6)}"
        texts.append(" ".join(w) if draw.random() < 0.9 else "\t".join(w).upper())
    texts += draw.choices(texts, k=members // 4) + ["one", "ONE", "one two", "one two three four five", "", " \n "]
    return list(enumerate(texts))


@pytest.mark.parametrize("few,depth", [(32, 6), (1, 2), (1, 6)])
def test_all_components_are_found(spark, monkeypatch, few, depth):
    monkeypatch.setattr(setjoin, "FEW", few)
    monkeypatch.setattr(setjoin, "DEPTH", depth)
    docs = crowd(random.Random(few + depth), 5, 160, 6)
    found = setjoin.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.id: tuple(r)[1:] for r in found.collect()} == shingle_classes(docs)


def test_links_at_the_threshold(spark):
    """Eight of ten shingles shared is a link, and so is four of five; seven of nine is none."""
    def text(name, shared, own):  # a run of n + 3 words has n shingles
        return " ".join([*(f"{name}{k}" for k in range(shared + 3)), *own])

    docs = [
        (0, text("a", 8, [])), (1, text("a", 8, ["p", "q"])), (2, text("b", 7, [])), (3, text("b", 7, ["p", "q"])),
        (4, text("c", 4, [])), (5, text("c", 4, ["p"])), (6, text("d", 3, [])), (7, text("d", 3, ["p"])),
    ]
    rows = setjoin.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.id: r.component_id for r in rows} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7}


def test_edge_rows(spark):
    schema = "doc_id long, text string, node long, path string, size int, digest string, root long"
    long = " ".join(f"w{k % 997} {k}" for k in range(60_000))
    rows = [
        (1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "A  b"), (None, "x y z w v"), (None, "x y z w v"), (None, None),
        (6, "b x y z"), (5, "b X y z"), (7, long), (8, long + " more"),
    ]
    table = spark.createDataFrame([(*r, 1, "p", 2, "d", 3) for r in rows], schema)
    got = sorted((tuple(r) for r in setjoin.near_duplicates(table).collect()), key=str)
    size = 2 * 60_000 - 3
    want = [
        (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (3, 1, 3, True), (4, 1, 3, False), (None, 2, None, True),
        (None, 2, None, True), (None, 0, None, True), (6, 1, 5, False), (5, 1, 5, True), (7, size, 7, True),
        (8, size + 1, 7, False),
    ]
    assert got == sorted(want, key=str)
    assert setjoin.near_duplicates(table.limit(0)).collect() == []


def test_a_full_filter_lets_more_through_but_loses_none(spark):
    ids = spark.createDataFrame([(k * 7 - 50,) for k in range(3000)], "id long")
    for most in (64, 1 << 10, 1 << 20):
        bits = setjoin.id_filter(ids, most)
        spot = setjoin.mixed(np.array([k * 7 - 50 for k in range(3000)]).view(np.uint64)) & np.uint64(64 * len(bits) - 1)
        assert ((bits[(spot >> np.uint64(6)).astype(int)] >> (spot & np.uint64(63))) & np.uint64(1)).all()
