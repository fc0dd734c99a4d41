"""Cross-tokenizer alignment: cuts, links, rare pairs by join, special strings, NULLs, repeated rows, empty tables."""

import random

import numpy as np
import public_tokenizers as files
import pytest
from brute import alignments
from hypothesis import given, settings, strategies as st

from raceway.llm import alignment

PATHS = files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
TEXTS = [
    None, "", " ", "a", "hello  world\n\tx", "<|endoftext|> and <s> </s><unk>", "naïve café \U0001f600\U0001f469‍\U0001f467 中文字",
    "▁ is not a space", "tail ▁", "tail ", "tail\n ", "a\n  b \n c\u00a0 d\x1c e", "x\u3000 y\u2028 z  ", "x" * 300, " leading", "trailing  \n\n", "\r\n\x00\x01 1234567,89.00", "Ωmega ñandú ßtraße",
    "same text twice", "same text twice", "é ﬁ Å", " ".join(f"word{k} {k * k}" for k in range(2000)),
]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.randoms(use_true_random=False))
def test_groups_lie_between_shared_ends(sizes, draw):
    ends_a = np.cumsum(sizes).tolist()
    ends_b = sorted({draw.randint(1, ends_a[-1]) for _ in range(draw.randint(0, 40))} | {ends_a[-1]})
    shared = sorted(set(ends_a) & set(ends_b))
    want, a, b = [], 0, 0
    for e in shared:
        want.append((a, ends_a.index(e) + 1, b, ends_b.index(e) + 1))
        a, b = want[-1][1], want[-1][3]
    assert alignment.groups(ends_a, ends_b) == want
    assert len(np.union1d(ends_a, ends_b)) == len(ends_a) + len(ends_b) - len(shared)


def test_no_tokens_no_groups():
    assert alignment.groups([], []) == []


@pytest.mark.parametrize("room", [1 << 20, 50, 0])
def test_alignment(spark, room):
    rows = [(None if k == 3 else k, t, "x", 1) for k, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pairs string, row int").repartition(3)
    stored = alignment.staged(alignment.align(docs, *PATHS), "test-alignment")
    got = {r.id: tuple(r[c] for c in COLUMNS) for r in alignment.weigh(stored, room).collect()}
    assert got == dict(zip([r[0] for r in rows], alignments(TEXTS)))


def test_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned_counts(docs, *PATHS).collect() == []


def test_a_long_text_without_shared_cuts_is_one_group():
    draw = random.Random(1)
    ends_a = np.cumsum([2] * 30_000).tolist()
    ends_b = [1, *(e + 1 for e in ends_a[:-1] if draw.random() < 0.9), ends_a[-1]]
    assert alignment.groups(ends_a, ends_b) == [(0, len(ends_a), 0, len(ends_b))]


def test_stretches_give_what_whole_texts_give():
    """Cutting before spaces changes nothing, as no piece of B holds a space after a letter."""
    both, draw = alignment.Tokenizers(*PATHS), random.Random(3)
    assert both.apart
    letters = ["a", "B", "é", "中", "\U0001f600", " ", " ", "  ", "\n", "\t", "'s", "1", ".", "<s>", "\u00a0", "\x1d"]
    texts = ["".join(draw.choices(letters, k=draw.randint(1, 60))) for _ in range(400)]
    cut = both.align(texts)
    both.apart, both.known = False, {}
    for parts, whole in zip(cut, both.align(texts)):
        assert [sum(s[k] for s in parts) for k in range(3)] == [sum(s[k] for s in whole) for k in range(3)]
        assert ";".join(s[3] for s in parts) == ";".join(s[3] for s in whole)


def test_each_overlap_is_linked_once():
    draw = random.Random(2)
    for _ in range(200):
        ends_a, ends_b = (sorted({*(draw.randint(1, 30) for _ in range(draw.randint(0, 20))), 30}) for _ in "ab")
        a, b = ([draw.randint(0, 9) for _ in ends] for ends in (ends_a, ends_b))
        begins_a, begins_b = [0, *ends_a], [0, *ends_b]
        want = sorted(
            x << alignment.LOW | y for x, s, e in zip(a, begins_a, ends_a) for y, t, f in zip(b, begins_b, ends_b) if s < f and t < e
        )
        assert sorted(alignment.links(a, b, ends_a, ends_b, alignment.groups(ends_a, ends_b))) == want


def test_stretches_encoded_as_one_text_have_the_ids_they_have_alone():
    both, draw = alignment.Tokenizers(*PATHS), random.Random(4)
    letters = ["a", "B", "é", "中", "\U0001f600", " ", "  ", "\n", "\t", "'s", "1", ".", "<s>", "<|endoftext|>", "\u00a0", "\x1d"]
    cut = [alignment.WORD.split(" " + "".join(draw.choices(letters, k=draw.randint(1, 60)))) for _ in range(300)]
    stretches = sorted({s for parts in cut for s in parts})
    draw.shuffle(stretches)
    alone = [e.ids for e in both.a.encode_batch_fast(stretches, add_special_tokens=False)]
    assert both._encoded(stretches) == alone
    assert both._encoded([" \n", " "]) == [e.ids for e in both.a.encode_batch_fast([" \n", " "], add_special_tokens=False)]


@pytest.mark.parametrize("most", [100_000, 1])
def test_tokens_of_equal_sizes_are_aligned_once(monkeypatch, most):
    """Of 2,000 numbers with few ways to be cut, each way is aligned once while it is remembered; ids differ."""
    both, calls, plain = alignment.Tokenizers(*PATHS), [], alignment.groups
    monkeypatch.setattr(alignment, "SHAPES", most)
    monkeypatch.setattr(alignment, "groups", lambda *ends: calls.append(ends) or plain(*ends))
    found = both.align([" ".join(f"{k * k}x" for k in range(2000))])[0]
    assert len(found) == 2000 and len({s[3] for s in found}) == 2000
    assert most == 1 or len(calls) == len({str(c) for c in calls}) < 200
    sizes = [(both.size_a, both.size_b)]
    for s in found[::50]:
        a, b = ([int(x) for g in s[3].split(";") for x in g.split("|")[side].split(",")] for side in (0, 1))
        assert s == alignment.aligned(a, b, *([*map(t.__getitem__, ids)] for t, ids in zip(sizes[0], (a, b))))


def test_long_stretches_are_not_remembered_as_shapes():
    both = alignment.Tokenizers(*PATHS)
    assert both.align(["ab1" * 100])[0][0][0] > alignment.SHORT and not both.shapes
