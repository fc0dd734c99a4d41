"""Each opN query over the small tables against brute force or its SQL."""

import hashlib

import duckdb
import oracle
import pytest
from brute import (
    alignments, crc, damaged, edited, line_removals, paragraph_likeness, ppm as plain_ppm, ppm_counts, repaired,
    repeated_paragraphs, sha, shingle_classes, simhash, simhash_components, unigram,
)

from raceway.llm import line_dedup, paragraph_dedup, ppm
from raceway.llm.queries import ORACLES, QUERIES

SF_DIR = f"{oracle.DATA}/sf0.001"


@pytest.fixture(scope="module")
def docs():
    found = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY 1").fetchall()
    return found


@pytest.fixture(scope="module")
def result(spark):
    def run(name):
        return [r.asDict() for r in QUERIES[name](spark, SF_DIR).collect()]

    return run


def by_id(rows, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, tmp_path, name):
    assert oracle.compare(spark, oracle.connect(SF_DIR), name, SF_DIR, str(tmp_path)) == []


def test_op1(result, docs):
    rows = result("op1_fingerprints")
    want = {
        i: (len(t), sha(e), pytest.approx(paragraph_likeness(t, e)), pytest.approx(paragraph_likeness(t, n)))
        for i, t, e, n in edited(docs)
    }
    assert by_id(rows, "n_chars", "edited_sha256", "near_edited", "near_next") == want
    text = dict(docs)
    prints = {(text[r["doc_id"]], r["fingerprint"]) for r in rows}
    assert len(prints) == len({t for t, _ in prints}) == len({f for _, f in prints})


def test_op2(result, docs):
    rows = by_id(result("op2_quality"), "held_out", "score", "predicted")
    assert {i: h for i, (h, _, _) in rows.items()} == {i: crc(i, 4) == 2 for i, _ in docs}
    assert all(0 <= s <= 1 and p == (s >= 0.7) for _, s, p in rows.values())
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF_DIR}/labels.parquet'").fetchall())
    good, bad = ([rows[i][1] for i, q in labels.items() if q == k and rows[i][0]] for k in (1, 0))
    assert all(g > b for g in good for b in bad)


def test_op3(result, docs):
    rows = by_id(result("op3_simhash"), "fingerprint", "component_id")
    prints = {i: simhash(t) for i, t in docs}
    classes = simhash_components(prints.values())
    least = {}
    for i, f in prints.items():
        least[classes[f]] = min(i, least.get(classes[f], i))
    assert rows == {i: (f"{f:016x}", least[classes[f]]) for i, f in prints.items()}


def test_op5(result, docs):
    rows = by_id(result("op5_language"), "held_out", "lang_pred", "score")
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF_DIR}/documents.parquet'").fetchall())
    assert {i: h for i, (h, _, _) in rows.items()} == {i: crc(i, 5) == 0 for i, _ in docs}
    assert all(0 <= s <= 1 for _, _, s in rows.values())
    assert sum(rows[i][1] == langs[i] for i in rows if rows[i][0]) >= 0.97 * sum(h for h, _, _ in rows.values())


def test_op7(result, docs):
    rows = result("op7_paragraph_dedup")
    got = {
        (r["doc_id"], r["paragraph"]): ((r["first_doc_id"], r["first_paragraph"]), r["class_size"], r["removed"])
        for r in rows
    }
    assert got == repeated_paragraphs(docs, least=paragraph_dedup.LEAST)
    text = dict(docs)
    for r in rows:
        span = text[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert span == text[r["doc_id"]].split("\n")[r["paragraph"]]


def test_op8(result, docs):
    rows = by_id(result("op8_ppm"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score")
    want = {i: (*w[:4], pytest.approx(w[4])) for i, w in unigram(docs).items()}
    assert rows == want


def test_op8_scores_whole_documents(result, docs):
    model = ppm_counts([ppm.spelled(ppm.words_of(t)) for i, t in docs if crc(i, 7) != 2], ppm.ORDER)
    rows = {r["doc_id"]: r["score"] for r in result("op8_ppm")}
    some = [d for d in docs if crc(d[0], 7) == 2][:40] + docs[:10]
    for i, t in some:
        assert rows[i] == pytest.approx(plain_ppm(None, ppm.spelled(ppm.words_of(t)), ppm.ORDER, model))


def test_op9(result, docs):
    rows = by_id(result("op9_line_dedup"), "removed_lines", "text")
    gone = line_removals(docs, line_dedup.patience, line_dedup.RARE, line_dedup.COMMON, line_dedup.LONG, line_dedup.WORDS)
    for i, t in docs:
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) if gone[i] else t
        assert rows[i] == (gone[i], left)


def test_op10(result, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_truncation()
    library.no_padding()
    rows = by_id(result("op10_bpe"), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, t in docs:
        ids = library.encode(t, add_special_tokens=False).ids
        listed = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i] == (len(ids), listed, sha(library.decode(ids, skip_special_tokens=False)))


def test_op11(result, docs):
    assert by_id(result("op11_setjoin"), "n_shingles", "component_id", "kept") == shingle_classes(docs)


def test_op12(spark):
    for size in ("sf0.001", "sf0.01"):
        table = f"'{oracle.DATA}/{size}/conversations.parquet'"
        rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM {table}").fetchall()
        got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_repair"](spark, f"{oracle.DATA}/{size}").collect()}
        assert got == {c: repaired(v) for c, v in damaged(rows).items()}


def test_op13(result, docs):
    rows = by_id(
        result("op13_alignment"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
    want = {i: (*w[:6], sha(w[6]) if w[6] else "") for (i, _), w in zip(docs, alignments([t for _, t in docs]))}
    assert rows == want
