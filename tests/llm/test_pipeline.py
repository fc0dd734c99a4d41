"""The pipeline's stages against brute force, each on what its predecessor kept."""

import oracle
import pytest
from brute import line_removals, simhash, simhash_components

import __spark_entry__ as entry
import corpus_pipeline
from raceway.llm import line_dedup

SF_DIR = f"{oracle.DATA}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    out.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
        out.append(docs)
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_all_but_the_last_keep_the_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality(spark, stages):
    kept = {i for i, _ in texts(stages[1])}
    assert set(texts(stages[1])) <= set(texts(stages[0]))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    right = sum((r.doc_id in kept) == bool(r.quality) for r in labels)
    assert right >= 0.95 * len(labels)


def test_line_dedup(stages):
    before = texts(stages[1])
    gone = line_removals(before, line_dedup.patience, line_dedup.RARE, line_dedup.COMMON, line_dedup.LONG, line_dedup.WORDS)
    want = [
        (i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]))
        for i, t in before if len(gone[i]) < len(t.split("\n"))
    ]
    assert texts(stages[2]) == want
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_duplicates(stages):
    before = texts(stages[2])
    classes = simhash_components(simhash(t) for _, t in before)
    first = {}
    for i, t in before:
        first.setdefault(classes[simhash(t)], (i, t))
    assert texts(stages[3]) == sorted(first.values())


def test_mix(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(after) <= set(before)
    words = lambda rows: sum(len(t.split()) for _, t in rows)
    assert words(after) == pytest.approx(words(before), rel=0.25)  # whole documents at each source's cut


def test_encoding(stages):
    assert stages[5].count() == stages[4].count()
    assert all(r.lossless and r.n_tokens == len(r.ids) for r in stages[5].collect())


def test_registered():
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}


def test_stages_take_other_rows(spark, tmp_path):
    """NULLs, repeated rows, clashing columns and an empty table, through every stage but the classifier's fit."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, _mix int, _lines int, _fp int, ids int"
    rows = [(1, "a b c", "en", None, 5, 1, 1, 1, 1)] * 2 + [(None, None, None, "s", None, 1, 1, 1, 1), (2, "", None, "s", 0, 1, 1, 1, 1)]
    for k, given in enumerate((rows, [])):
        docs = spark.createDataFrame(given, schema)
        for j, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}-{j}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{j}")
        assert docs.count() >= 0
