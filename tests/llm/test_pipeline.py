"""The pipeline: every stage on what the one before kept, and its result against plain versions."""

import brute
import pytest

import corpus_pipeline
from pagewright.llm import sentencepiece

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs.collect())
    return out


def test_columns(stages):
    for rows in stages[:-1]:
        assert list(rows[0].asDict()) == corpus_pipeline.COLUMNS


def test_bad_documents_go(stages):
    kept = {r.doc_id for r in stages[1]}
    for r in stages[0]:
        n_words, _, _, _, n_repeats = brute.statistics(r.text)
        if n_words < 50 or 100 * n_repeats > 50 * n_words:
            assert r.doc_id not in kept


def test_one_of_each_component_stays(stages):
    expected = {d for d, n, c in brute.components([(r.doc_id, r.text) for r in stages[1]], 5, 80, 100) if d == c}
    assert {str(r.doc_id) for r in stages[2]} == expected


def test_no_passage_is_left_twice(stages):
    before, after = ({r.doc_id: r.text.split() for r in rows} for rows in (stages[2], stages[3]))
    seen = {}
    for doc_id, words in before.items():
        for i in range(len(words) - 49):
            seen.setdefault(tuple(words[i : i + 50]), []).append((doc_id, i))
    for doc_id, words in before.items():
        gone = {i + k for key in seen.values() if len(key) > 1 for d, i in key if d == doc_id for k in range(50)}
        assert after[doc_id] == [w for i, w in enumerate(words) if i not in gone]


def test_mix_takes_whole_documents(stages):
    known = {(r.doc_id, r.text) for r in stages[3]}
    assert all((r.doc_id, r.text) in known for r in stages[4])


def test_ids_decode_to_the_texts(stages):
    table = sentencepiece.load(corpus_pipeline.MODEL_PATH)
    texts = sorted(r.text for r in stages[4])
    import numpy as np

    assert sorted(sentencepiece.decode(np.array(r.ids), table) for r in stages[5]) == texts


def test_run_gives_the_last_stage(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in rows) == sorted((r.doc_id, tuple(r.ids)) for r in stages[5])
