"""The pipeline against its stages by brute force."""

import re

import pytest

import corpus_pipeline
from footfall.llm import language, quality, tokens
from footfall.llm.common import documents
from tests.llm.test_simhash import slow_components, slow_fingerprint
from tests.llm.test_tokens import check_pieces

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, SF_DIR)


def brute_force(spark, docs):
    """What each filtering stage keeps, as lists of rows."""
    kept, rows = [], docs.collect()
    trees = quality.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = [r for r in rows if trees.scores(quality.statistics(r.text)[None])[0] >= 0.5]
    kept.append(rows)
    model = language.fit(spark.createDataFrame(rows, docs.schema))
    found = language.Labeller(model).labels([r.text or "" for r in rows])
    rows = [r for r, (name, score, known) in zip(rows, found) if name != "und" and score >= 0.35 and known >= 0.8]
    kept.append(rows)
    best = {}
    for r in rows:
        form = re.sub(r"[\x20\x09-\x0D]", "", r.text or "")
        best[form] = min(best.get(form, r), r, key=lambda x: (-len(x.text or ""), x.doc_id))
    rows = list(best.values())
    kept.append(rows)
    roots = slow_components([slow_fingerprint(r.text) for r in rows], 2)
    first = {}
    for r, root in zip(rows, roots):
        first[root] = min(first.get(root, r), r, key=lambda x: x.doc_id)
    kept.append(list(first.values()))
    return kept


def test_stages_and_run_equal_brute_force(spark, docs):
    expected = brute_force(spark, docs)
    frame = docs
    for (name, stage), rows in zip(corpus_pipeline.STAGES, expected):
        frame = corpus_pipeline.stored(stage(spark, frame, SF_DIR), f"test-{name}")
        assert frame.columns == COLUMNS, name
        assert sorted(r.doc_id for r in frame.collect()) == sorted(r.doc_id for r in rows), name
    sizes = [len(rows) for rows in expected]
    assert docs.count() > sizes[0] >= sizes[1] > sizes[2] >= sizes[3] > 100
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    last = [(r.doc_id, r.text) for r in expected[-1]]
    assert {p.doc_id for p in pieces} == {doc_id for doc_id, _ in last}
    check_pieces(tokens.load(tokens.word_tokenizer()), last, pieces, 2048)


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "exact_dedup", "simhash", "packing"]


def test_stages_take_odd_tables(spark, docs):
    odd = docs.selectExpr("*", "1 AS score", "'x' AS key", "2 AS component_id", "true AS kept", "'q' AS lang_pred")
    nothing = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in odd.dtypes)
    odd = odd.unionByName(spark.range(2).selectExpr(*nothing.split(", ")))
    for frame in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, frame, SF_DIR)
            if name != "packing":
                assert result.columns == odd.columns
            assert (result.count() > 0) == (frame is odd), name
