"""The language field: forward-backward against enumeration, held-out accuracy, defined cases."""

import itertools
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.llm import language
from tests.conftest import SF_DIR

DDL = "doc_id long, text string, lang string, lang_pred string"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    k, sizes = 3, [4, 1, 5, 2]
    score = rng.normal(size=(sum(sizes), k)) * 3
    start, change = rng.normal(size=k), rng.normal(size=(k, k))
    begin = np.cumsum([0, *sizes[:-1]])
    found, expected, log_sum = language.forward_backward(score, begin, np.array(sizes), start, change)
    every, changes, total = np.zeros_like(score), np.zeros((k, k)), 0.0
    for b, n in zip(begin, sizes):
        paths = list(itertools.product(range(k), repeat=n))
        weight = np.array([
            np.exp(start[p[0]] + sum(score[b + i, y] for i, y in enumerate(p)) + sum(change[x, y] for x, y in zip(p, p[1:])))
            for p in paths
        ])
        total += np.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum()):
            for i, y in enumerate(p):
                every[b + i, y] += w
            for x, y in zip(p, p[1:]):
                changes[x, y] += w
    assert np.allclose(found, every)
    assert np.allclose(expected, changes)
    assert log_sum == pytest.approx(total)


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "über", "the", "x" * 300, "ññ"]
    model = language.train([("a", ["the", "über"]), ("b", ["ññ", "a"])] * 5, rounds=3)
    together = model.emissions(words)
    assert np.allclose(together, [model.emissions([w])[0] for w in words])


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language.fit(docs)


def test_held_out_accuracy(docs):
    rows = language.digest(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    held_out = [r for r in rows if r.held_out]
    assert len(held_out) > 250
    assert np.mean([r.lang == r.lang_pred for r in held_out]) > 0.98


def test_changes_of_language_are_followed(model):
    assert all(model.change[i, i] > model.change[i].max(initial=-9, where=np.arange(4) != i) for i in range(4))
    _, found = language.Labeller(model).probabilities(["the of and that que los de la und der die ist"])
    names = [model.languages[i] for i in found.argmax(axis=1)]
    assert names[:4] == ["en"] * 4 and names[-4:] == ["de"] * 4 and "es" in names[4:8]


def test_held_out_languages_and_other_columns_change_nothing(docs, model):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    other = docs.withColumn("lang", F.when(held_out, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("s"))
    again = language.fit(other)
    assert again.languages == model.languages and np.array_equal(again.weights, model.weights)


def test_defined_cases(spark, model):
    rows = [
        (1, None, "en", "c"), (2, "", None, "c"), (3, "12 ½ ?! \n", "en", "c"), (4, "the and of " * 20_000, None, None),
        (None, "und der die das nicht ist", "de", "c"), (4, "the and of " * 20_000, None, None), (5, "The.And!of?that\nwas", "en", "c"),
    ]
    docs = spark.createDataFrame(rows, DDL)
    labelled = language.with_language(docs, model, "l", "s")
    assert labelled.columns == [*docs.columns, "l", "s"]
    found = [(r.l, r.s) for r in labelled.collect()]
    assert found[:3] == [("und", 0.0)] * 3
    assert found[3][0] == "en" and found[3] == found[5] and found[4][0] == "de" and found[6][0] == "en"
    kept = language.accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == 4
    nothing = language.fit(spark.createDataFrame([], DDL))
    assert {r.l for r in language.with_language(docs, nothing, "l", "s").collect()} == {"und"}
    assert language.digest(spark.createDataFrame([], DDL)).count() == 0


def test_parts_and_small_caches_change_nothing(model, docs, monkeypatch):
    texts = [r.text for r in docs.limit(40).collect()]
    whole = language.Labeller(model).languages(texts)
    monkeypatch.setattr(language, "PART_CHARS", 100)
    small = language.Labeller(model, capacity=50).languages(texts)
    assert [x[0] for x in whole] == [x[0] for x in small]
    assert np.allclose([x[1] for x in whole], [x[1] for x in small])


def test_a_worker_labels_many_texts_in_little_memory():
    model = language.train([("a", ["der", "und", "die"])] * 5 + [("b", ["the", "and", "of"])] * 5)
    texts = ["der und die the and of. " * 40] * 4000  # 4 MB
    tracemalloc.start()
    found = language.Labeller(model).labels(texts)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(found) == len(texts) and most < 80 << 20


def test_many_languages_do_not_enlarge_what_a_worker_holds():
    model = language.train([(f"l{i}", [f"w{i}".translate(str.maketrans("0123456789", "abcdefghij"))]) for i in range(100)], rounds=1)
    labeller = language.Labeller(model)
    words = ["".join(letters) for letters in itertools.islice(itertools.product("aeioustrnl", repeat=5), 60_000)]
    for i in range(0, len(words), 4_000):
        labeller.numbers(words[i : i + 4_000])
        assert labeller.scores.nbytes + labeller.known.nbytes < 2 * language.HELD_BYTES


def test_long_chains_are_not_cut():
    """Parts that hand over their messages give the probabilities of the whole chain."""
    rng = np.random.default_rng(1)
    for _ in range(60):
        k, sizes = int(rng.integers(1, 5)), rng.integers(1, 40, rng.integers(1, 12))
        n, begin = sizes.sum(), np.cumsum(sizes) - sizes
        score, start, change = rng.normal(size=(n, k)) * 5, rng.normal(size=k), rng.normal(size=(k, k)) * 2
        whole, _, _ = language.forward_backward(score, begin, sizes, start, change)
        for part in (1, 2, 7, 256):
            assert np.allclose(language.posterior(score, begin, start, change, part), whole, atol=1e-10)


def test_a_sentence_of_many_words(spark):
    model = language.train([("a", ["der", "und", "die"])] * 5 + [("b", ["the", "and", "of"])] * 5)
    words = (["der", "und"] * 150 + ["the", "of"] * 400) * 2
    text, found = language.Labeller(model).probabilities([" ".join(words)])
    whole, _, _ = language.forward_backward(
        model.emissions(words), np.array([0]), np.array([len(words)]), model.start, model.change
    )
    assert np.allclose(found, whole, atol=1e-10)
