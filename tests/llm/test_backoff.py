"""Stupid backoff against dictionaries of tuples."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from footfall.llm import backoff

DDL = "doc_id long, text string, words string, body int"


def words_of(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


def slow(texts, order, alpha):
    docs = [words_of(t) for t in texts]

    def grams(doc):
        return Counter(tuple(doc[i - n : i]) for n in range(1, order + 1) for i in range(n, len(doc) + 1))

    own = [grams(doc) for doc in docs]
    every = sum(own, Counter())
    total = sum(map(len, docs))
    result = []
    for doc, mine in zip(docs, own):
        score = 0
        for i in range(len(doc)):
            factor = 1.0
            for n in range(min(order, i + 1), 1, -1):
                gram = tuple(doc[i + 1 - n : i + 1])
                if every[gram] > mine[gram]:
                    chance = (every[gram] - mine[gram]) / (every[gram[:-1]] - mine[gram[:-1]])
                    break
                factor *= alpha
            else:
                count = every[doc[i],] - mine[doc[i],]
                chance = (count if count else alpha) / max(1, total - len(doc))
            score += round(math.log(factor * chance) * 1e6)
        result.append((len(doc), score / 1e6))
    return result


def rows():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(30)] + ["Über", "über", "a\u00a0b", "THE", "the"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(80)]
    texts += ["", None, " \n", "alone-in-the-corpus", "x y", "copy of a text", "copy of a text", "the " * 5000, "tab\tand\x0bfeed\x0c"]
    return [(i, t, "c", 1) for i, t in enumerate(texts)] + [(None, "no id", "c", 1), (3, texts[3], "c", 1)]


@pytest.mark.parametrize(("order", "group", "chars"), [(3, 6 << 20, 2 << 20), (3, 300, 100), (1, 300, 500), (2, 100, 50), (4, 1000, 10_000)])
def test_equals_dictionaries(spark, monkeypatch, order, group, chars):
    monkeypatch.setattr(backoff, "GROUP_BYTES", group)
    monkeypatch.setattr(backoff, "SLICE_CHARS", chars)
    data = rows()
    docs = spark.createDataFrame(data, DDL)
    found = backoff.scores(docs, order=order).collect()
    expected = slow([t for _, t, *_ in data], order, 0.4)
    key = lambda x: tuple(map(str, x))
    assert sorted(((r.doc_id, r.n_words) for r in found), key=key) == sorted(((d[0], n) for d, (n, _) in zip(data, expected)), key=key)
    by_id = {r.doc_id: r for r in found}
    for (doc_id, *_), (n, score) in zip(data, expected):
        assert by_id[doc_id].log_score == pytest.approx(score, abs=2e-6 * (n + 1))
        assert by_id[doc_id].mean_log == (pytest.approx(by_id[doc_id].log_score / n) if n else None)


def test_word_hashes_do_not_depend_on_the_place():
    texts = [b"one two", b"", b"  two  one\tONE", b"x" * 3000 + b" one"]
    hashes, sizes = backoff.word_hashes(texts)
    assert sizes.tolist() == [2, 0, 3, 2]
    one, two, two2, one2, one3, _, one4 = hashes.tolist()
    assert one == one2 == one3 == one4 and two == two2 and one != two


def test_packed_numbers_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 5000):
        values = np.sort(rng.integers(0, 2**64, n, np.uint64))
        assert (backoff.expand_sorted(backoff.press_sorted(values)) == values).all()
        small = rng.integers(0, 9, n).astype(np.uint32)
        assert (backoff.expand(backoff.press(small), np.uint32) == small).all()


def test_empty_table(spark):
    assert backoff.scores(spark.createDataFrame([], DDL)).count() == 0
