"""Phrase collocations against counting every run of words."""

import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from footfall.llm import collocations

DDL = "doc_id long, text string, lang string, n int, score string, phrase string"


def brute_force(rows, least=10, max_words=3, absorbed=50, best=2000):
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, max_words + 1):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = set()
    for (lang, words), a in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                inner = (lang, words[i : i + m])
                if 100 * a >= absorbed * candidates[inner]:
                    gone.add(inner)
    result = []
    for lang in n:
        rows = []
        for (own, words), a in candidates.items():
            if own == lang and (own, words) not in gone:
                cuts = []
                for k in range(1, len(words)):
                    l, r = f[lang, words[:k]], f[lang, words[k:]]
                    cuts.append((1_000_000 * a * a // (l * r), k, l, r))
                score, _, l, r = min(cuts)
                phrase = " ".join(words)
                rows.append((-score, -a, phrase.encode(), phrase, l, r))
        for rank, (score, a, _, phrase, l, r) in enumerate(sorted(rows)[:best], 1):
            result.append((lang, rank, phrase, -a, l, r, n[lang], -score))
    return sorted(result)


def mined(spark, rows, partitions=3, **how):
    result = collocations.collocations(spark.createDataFrame(rows, DDL).repartition(partitions), **how)
    assert result.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [kind for _, kind in result.dtypes] == ["string", "bigint", "string"] + ["bigint"] * 5
    return sorted(tuple(r) for r in result.collect())


def some_texts(seed, docs=150, vocabulary=60):
    rng = random.Random(seed)
    words = [f"{c}{i}" for i in range(vocabulary // 3) for c in ("w", "É", "ß")]
    fixed = ["new york city", "of the", "Of The people", "a b a b a"]
    rows = []
    for i in range(docs):
        text = []
        for _ in range(rng.randint(0, 60)):
            text.append(rng.choice(fixed) if rng.random() < 0.3 else words[int(len(words) * rng.random() ** 3)])
            text.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!", " \x0b", "\r\n"]))
        rows.append((i, "".join(text), rng.choice(["en", "en", "fr", None, "und"]), 1, "s", None))
    return rows


@pytest.mark.parametrize("bits, together, chunk", [(11, 64, 8 << 20), (2, 3, 1500)])
def test_equals_counting_all_runs(spark, bits, together, chunk):
    """With small tiles, groups and chunks too, so that all levels of the tree take part."""
    rows = some_texts(bits)
    expected = brute_force(rows)
    assert len(expected) > 30
    assert mined(spark, rows, tiling=collocations.Tiling(bits, together, chunk)) == expected


@pytest.mark.parametrize("max_words, least, best", [(2, 3, 10), (4, 4, 7)])
def test_other_lengths(spark, max_words, least, best):
    rows = some_texts(7)
    assert mined(spark, rows, least=least, max_words=max_words, best=best) == brute_force(
        rows, least, max_words, best=best
    )


def test_defined_cases(spark):
    rows = [(1, None, "en", 1, "s", "p"), (None, "", None, None, None, None), (2, "... ,,", "en", 1, "s", "p")]
    assert mined(spark, rows) == []
    assert mined(spark, []) == []
    copies = [(1, "One two three. One two", "en", 1, "s", "p")] * 12
    found = mined(spark, copies)
    assert found == brute_force(copies)
    assert [r[2] for r in found] == ["one two three"]  # half of "one two" is inside it
    tied = [(i, "b a, a b, é z, z é, \U0001f600 y, ￮ y", "x", 1, "s", "p") for i in range(10)]
    assert mined(spark, tied) == brute_force(tied)
    long = [(1, "deep sea " * 200_000 + "." + "x" * 100_000, None, 1, "s", "p"), (2, "nul \x00 nul \x00 " * 20, "q", 1, "s", "p")]
    assert mined(spark, long) == brute_force(long)


def kept_frames(spark):
    return set(spark.sparkContext._jsc.getPersistentRDDs())


def test_only_phrases_become_files(spark):
    """The chunks, their blobs and the sums, at all levels of the tree, stay on the executors, and not for longer."""
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    files, frames = set(shared.rglob("part-*")), kept_frames(spark)
    rows = some_texts(5)
    assert mined(spark, rows, 12, tiling=collocations.Tiling(2, 3, 1500)) == brute_force(rows)
    tables = {f.parent.name.split("-", 1)[1][:-33] for f in shared.rglob("part-*") if f not in files}
    assert tables == {"words", "word-ids", "totals", "sizes", "ranks-2", "ranks-3", "phrases-2", "phrases-3", "best"}
    assert kept_frames(spark) == frames


def test_frames_are_dropped_when_the_work_fails(spark):
    frames = kept_frames(spark)
    with pytest.raises(ZeroDivisionError), collocations.keeping() as keep:
        assert keep(spark.range(3).withColumn("kept", collocations.F.lit(1))).count() == 3
        assert kept_frames(spark) != frames
        raise ZeroDivisionError
    assert kept_frames(spark) == frames


def test_a_path_is_read_anew(spark, tmp_path):
    for text in ("aa bb", "cc dd", "aa bb"):
        rows = [(i, text, "en", 1, "s", "p") for i in range(10)]
        spark.createDataFrame(rows, DDL).write.mode("overwrite").parquet(str(tmp_path / "docs"))
        found = collocations.collocations(spark.read.parquet(str(tmp_path / "docs"))).collect()
        assert [row.phrase for row in found] == [text]


def test_long_texts_are_cut_between_pieces_only():
    text = b"aa bb, cc dd. ee ff; " * 50 + b"no end " * 30
    parts = list(collocations.parts_of(text, 64))
    assert len(parts) > 10
    assert collocations.words_of(parts) == collocations.words_of([text])
    assert list(collocations.parts_of(b"word " * 100, 64)) == [b"word " * 100]


def test_dense_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(1)
    tiling = collocations.Tiling(bits=6)
    for size in (10, 200, tiling.dense + 1, 5000):
        cells = (rng.random(size) ** 2 * tiling.cells).astype(np.int64)
        weights = rng.integers(1, 9, size)
        expected = Counter()
        for c, w in zip(cells.tolist(), weights.tolist()):
            expected[c] += w
        found = collocations.summed(cells, weights, tiling)
        assert dict(zip(found[0].tolist(), found[1].tolist())) == expected
        found = collocations.summed(cells, None, tiling)
        assert dict(zip(found[0].tolist(), found[1].tolist())) == Counter(cells.tolist())


def test_running_sum_turns_to_addresses():
    rng = np.random.default_rng(2)
    total, expected = collocations.Sum(collocations.Tiling(bits=3)), Counter()
    for _ in range(40):
        cells = np.unique(rng.integers(0, 64, 12))
        total.add(cells, np.full(len(cells), 2))
        for c in cells.tolist():
            expected[c] += 2
    cells, counts = total.result()
    assert total.totals is not None
    assert dict(zip(cells.tolist(), counts.tolist())) == expected


def test_scores_are_exact_beyond_longs(spark):
    a, l, r = 10**13 - 1, 10**13 + 7, 10**14 - 3
    frame = spark.createDataFrame([(a, l, r), (a, a, a), (10, 10**14 - 1, 10**14 - 1)], "a long, l long, r long")
    found = [row[0] for row in frame.select(collocations.score()).collect()]
    assert found == [1_000_000 * a * a // (l * r), 1_000_000, 0]
