"""SimHash groups against brute force over all pairs."""

import random

import numpy as np
import pytest
import xxhash

from footfall.llm import simhash

DDL = "doc_id long, text string, fingerprint string, u int"


def slow_fingerprint(text, width=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, radius):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def texts():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 80))] for _ in range(40)]
    rows = [" ".join(words) for words in base]
    for words in base[:25]:
        for _ in range(4):
            other = list(words)
            other[rng.randrange(len(other))] = rng.choice(vocabulary)
            rows.append(" ".join(other))
    rows += ["", None, " \t", "One", "one", "ONE two", "one\u00a0two", "É é", "a b c", "A  B\nC", "x " * 20_000, "copy it all"]
    return rows + ["copy it all"] * 5


@pytest.mark.parametrize("block", [4096, 7])
@pytest.mark.parametrize("radius", [0, 2, 5])
def test_equals_brute_force(spark, radius, block):
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts())]
    random.Random(5).shuffle(rows)
    result, (fp, component, key) = simhash.simhash_groups(spark.createDataFrame(rows, DDL), radius=radius, block=block)
    assert result.columns == ["doc_id", "text", "fingerprint", "u", fp, component, key]
    found = {r["doc_id"]: (r[fp] % 2**64, r[component]) for r in result.collect()}
    prints = [slow_fingerprint(t) for _, t, *_ in rows]
    roots = slow_components(prints, radius)
    smallest = {}
    for (doc_id, *_), root in zip(rows, roots):
        smallest[root] = min(smallest.get(root, doc_id), doc_id)
    assert found == {doc_id: (p, smallest[root]) for (doc_id, *_), p, root in zip(rows, prints, roots)}


def test_distances_of_bit_planes():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**64, 200, np.uint64)
    near = values[:50] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64))
    planes = simhash.to_planes(values)
    for radius in (0, 1, 2, 3, 6, 7, 20, 31):
        for word in range(planes.shape[1]):
            lanes = simhash.within_radius(near, planes[:, [word] * len(near)], radius)
            for query, mask in zip(near.tolist(), lanes.tolist()):
                for lane, value in enumerate(values[64 * word : 64 * word + 64].tolist()):
                    assert (mask >> lane & 1) == (bin(query ^ value).count("1") <= radius)


def test_long_chains_of_links(spark):
    values = [((1 << i) - 1) for i in range(60)]  # neighbours differ in one bit
    prints = spark.createDataFrame([(v,) for v in values], "fp long")
    roots = simhash.connected(simhash.links(prints, "fp", 1, 4096))
    assert {(r.node, r.root) for r in roots.collect()} == {(v, 0) for v in values[1:]}


def test_one_of_each(spark):
    rows = [(3, "a b c d", "f", 1), (2, "a b c d", "f", 1), (2, "a b c d", "f", 2), (None, "other words here now", "f", 1), (9, None, "f", 1)]
    docs = spark.createDataFrame(rows, DDL)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "9", "None"]
    assert simhash.one_of_each(spark.createDataFrame([], DDL)).count() == 0


def test_whole_table(spark):
    from tests.conftest import SF_DIR

    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in simhash.digest(spark.read.parquet(f"{SF_DIR}/documents.parquet")).collect()}
    prints = [slow_fingerprint(r.text) for r in rows[:300]]
    assert [found[r.doc_id].fingerprint for r in rows[:300]] == [f"{p:016x}" for p in prints]
    every = [int(found[r.doc_id].fingerprint, 16) for r in rows]
    roots, smallest = slow_components(every, 2), {}
    for r, root in zip(rows, roots):
        smallest[root] = min(smallest.get(root, r.doc_id), r.doc_id)
    assert all(found[r.doc_id].component_id == smallest[root] for r, root in zip(rows, roots))
