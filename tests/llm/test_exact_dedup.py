"""Exact deduplication against a dictionary of normal forms."""

import hashlib
import re

from pyspark.sql import functions as F

from footfall.llm import exact_dedup

DDL = "doc_id long, text string, key string, kept string, bucket int"
ROWS = [
    (1, "a b c", "x", "y", 1), (2, "ab\tc", "x", "y", 1), (3, "a  b  c", None, None, None), (4, "a b  c ", "x", "y", 1),
    (5, "", "x", "y", 1), (6, None, "x", "y", 1), (7, " \n", "x", "y", 1), (8, "é", "x", "y", 1), (9, "e\u0301", "x", "y", 1),
    (10, "w" * 300_000, "x", "y", 1), (11, "w " * 300_000, "x", "y", 1), (12, "alone", "x", "y", 1),
    (13, "a\u00a0bc", "x", "y", 1), (None, "abc", "x", "y", 1), (14, "same", "x", "y", 1), (14, "same", "x", "y", 1),
    (20, "tie", "x", "y", 1), (19, "tie", "x", "y", 1),
] + [(100 + i, f"text {i % 40}", "x", "y", i) for i in range(200)]


def brute_force(rows):
    classes = {}
    for doc_id, text, *_ in rows:
        body = text or ""
        classes.setdefault(re.sub(r"[\x20\x09-\x0D]", "", body), []).append((-len(body), doc_id is None, doc_id))
    return {form: (min(found, key=lambda x: x[:2] + (x[2] or 0,))[2], len(found)) for form, found in classes.items()}


def check(spark, rows, capacity):
    result, names = exact_dedup.exact_dedup(spark.createDataFrame(rows, DDL), capacity=capacity)
    assert result.columns == ["doc_id", "text", "key", "kept", "bucket", *names]
    assert len(set(result.columns)) == len(result.columns)
    found = result.collect()
    expected = brute_force(rows)
    assert len(found) == len(rows)
    kept = {}
    for row in found:
        form = re.sub(r"[\x20\x09-\x0D]", "", row["text"] or "")
        assert (row[names[0]], row[names[1]]) == expected[form]
        assert row[names[3]] == hashlib.sha256(form.encode()).hexdigest()
        kept[form] = kept.get(form, 0) + row[names[2]]
        assert not row[names[2]] or row["doc_id"] == row[names[0]]
    assert set(kept.values()) == {1}


def test_equals_brute_force(spark):
    check(spark, ROWS, 100_000)


def test_small_buckets_double_the_directory(spark):
    check(spark, ROWS, 2)


def test_no_bucket_is_overfull(spark):
    chains = exact_dedup.build_chains(spark.createDataFrame(ROWS, DDL), "doc_id", "text")
    levels = exact_dedup.build_directory(chains, 3)
    assert len(levels) > 1
    entries = exact_dedup.build_entries(chains, levels)
    assert entries.groupBy("bucket").count().agg({"count": "max"}).first()[0] <= 3
    assert entries.count() == chains.select("key", "text_sha256").distinct().count()


def test_other_bytes_with_one_key_stay_apart(spark):
    rows = [(7, "sha-a", 3, 2, 5), (7, "sha-b", 4, 1, 1), (7, "sha-a", 9, 1, 8)]
    chains = spark.createDataFrame(rows, "key long, text_sha256 string, n_points int, rows long, first_id long")
    found = exact_dedup.build_entries(chains, exact_dedup.build_directory(chains, 1)).collect()
    assert {(r.text_sha256, r.keep_id, r.group_size) for r in found} == {("sha-a", 8, 3), ("sha-b", 1, 1)}


def test_rows_that_stay(spark):
    docs = spark.createDataFrame(ROWS, DDL)
    kept = exact_dedup.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in brute_force(ROWS).values())


def test_empty_table(spark):
    empty = spark.createDataFrame([], DDL)
    assert exact_dedup.exact_dedup(empty)[0].count() == 0
    assert exact_dedup.one_of_each(empty).count() == 0


def test_the_survivor_does_not_depend_on_the_layout(spark):
    rows = [(1, "same text", "x", str(i), i) for i in range(50)] + [(2, "sametext", "x", "y", 1)] + [(3, "other", "x", "y", 1)] * 5
    kept = set()
    for parts in (1, 3, 8):
        docs = spark.createDataFrame(rows[::-1] if parts == 3 else rows, DDL).repartition(parts)
        survivors = sorted(map(tuple, exact_dedup.one_of_each(docs).collect()))
        result, names = exact_dedup.exact_dedup(docs)
        flagged = sorted(tuple(r)[:5] for r in result.collect() if r[names[2]])
        assert flagged == survivors and len(survivors) == 2
        kept.add(tuple(survivors))
    assert len(kept) == 1


def test_rows_that_repeat_are_spread(spark):
    docs = spark.range(20_000).selectExpr("if(id % 2 = 0, 7, id) AS doc_id", "if(id % 2 = 0, 'same', string(id)) AS text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found, name = exact_dedup.matched(docs, "doc_id", "text", 100_000)
        first = exact_dedup.first_of_repeats(exact_dedup.with_row_hash(found, name, docs.columns), name)
        parts = [r["count"] for r in first.groupBy(F.spark_partition_id()).count().collect()]
        assert max(parts) < 2 * sorted(parts)[len(parts) // 2]
        assert first.filter(name["kept"]).count() == 10_001
        for frame in (first, exact_dedup.one_of_each(docs)):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "REPARTITION_BY_COL" in plan  # between the windows and the join, which can be split
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
