"""Importance resampling, exact copies and source divergence, against plain versions."""

import random

import numpy as np
import pytest
from freightlens.llm import divergence, exact_copies, importance
from freightlens.llm.divergence import Skyband, skybands, source_divergence
from freightlens.llm.exact_copies import build_index, exact_duplicates
from freightlens.llm.importance import importance_sample, segments_of, sorted_ranks
from pyspark.sql import functions as F
from tests.llm import plain
from tests.llm.cases import documents, frame, got, want


def prose(n=200, seed=2):
    draw = random.Random(seed)
    words = [draw.choice(["Ab", "cd", "éf", "g7", "漢"]) * draw.randint(1, 3) for _ in range(60)]
    return [(i, " ".join(draw.choice(words) for _ in range(draw.choice([0, 5, 19, 20, 21, 90])))) for i in range(n)]


@pytest.mark.parametrize("longest, sorting", [(1, {}), (1, {"segment": 10}), (3, {"segment": 7, "samples": 40}), (2, {"segment": 1, "most": 5, "samples": 1})])
def test_importance(spark, longest, sorting):
    rows = prose() + [(None, "one " * 30), (500, None), (501, ""), (502, "\x00 ."), (503, "w" * 100_000 + " " + "x " * 50_000)]
    items = [(i, t) for i, t in prose(20, 9)] + [(99, None)]
    benchmark = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, weight int")
    docs = frame(spark, rows)
    for percent in (10, 100):
        out = importance_sample(docs, benchmark, percent, 500, longest, **sorting)
        assert got(out) == want(plain.importance(rows, items, percent, 500, longest))
    assert got(importance_sample(docs, benchmark.limit(0), 50, 500)) == want(plain.importance(rows, [], 50, 500))
    assert importance_sample(docs.limit(0), benchmark).count() == 0


def test_ranks_of_ties_and_repeated_rows(spark):
    rows = [(i % 7 or None, 3 if i % 3 else i) for i in range(1000)]  # two thirds tie
    scored = spark.createDataFrame([(d, s, i) for i, (d, s) in enumerate(rows)], "doc_id long, score long, row long").repartition(6)
    out = sorted_ranks(scored, 640, 1000, segment=50, samples=300)
    order = sorted(range(1000), key=lambda i: (-rows[i][1], rows[i][0] is None, rows[i][0] or 0, i))
    assert {r.row: r["rank"] for r in out.collect()} == {i: (k + 1 if k < 640 else None) for k, i in enumerate(order)}


def test_segments_split_ties():
    splitters = [(1, 5, 0), (2, 1, 7), (2, 1, 9), (4, 0, 0)]
    keys = [(0, 9, 9), (1, 4, 9), (1, 5, 0), (2, 1, 6), (2, 1, 8), (2, 1, 9), (3, 0, 0), (9, 0, 0)]
    assert segments_of(*np.array(keys).T, splitters).tolist() == [0, 0, 1, 1, 2, 3, 3, 4]


def copies_rows():
    rows = documents()
    return rows + [(2000 + i, " x\ty" + " " * (i % 5)) for i in range(90)] + [(2001, " x\ty "), (None, "x y    "), (None, "x y    "), (3, "\x0b\x0c\r")]


@pytest.mark.parametrize("options", [{}, {"hot_rows": 5}, {"key_bits": 3, "capacity": 4}, {"key_bits": 2, "hot_rows": 10}, {"capacity": 1}])
def test_exact_copies(spark, options):
    rows = copies_rows()
    docs = frame(spark, rows)
    assert got(exact_duplicates(docs, **options)) == want(plain.copies(rows))
    assert exact_duplicates(docs.limit(0), **options).count() == 0


def test_repeated_row_of_one_id_stays_once(spark):
    for hot in (1, 1000):
        out = exact_duplicates(spark.createDataFrame([(4, "a")] * 20 + [(None, "b")] * 3, "doc_id long, text string"), hot_rows=hot)
        assert sorted((r.text_sha256, r.kept) for r in out.collect() if r.kept) == sorted(
            (plain.hashlib.sha256(t).hexdigest(), True) for t in (b"a", b"b"))


def test_directory_splits_only_overfull_buckets(spark):
    keys = spark.createDataFrame([(k << 48, 1) for k in range(400)] + [(-(1 << 63), 1)], "key long, n long")
    found = sorted(tuple(r) for r in exact_copies.directory(keys, 100).collect())
    assert sum(n for *_, n in found) == 401 and all(n <= 100 for *_, n in found)
    assert (1, 1, 1) in found  # the other half of the keys is one bucket: it was never overfull
    spans = sorted((p << (exact_copies.DEEPEST - d), (p + 1) << (exact_copies.DEEPEST - d)) for d, p, _ in found)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    deep = exact_copies.directory(spark.createDataFrame([(k, 1) for k in range(30)], "key long, n long"), 10).collect()
    assert [tuple(r) for r in deep] == [(exact_copies.DEEPEST, 0, 30)]  # no bit tells them apart: an overfull bucket stays


def test_chains_hold_unlike_texts_of_one_key(spark):
    index = build_index(frame(spark, [(i, f"t{i}") for i in range(40)]), key_bits=2)
    chains = index.groupBy("key").agg(F.max("chain").alias("most"), F.countDistinct("text_sha256").alias("n")).collect()
    assert len(chains) <= 4 and all(r.most == r.n for r in chains)


def test_exact_copies_are_native(spark):
    for options in ({}, {"hot_rows": 5}):
        plan = exact_copies._hot if options else exact_copies._owned
        rows = frame(spark, documents()).select("doc_id", F.length("text").alias("n_points"), F.col("text").cast("binary").alias("body"), F.xxhash64("text").alias("key"))
        made = plan(rows) if options else plan(rows, exact_copies.directory(rows.groupBy("key").agg(F.count("*").alias("n")), 10))
        text = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text


def sources():
    draw = random.Random(6)
    words = ["".join(draw.choice("abéñ漢xyz") for _ in range(draw.randint(1, 3))) for _ in range(80)]
    rows = []
    for i in range(400):
        source = draw.choice(["hot"] * 5 + ["s1", "s2", "S3", "é", None])
        own = words[len(source or "") % 2 * 20:][:50]
        rows.append((draw.choice(["en", "de", "", None]), source, " ".join(draw.choice(own) for _ in range(draw.choice([0, 3, 40])))))
    return rows + [("xx", "alone", "A b"), ("yy", "s1", None), ("yy", "s2", "1 2"), ("en", "none", "###"), ("en", "hot", "q" * 5000 + " ab" * 5000)]


@pytest.mark.parametrize("tile, k, min_docs", [(128, 50, 5), (2, 3, 2), (3, 1, 60), (128, 50, 10_000)])
def test_source_divergence(spark, monkeypatch, tile, k, min_docs):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "CHUNK", 7)
    rows = sources()
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, n int, term string").repartition(5)
    assert got(source_divergence(docs, min_docs, k)) == want(plain.divergence(rows, min_docs, k))
    assert source_divergence(docs.limit(0)).count() == 0


def test_skyband_keeps_what_few_dominate(spark):
    draw = random.Random(8)
    terms = [("l", "s", f"{draw.randrange(10**6):06}", draw.randint(1, 30), draw.randint(30, 60), 0) for _ in range(800)]
    terms = list({t[2]: t for t in terms}.values())
    beats = lambda a, b: a[3] >= b[3] and a[4] <= b[4] and a[2] < b[2]
    expected = [t for t in terms if sum(beats(o, t) for o in terms) < 4]
    table = spark.createDataFrame(terms, "lang string, source string, term string, n long, lang_n long, value long")
    assert got(skybands(table.coalesce(1), 4)) == want(expected)
    assert got(skybands(skybands(table.repartition(5), 4).coalesce(1), 4)) == want(expected)
    assert len(expected) < 300 and Skyband(1).add("a", 1)


def test_shares_are_exact(spark):
    n = 4 * 10**15
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(7 * 10**15), F.lit(10**6)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (7 * 10**15 + 5 * 10**6)
    assert importance.noise(3, 1) == importance.noise(3, 1)
