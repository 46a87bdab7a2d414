"""The bounded building blocks against brute force, hot groups included."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from freightlens.operators import distributed
from freightlens.operators.distributed import (
    behind, by_metric, dense_competition_rank, exact_quantile, measured, modal_value, number_rows, order_statistic, previous_value,
    prior_max,
)
from freightlens.operators.effective import effective_join, timeline


def test_number_rows_is_dense_and_ordered(spark):
    names = [f"n{i * 7919 % 1000:04d}" for i in range(1000)]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    got = {r["name"]: r["row_no"] for r in number_rows(df, ["name"]).collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}


def test_modal_value_takes_lowest_on_tie_and_skips_null(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", None), ("a", None), ("a", None), ("b", "z"), ("b", "z"),
         ("b", "q")], "k string, v string")
    assert {r["k"]: r["m"] for r in modal_value(df, ["k"], "v", "m").collect()} == \
        {"a": "x", "b": "z"}


def test_order_statistic_matches_sort_with_negatives_and_hot_key(spark):
    rng = random.Random(7)
    rows = [("hot", rng.randint(-10**12, 10**12), 1) for _ in range(3000)]
    rows += [("hot", 5, 4000)] + [("cold", rng.randint(-50, 50), 1) for _ in range(40)]
    df = spark.createDataFrame(rows, "k string, v bigint, w bigint")
    ranks = [("hot", "a", 1), ("hot", "b", 3500), ("hot", "c", 7000), ("cold", "a", 20)]
    targets = spark.createDataFrame(ranks, "k string, s string, r bigint")
    flat = {}
    for k, v, w in rows:
        flat.setdefault(k, []).extend([v] * w)
    got = {(r["k"], r["s"]): (r["value"], r["below"]) for r in order_statistic(
        df, ["k"], "v", "w", targets, "s", "r").collect()}
    for k, s, r in ranks:
        ordered = sorted(flat[k])
        value = ordered[r - 1]
        assert got[(k, s)] == (value, sum(x < value for x in ordered))


def test_exact_quantile_matches_numpy(spark):
    rng = random.Random(3)
    rows = [(k, round(rng.uniform(-500, 500), 2)) for k in ("a", "b") for _ in range(201)]
    rows += [("a", None), ("one", 4.25)]
    df = spark.createDataFrame(rows, "k string, v double")
    for q in (0.5, 0.75):
        got = {r["k"]: r["q"] for r in exact_quantile(df, ["k"], "v", q, "q").collect()}
        for k in ("a", "b", "one"):
            values = [v for x, v in rows if x == k and v is not None]
            assert abs(got[k] - np.quantile(values, q)) < 1e-9
    whole = exact_quantile(df, [], "v", 0.5, "q").first()["q"]
    assert abs(whole - np.quantile([v for _, v in rows if v is not None], 0.5)) < 1e-9


def test_quantiles_of_several_numbers_at_once_are_exact(spark):
    rng = random.Random(7)
    rows = [(k, rng.random() ** 9 * 10 ** rng.randint(-12, 12), rng.randint(-4, 4)) for k in "ab" for _ in range(301)]
    long = measured(spark.createDataFrame(rows, "k string, x double, y int"), ["k"], {"mx": "x", "my": "y"})
    got = by_metric(exact_quantile(long, ["k", "metric"], "x", 0.5, "m"), ["k"], "m", ["mx", "my"])
    for r in got.collect():
        own = [x for x in rows if x[0] == r.k]
        assert (r.mx, r.my) == (sorted(x[1] for x in own)[150], sorted(x[2] for x in own)[150])  # to the last bit


def _steps(seed):
    rng = random.Random(seed)
    rows = [("hot", i, rng.randint(0, 10**6)) for i in rng.sample(range(20000), 6000)]
    return rows + [(f"g{g}", i, rng.randint(0, 50)) for g in range(20) for i in range(7)]


def test_prior_max_is_the_same_in_blocks_of_any_size(spark):
    rows = _steps(1)
    df = spark.createDataFrame(rows, "g string, s int, v int")
    expected = {}
    for g in {r[0] for r in rows}:
        best = None
        for _, s, v in sorted(r for r in rows if r[0] == g):
            expected[(g, s)] = best
            best = v if best is None else max(best, v)
    for block in (4096, 100, 1):
        got = prior_max(df, "g", "s", "v", "p", block).collect()
        assert {(r["g"], r["s"]): r["p"] for r in got} == expected


def test_rows_behind_meet_only_steps_that_have_some(spark, monkeypatch):
    rows = _steps(1) + [("a", 5, None), (None, 3, 1), ("a", None, 1), ("g1", 3, 2), ("g1", 3, 60)]
    df = spark.createDataFrame(rows, "g string, s int, v int")
    best = {(g, s): max((v for h, t, v in rows if h == g and t is not None and s is not None and t < s and v is not None), default=None)
            for g, s, _ in rows if g}
    expected = sorted(r for r in rows if r[2] is not None and best.get(r[:2]) is not None and r[2] < best[r[:2]])
    for block in (4096, 100, 1):
        assert sorted(map(tuple, behind(df, "g", "s", "v", block).collect())) == expected
    steps = spark.range(40).selectExpr("id AS g", "explode(sequence(0, 4)) AS s").selectExpr("g", "s", "IF(g = 7 AND s = 2, -1, s) AS v")
    met = []
    join = type(df).join
    monkeypatch.setattr(type(df), "join", lambda self, other, *a: met.append(other.count()) or join(self, other, *a))
    assert [tuple(r) for r in behind(steps, "g", "s", "v").collect()] == [(7, 2, -1)]
    assert met == [0, 1]


def test_previous_value_is_the_same_in_blocks_of_any_size(spark):
    rows = _steps(2)
    df = spark.createDataFrame(rows, "g string, s int, v int")
    expected = {}
    for g in {r[0] for r in rows}:
        last = None
        for _, s, v in sorted(r for r in rows if r[0] == g):
            expected[(g, s)] = last
            last = v
    for block in (4096, 100, 1):
        got = previous_value(df, "g", "s", "v", "p", block).collect()
        assert {(r["g"], r["s"]): r["p"] for r in got} == expected


def test_ties_and_nulls_have_one_meaning_in_blocks_of_any_size(spark):
    rows = [("a", 1, 10), ("a", 1, 20), ("a", 2, 5), ("a", 3, None), ("a", 4, 7), ("a", None, 99), (None, 1, 50), (None, 2, 1)]
    df = spark.createDataFrame(rows, "g string, s int, v int")
    best = {("a", 1): None, ("a", 2): 20, ("a", 3): 20, ("a", 4): 20, ("a", None): None, (None, 1): None, (None, 2): None}
    last = {**best, ("a", 3): 5, ("a", 4): None}
    for block in (4096, 2, 1):
        assert {(r["g"], r["s"]): r["p"] for r in prior_max(df, "g", "s", "v", "p", block).collect()} == best
        assert {(r["g"], r["s"]): r["p"] for r in previous_value(df, "g", "s", "v", "p", block).collect()} == last


def test_competition_rank(spark):
    df = spark.createDataFrame([("a", 9.5), ("b", 9.5), ("c", 7.25), ("d", None), ("e", 10.0)],
                               "k string, score double")
    got = {r["k"]: r["rk"] for r in dense_competition_rank(df, "score", "rk").collect()}
    assert got == {"e": 1, "a": 2, "b": 2, "c": 4, "d": None}


def _brute(facts, versions):
    out = {}
    for fid, key, day in facts:
        fit = [v for v in versions if day and v[1] == key and v[2] <= day <= v[3]]
        out[fid] = max(fit, key=lambda v: (v[2], v[0]))[0] if fit else None
    return out


def _check_effective(spark, facts, versions):
    f = spark.createDataFrame(facts, "fid int, k string, d date")
    v = spark.createDataFrame(versions, "vid int, k string, s date, e date")
    got = effective_join(f, v, ["k"], "d", "s", "e", "vid").select("fid", "vid").collect()
    assert len(got) == len(facts)
    assert {r["fid"]: r["vid"] for r in got} == _brute(facts, versions)


def test_effective_join_brute_force_with_nested_and_hot_keys(spark):
    rng = random.Random(11)
    start = dt.date(2020, 1, 1)
    day = lambda: start + dt.timedelta(rng.randint(0, 400))
    versions = []
    for i in range(400):
        a = day()
        # A third of all versions belong to one key.
        key = "hot" if i % 3 == 0 else f"k{i % 40}"
        versions.append((i, key, a, a + dt.timedelta(rng.choice([0, 5, 60, 900]))))
    facts = [(i, "hot" if i % 3 == 0 else f"k{i % 45}", day()) for i in range(900)]
    facts.append((9999, None, day()))
    _check_effective(spark, facts, versions)


def test_nested_versions_make_few_windows(spark):
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(n)
    versions = [(i, "k", day(i), day(4000 - i)) for i in range(200)] + [(500, "k", day(3), day(3)), (501, "k", day(9), day(2))]
    line = timeline(spark.createDataFrame(versions, "vid int, k string, s date, e date"), ["k"], "s", "e", "vid").collect()
    assert len(line) <= 2 * len(versions)
    _check_effective(spark, [(i, "k", day(7 * i)) for i in range(600)] + [(999, "k", day(3)), (998, "k", None)], versions)


def test_effective_join_plain_timeline(spark):
    d = dt.date
    versions = [(1, "a", d(2020, 1, 1), d(2020, 6, 30)), (2, "a", d(2020, 7, 1), d(2099, 12, 31)),
                (3, "b", d(2020, 1, 1), d(2099, 12, 31)), (4, "b", d(2020, 3, 1), d(2099, 12, 31))]
    facts = [(1, "a", d(2020, 6, 30)), (2, "a", d(2020, 7, 1)), (3, "a", d(2019, 1, 1)),
             (4, "b", d(2020, 2, 1)), (5, "b", d(2021, 2, 1)), (6, "c", d(2021, 1, 1))]
    _check_effective(spark, facts, versions)
    known = effective_join(
        spark.createDataFrame(facts, "fid int, k string, d date"),
        spark.createDataFrame(versions, "vid int, k string, s date, e date"),
        ["k"], "d", "s", "e", "vid")
    assert {r["fid"]: r["has_version"] for r in known.collect()}[6] is False
    assert known.filter(F.col("fid") == 3).first()["has_version"] is True


def test_rows_are_marked_by_their_numbers_where_they_are(spark):
    numbers = [0, 1, 7, 8, 32766, 32767, 32768, 65535, 65536, (5 << 33) + 3, (5 << 33) + 32767]
    chosen = {0, 8, 32767, 32768, (5 << 33) + 3}
    rows = spark.createDataFrame([(n, f"text {n}") for n in numbers], "no bigint, what string")
    marks = spark.createDataFrame([(n,) for n in [*chosen, 8]], "no bigint")
    marked = distributed.mark_rows(rows, "no", marks, "hit")
    assert marked.columns == ["no", "what", "hit"]
    assert {r["no"]: r["hit"] for r in marked.collect()} == {n: n in chosen for n in numbers}
    assert "hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()
    assert not any(r["hit"] for r in distributed.mark_rows(rows, "no", marks.limit(0), "hit").collect())


def test_many_bitmaps_meet_the_rows_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(distributed, "BROADCAST_BITMAPS", 0)
    marked = distributed.mark_rows(spark.range(100000), "id", spark.range(0, 100000, 3), "hit")
    assert marked.filter("hit <> (id % 3 = 0)").count() == 0 and marked.count() == 100000
