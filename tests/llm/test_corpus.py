"""Operators over the whole corpus, against plain versions."""

import random

import numpy as np
import pytest
from freightlens.llm.components import components
from freightlens.llm.decontamination import decontaminate
from freightlens.llm import near_duplicates as near
from freightlens.llm.near_duplicates import banding, least_equal, linked, near_duplicates
from freightlens.llm.repeats import later_starts, remove_repeats
from tests.llm import plain
from tests.llm.cases import documents, frame, got, want

REPEATS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def repeats_of(rows, length=100):
    import hashlib

    return want((d, n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in plain.without_repeats(rows, length))


@pytest.mark.parametrize("broadcast", [1_000_000, 0])
def test_decontamination(spark, broadcast):
    draw = random.Random(5)
    some = "a B c d É f".split()
    rows = [(i or None, " ".join(draw.choice(some) for _ in range(draw.choice([0, 1, 3, 12, 40])))) for i in range(40)]
    rows += [(3, None), (7, "a-b.c"), (7, "a-b.c"), (8, ""), (9, " ".join(draw.choice(some) for _ in range(5000)))]
    items = [(i, " ".join(draw.choice(some) for _ in range(draw.choice([0, 2, 3, 5, 11, 14])))) for i in range(12)]
    items += [(99, None), (12, "d f"), (12, "c É É"), (100, "a"), (12, "d f")]
    benchmark = spark.createDataFrame([(*i, 1, "w") for i in items], "item_id long, text string, n int, w string")
    out = lambda d, b: decontaminate(d, b, broadcast_rows=broadcast)
    docs = frame(spark, rows)
    assert got(out(docs, benchmark)) == want(plain.contamination(rows, items))
    assert got(out(docs, benchmark.limit(0))) == want(plain.contamination(rows, []))
    assert out(docs.limit(0), benchmark).count() == 0


def test_decontamination_of_whole_table_is_native(spark):
    docs, items = frame(spark, documents()), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    plan = decontaminate(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def edited_rows():
    draw = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    base = [[draw.choice(words) for _ in range(draw.choice([1, 2, 30, 60]))] for _ in range(8)]
    rows = []
    for i in range(300):
        text = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 2, 3, 5, 8])):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((i, " ".join(text)))
    return rows + [(None, rows[0][1]), (None, None), (900, None), (901, ""), (902, " "), (5, rows[7][1]), (903, "only"), (904, "ONLY"), (5, rows[5][1])]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, size):
    rows = edited_rows()
    expected = plain.near(rows, size)
    assert got(near_duplicates(frame(spark, rows), size)) == want(expected)
    assert len({c for _, _, c, _ in expected}) < 280
    assert near_duplicates(frame(spark, rows).limit(0), size).count() == 0


@pytest.mark.parametrize("percent", [50, 60, 90])
def test_near_duplicates_at_other_thresholds(spark, percent):
    rows = edited_rows()
    assert got(near_duplicates(frame(spark, rows), 2, threshold=percent / 100)) == want(plain.near(rows, 2, percent))


def test_bands_follow_the_threshold():
    assert banding(0.8) == (48, 6, 1)
    for t in (0.1, 0.3, 0.5, 0.6, 0.7, 0.85, 0.9, 0.99, 1.0):
        bands, rows, width = banding(t)
        assert bands * rows <= near.HASHES and rows * width >= near.BAND_BYTES and (1 - t**rows) ** bands <= near.BAND_MISS
    for t in (0, 0.01, 1.5):
        with pytest.raises(ValueError):
            banding(t)


@pytest.mark.parametrize("size", [2, 5])
def test_crowded_buckets_meet_by_rare_shingles(spark, size, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 8)
    met = []
    rare = near._rare_buckets
    monkeypatch.setattr(near, "_rare_buckets", lambda *a: met.append(rare(*a)) or met[-1])
    draw = random.Random(9)
    rows = edited_rows() + [(2000 + i, f"{'a b c d e f g h i j k l m n ' * 3}{' '.join(draw.choice('pqrstuvw') + str(draw.randrange(9)) for _ in range(4))}") for i in range(120)]
    assert got(near_duplicates(frame(spark, rows), size)) == want(plain.near(rows, size))
    assert met


def test_unlike_classes_of_one_bucket_cost_their_rare_shingles(spark):
    """Pages of one template, half of them with a near copy: rows grow with the pages."""
    def rows(n):
        draw = np.random.default_rng(n)
        template = draw.integers(0, 2**62, 60)
        own = draw.integers(0, 2**62, (n, 40))
        own[1:n // 2:2] = own[0:n // 2:2]
        own[1:n // 2:2, 0] += 1
        made = [(i, bytearray(np.sort(np.concatenate([template, x])).astype("<u8").tobytes())) for i, x in enumerate(own)]
        sets = spark.createDataFrame(made, "id long, shingles binary")
        return near._rare_buckets(sets.selectExpr("id", "id AS component"), sets, 0.8).groupBy("key").count().selectExpr("sum(count)", "max(count)").first()

    small, large = rows(2_500), rows(5_000)
    assert small == (1250 * 20, 2) and large == (2500 * 20, 2)


def test_shingles_of_a_template_do_not_meet_their_counts(spark, monkeypatch):
    """Copies of one template: their buckets are those without ``HEADS``, and a class joins its own shingles only."""
    draw = np.random.default_rng(4)
    template, own = draw.integers(-2**62, 2**62, 60), draw.integers(0, 40, (600, 12))
    made = [(i, bytearray(np.unique(np.concatenate([template[i % 7:], x])).astype("<i8").tobytes())) for i, x in enumerate(own)]
    sets = spark.createDataFrame(made, "id long, shingles binary")
    crowded = sets.selectExpr("id", "id % 5 AS component")
    joined = []
    cut = near._cut
    monkeypatch.setattr(near, "_cut", lambda heads, percent, of_heads: joined.append((heads, of_heads)) or cut(heads, percent, of_heads))
    buckets = {}
    for most in (near.HEADS, 10, 0):
        monkeypatch.setattr(near, "HEADS", most)
        buckets[most] = sorted(map(tuple, near._rare_buckets(crowded, sets, 0.8).collect()))
    every, ten, none = buckets.values()
    assert every == ten == none and len(none) > 600 * 5
    heads = joined[0][0]
    assert set(heads[:, 0]) >= set(template[7:].tolist()) and [len(h) for h, _ in joined[2:]] == [10, 10, 0, 0]
    tails = sets.selectExpr("id", "id AS component", "shingles").mapInArrow(cut(heads, 80, False), "id long, component long, size long, n_heads long, set long, key long, n long")
    assert tails.count() <= 600 * 12


def test_plausible_pairs_of_a_block_are_counted_together(monkeypatch):
    """A template's copies just under the threshold: no exact comparison a pair, the same links as pair by pair."""
    from freightlens.llm.shingles import signatures

    draw = np.random.default_rng(3)
    template = draw.integers(0, 2**62, 88).astype(np.uint64)
    own = draw.integers(0, 2**62, (200, 12)).astype(np.uint64)
    own[20:40] = own[:20]
    own[20:40, 0] += np.uint64(1)
    sets = [np.unique(np.concatenate([template, x])) for x in own]
    sets[50] = np.unique(own[50])
    signs = signatures(np.concatenate(sets), np.cumsum([0] + [len(x) for x in sets]), 288).astype(np.uint8)
    block = [dict(id=i, component=i, signature=z.tobytes(), shingles=x.tobytes()) for i, (x, z) in enumerate(zip(sets, signs))]
    singly = near.linked
    compared = []
    monkeypatch.setattr(near, "linked", lambda *a: compared.append(1) or singly(*a))
    found = {}
    for percent in (80, 76):
        found[percent] = near._joining(block, block[:100], percent / 100, 1e-9, percent)
    assert not compared
    monkeypatch.setattr(near, "_shared_shingles", lambda *a: range(10**9))
    for percent, links in found.items():
        assert links == near._joining(block, block[:100], percent / 100, 1e-9, percent)
    assert len(compared) > 5000 and len(found[80]) == 20 and len(found[76]) == 198
    common = near._intersections(np.unique(np.concatenate(sets)), sets, sets[:9], 16)
    assert common.tolist() == [[len(np.intersect1d(a, b)) for b in sets[:9]] for a in sets]


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    from freightlens.llm import components as stars

    landed = []
    land = stars.land
    monkeypatch.setattr(stars, "land", lambda df, name: landed.append(name) or land(df, name))
    links = spark.createDataFrame([(7, 1), (9, 1), (1, 9), (8, 2), (4, None), (3, 3)], "a long, b long")
    assert got(components(links)) == [(7, 1), (8, 2), (9, 1)] and landed == ["links"]
    assert got(components(links.union(spark.createDataFrame([(9, 8)], "a long, b long")))) == [(2, 1), (7, 1), (8, 1), (9, 1)]


def test_near_duplicates_without_broadcast(spark):
    rows = documents()
    assert got(near_duplicates(frame(spark, rows), 2, broadcast_ids=0)) == want(plain.near(rows, 2))


def test_sequential_bounds():
    steps = least_equal(288, 0.8, 1e-9)
    assert [n for n, _ in steps] == list(range(32, 289, 32)) and all(a[1] < b[1] for a, b in zip(steps, steps[1:]))
    draw = np.random.default_rng(1)
    equal = (draw.random((20_000, 288)) < 0.8).cumsum(1)  # pairs at the threshold survive
    assert all((equal[:, n - 1] >= k).mean() > 0.9999 for n, k in steps)
    sets = np.arange(10, dtype=np.uint64)
    assert linked(sets[:8], sets, 80) and not linked(sets[:7], sets, 80)


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)] + [(3, None), (5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    expected = want((x, root(x)) for x in list(parent) if root(x) != x)
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert got(found.where("node != component")) == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("length", [7, 20, 100])
def test_repeats(spark, length):
    draw = random.Random(4)
    parts = ["".join(draw.choice("abcdé ") for _ in range(draw.choice([20, 60, 90, 200]))) for _ in range(12)]
    piece = lambda: draw.choice(parts) if draw.random() < 0.7 else draw.choice("xyz") * draw.randint(1, 8)
    rows = [(i, "".join(piece() for _ in range(draw.randint(0, 14)))) for i in range(200)]
    rows += [(1000, "a" * 500), (1001, "a" * 300 + "b"), (1002, "ab" * 400), (1003, None), (1004, ""), (None, parts[3] * 3), (1005, parts[5] * 300)]
    assert got(remove_repeats(frame(spark, rows), length), *REPEATS) == repeats_of(rows, length)


def test_repeats_by_names_and_without_broadcast(spark):
    rows = [(d, t) for d, t in {d: t for d, t in documents()}.items()]
    assert got(remove_repeats(frame(spark, rows), 20, frequent=2, broadcast_ids=0), *REPEATS) == repeats_of(rows, 20)


def test_repeated_rows_are_documents_one_after_the_other(spark):
    rows = [(1, "q" * 150), (1, "q" * 150), (1, "z")]
    assert got(remove_repeats(frame(spark, rows)), *REPEATS) == repeats_of(rows)
    out = remove_repeats(frame(spark, rows))
    assert sorted(r.kept for r in out.collect()) == ["", "q", "z"]
    assert out.select("row.*").columns == [c for c in frame(spark, rows).columns if c != "text"]
    assert remove_repeats(frame(spark, rows).limit(0)).count() == 0


def test_repeats_of_many_rows_without_an_id(spark):
    draw = random.Random(8)
    parts = ["".join(draw.choice("abcdé ") for _ in range(60)) for _ in range(6)]
    rows = [(draw.choice([None, None, 4, 5, i]), "".join(draw.choice(parts) for _ in range(draw.randint(0, 4)))) for i in range(120)] + [(None, None)] * 9
    found = remove_repeats(frame(spark, rows), 50).collect()
    assert len(found) == len(rows)
    by_id = lambda made: sorted((str(d), n) for d, n in made)
    assert by_id((r.doc_id, r.n_bytes) for r in found) == by_id((d, len((t or "").encode())) for d, t in rows)
    # Which of one id's rows loses a passage is by the hash of its text; the corpus in that order is what the plain version reads.
    hashed = spark.createDataFrame(rows, "d long, t string").selectExpr("d", "t", "xxhash64(coalesce(t, '')) AS h").collect()
    order = [(r.d, r.t) for r in sorted(hashed, key=lambda r: (-(2**63) if r.d is None else r.d, r.h))]
    assert got(remove_repeats(frame(spark, rows), 50), *REPEATS) == repeats_of(order, 50)
    for length in (0, 65_536):
        with pytest.raises(ValueError):
            remove_repeats(frame(spark, rows), length)


def test_later_starts_compare_whole_strings():
    contexts = [b"abcdefghijK", b"abcdefghijL", b"abcdefghijK"]
    docs, zero = np.array([3, 2, 1]), np.zeros(3, np.int64)
    which, start = later_starts(contexts, docs, zero, zero, np.array([2, 2, 2]), 10)
    assert sorted(zip(which.tolist(), start.tolist())) == [(0, 0), (0, 1), (1, 0)]
