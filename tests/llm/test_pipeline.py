"""The pipeline against a plain version of every stage, and what the registry says."""

import random

import corpus_pipeline
import public_tokenizers
from freightlens.llm.quality_rules import Bands
from freightlens.llm.registry import ORACLES, QUERIES
from freightlens.llm.sentencepieces import Codec, Pieces
from tests.llm import plain
from tests.llm.cases import got, want


def corpus():
    draw = random.Random(11)
    syllables = ["th", "er", "on", "in", "an", "re", "ha", "st", "en", "ti", "É", "ou"]
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, items = prose(60), [(i, prose(20)) for i in range(7)] + [(9, None)]
    rows = [(i, prose(draw.choice([20, 120, 300]))) for i in range(60)]
    rows += [(100 + i, " ".join([*rows[i][1].split()[:-1], word()])) for i in range(20)]
    rows += [(200 + i, f"{prose(60)} {passage} {prose(60)}") for i in range(10)]
    rows += [(300 + i, f"{prose(80)} {items[i][1]} {prose(40)}") for i in range(5)]
    rows += [(400, None), (401, ""), (402, "a b c d e f g h i j\n" * 60), (403, prose(20_000))]
    # without an id: a clean one, a contaminated one, a copy of one with an id; of one id: a clean one and a contaminated one, a row twice
    good = lambda make: next(t for t in iter(make, None) if plain.good(t, Bands())[1])
    rows += [(None, good(lambda: prose(200))), (None, good(lambda: f"{prose(80)} {items[5][1]} {prose(140)}")), (None, rows[40][1])]
    twice = good(lambda: prose(180))
    rows += [(500, good(lambda: prose(200))), (500, good(lambda: f"{prose(90)} {items[6][1]} {prose(140)}")), (502, twice), (502, twice)]
    return rows, items


def one_of_each_group(docs):
    """Of near-duplicates the row with the smallest id, rows without one last; of equal rows one."""
    groups = {}
    for (_, _, group, _), row in zip(plain.near([(i, t) for i, (_, t) in enumerate(docs)], 5), docs):
        groups.setdefault(group, []).append(row)
    return [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in groups.values()]


def test_stages_against_plain_versions(spark, tmp_path):
    rows, items = corpus()
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(d, t) for d, t in rows if plain.good(t, Bands())[1]]
    docs = sorted(one_of_each_group(docs), key=lambda r: (r[0] is not None, r[0] or 0))
    assert sum(d is None for d, _ in docs) == 2 and sum(d == 502 for d, _ in docs) == 1
    docs = [(d, raw.decode("utf-8", "ignore")) for d, _, _, _, raw in plain.without_repeats(docs)]
    docs = [(d, t) for (d, t), c in zip(docs, plain.contamination(docs, items)) if not c[-1]]
    assert 30 < len(docs) < len(rows) - 40 and sum(d is None for d, _ in docs) == 1 and sum(d == 500 for d, _ in docs) == 1
    codec = Codec(Pieces.from_file(public_tokenizers.path("piece_bpe_32k.model")))
    expected = []
    for d, t in docs:
        ids, _ = codec.encode([t])
        expected.append((d, len(ids), plain.crc(ids), True))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert got(out, "doc_id", "n_pieces", "ids_crc32", "round_trip") == want(expected)


def test_stages_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.count() == 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns


def test_registry():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
