"""Small tables with the awkward cases: nulls, empty, very long and repeated rows, odd columns."""

import random

EXTRA = "doc_id long, text string, n_words int, key_id string, `row` string, id int, copy int, signature string, n int"


def documents(seed=1, n=60):
    draw = random.Random(seed)
    words = [draw.choice("abcdéßñ漢") * draw.randint(1, 3) + draw.choice(["", "'s", "n't", ".", "!", " ", "\n", "\t", "Th", "12"]) for _ in range(40)]
    base = [[draw.choice(words) for _ in range(draw.choice([2, 30, 70]))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = list(draw.choice(base))
        for _ in range(draw.choice([0, 1, 2, 4, 9])):
            text[draw.randrange(len(text))] = draw.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(None, rows[0][1]), (None, None), (1000, None), (1001, ""), (1002, " \n\t"), (1003, "only"), (1004, "ONLY"), (1005, "x" * 700),
             (1006, "ab" * 400), (5, rows[7][1]), (6, rows[6][1]), (1007, "<|endoftext|> a<|endoftext|>\x00 b c  "), (1008, "\n".join(["a b c"] * 90)),
             (1009, " ".join(draw.choice(words) for _ in range(20_000)))]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(d, t, i, "k", None, 1, 2, "s", i) for i, (d, t) in enumerate(rows)], EXTRA).repartition(4)


def got(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)
