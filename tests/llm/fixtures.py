"""Small frames with the awkward cases every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_lines long, tie long, shard int, c0 string, ids string, score double, label int, node long"


def words(n, seed=0, vocabulary=None):
    rng = random.Random(seed)
    vocabulary = vocabulary or ["the", "of", "stone", "river", "Ünïcode", "naïve", "walks", "over", "hill,", "end.", "tree", "moon", "lamp", "glass", "cloud"]
    return " ".join(rng.choice(vocabulary) + (str(rng.randrange(50)) if rng.random() < 0.3 else "") for _ in range(n))


def awkward():
    base = words(120, 1)
    near = base.split(" ")
    near[60] = "changed"
    near[61] = "words"
    texts = [
        (0, base), (1, " ".join(near)), (2, base), (3, None), (4, ""), (5, "   \n\t "), (6, "one"), (7, "one"), (7, "one"), (8, "a b c d"),
        (9, words(60, 2) + "\n" + "shared line of many documents here\n" + words(80, 3)), (None, words(90, 4)), (None, words(90, 4)), (10, words(6000, 5)),
        (11, "  double  spaces \n\n and <|endoftext|> </s> 　 wide \x00 nul"), (12, "日本語のテキスト 🙂 é"), (13, "\n"), (14, "The end.\nThe end.\nother\nThe end."),
        (15, "a b   c\x1cd \x85 e"), (16, base.upper()), (17, "x " * 70),
    ]
    texts += [(100 + i, words(30, 50 + i) + "\n  Shared Line of many documents here \nnext " + str(i)) for i in range(12)]
    return [(d, t, "en", "s", len(t or ""), 7, 8, 9, "extra", "ids", 0.5, 1, 3) for d, t in texts]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(3)
