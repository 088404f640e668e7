"""Small tables with everything that may be odd, and prose made from a seed."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, _key long"


def prose(seed, n, vocabulary=3000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" + ("." if rng.random() < 0.1 else "")
                    for _ in range(n))


def rows(texts):
    """documents with extra columns whose names operators use themselves."""
    return [(i, t, "en", None, None if t is None else len(t), 7, "k", 1) for i, t in texts]


def odd():
    """Nulls, empties, blanks, ties, repeated rows, a long text, other scripts."""
    long = prose(1, 30_000)
    same = prose(2, 120)
    return [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, same), (5, same), (5, same),
            (None, prose(3, 90)), (None, None), (6, long), (7, long + " end"),
            (8, "日本語 のテキスト " * 40), (9, "a" * 5000), (10, "é́ İ ß ﬁ   x"),
            (11, "no spaces" + "xyz" * 400)]


def frame(spark, texts):
    return spark.createDataFrame(rows(texts), DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)
