"""Small document tables with the awkward cases every operator must take."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key long, sid long, copy int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeimnorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def texts(seed=5):
    rng = random.Random(seed)
    base, passage = words(rng, 80), words(rng, 40)
    out = [None, "", " \t\n", "one", "one", "A b", "… é ñ", "!!!", words(rng, 9000), base, base, base.upper()]
    for _ in range(12):                                 # near copies
        w = base.split()
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = words(rng, 1)
        out.append(" ".join(w))
    for _ in range(8):                                  # a passage that others share
        out.append(f"{words(rng, rng.randint(3, 60))} {passage} {words(rng, rng.randint(3, 60))}")
    out += ["ab " * 200, "é" * 300, words(rng, 30) + "\n" + words(rng, 5)]
    return out


def documents(spark, rows=None):
    """Rows (doc_id, text, lang, source) with extra columns whose names the operators use."""
    if rows is None:
        rows = [(i, t, ["en", None, "fr"][i % 3], ["a", "b", None, "c"][i % 4]) for i, t in enumerate(texts())]
        rows += [(3, "one", "en", "a"), (None, "a text without number " * 8, None, None), (None, None, None, None)]
    return spark.createDataFrame(
        [(d, t, l, s, len(t or ""), 1, 2, 3, 4) for d, t, l, s in rows], SCHEMA)
