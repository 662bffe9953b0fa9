"""Small tables for the operators' tests."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, {} string"


def frame(spark, texts, extra="pos"):
    """Documents with an extra column whose name an operator uses inside."""
    rows = [(i, t, "en", "s", None if t is None else len(t), "x") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA.format(extra))


def odd_texts(seed=0, n=40):
    """Nulls, empty, blank, short, very long, repeated and overlapping texts."""
    rnd = random.Random(seed)
    words = ["alpha", "be", "Gamma,", "delta.", "é", "ß", "omega", "x"]
    passage = " ".join(rnd.choice(words) for _ in range(30))
    texts = [None, "", " \t\n", "one", "one two", passage, passage, passage.upper()]
    for _ in range(n):
        a = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))
        texts.append(rnd.choice([a, a + "\n" + passage, passage + "  " + a, passage[10:90] + "\r" + a]))
    texts.append("la " * 3000)
    texts.append("y" * 20000)
    return [(3 * i - 20, t) for i, t in enumerate(texts)]


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)
