"""Small corpora with the odd cases: nulls, empty texts, repeats, clashing names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_words long, score double"


def odd_corpus(seed=1, n=60):
    """Rows of SCHEMA.  The last two columns clash with names that operators return."""
    rng = random.Random(seed)
    words = ["alpha", "beta", "Gamma", "éclair", "ß", "x1", "don't", "日本", "a-b", "##", "|", "end."]
    spaces = [" ", "  ", "\n", "\t", "\r\n", " ", "\x0b"]

    def text(k):
        return "".join(rng.choice(words) + rng.choice(spaces) for _ in range(k))

    passage = text(60)
    texts = [text(rng.choice([0, 1, 3, 12, 40, 120])) for _ in range(n)]
    texts += [passage, "lead " + passage, passage + passage, text(9) + passage + text(7)]
    texts += [None, "", " \n ", "  ", "one", text(4000), None, ""]
    texts += texts[:5] + [texts[3]] * 4
    langs = ["en", "de", None, "fr"]
    rows = [
        (i, t, langs[i % 4], ["s0", "s1", None, "S", "é"][i % 5], 7, 0.5) for i, t in enumerate(texts)
    ]
    # A repeated row, a repeated id with another text, and a null id.
    return rows + [rows[4], (rows[6][0], "other text", "en", "s0", 7, 0.5), (None, passage, None, None, 7, 0.5)]


def frame(spark, rows, partitions=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ascii_words(text):
    """Runs of anything but ASCII white space."""
    return (text or "").encode().split()
