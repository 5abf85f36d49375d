"""Rows that operators must bear: nulls, empty and very long texts, ties, repeated rows, clashing columns."""

import random

WORDS = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, kind string, block int, data binary, _text string, rank int, kept_text string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + (str(rng.randrange(40)) if rng.random() < 0.4 else "") for _ in range(n))


def rows(seed=1, count=60):
    rng = random.Random(seed)
    passage, texts = prose(rng, 60), []
    for i in range(count):
        kind = i % 6
        body = prose(rng, rng.randrange(5, 120))
        if kind == 1:
            body = f"{body} {passage} {prose(rng, 20)}"
        if kind == 2 and texts:
            body = rng.choice(texts)
        if kind == 3 and texts:
            w = rng.choice(texts).split(" ")
            w[rng.randrange(len(w))] = "changed"
            body = " ".join(w)
        texts.append(body)
    texts += ["", " \t\n", "word", "Two words", "Überlänge ñandú çà 漢字 — “ok” 😀", "!!! ??? 123", prose(rng, 9000), "a" * 5000]
    out = [(i, t) for i, t in enumerate(texts)] + [(1000, None), (1001, None)]
    return [(i, t, ("en", "de", None)[i % 3], "s", len(t or ""), 1, "k", 2, b"x", "clash", 3, "clash") for i, t in out]


def odd_docs(spark, seed=1, count=60):
    return spark.createDataFrame(rows(seed, count), SCHEMA)


def repeated(spark):
    """The odd rows, two of them again, and a doc_id with another text and a null one."""
    own = rows()
    return spark.createDataFrame([*own, own[1], own[1], (own[2][0], "another text of the same id", *own[2][2:]), (None, own[3][1], *own[3][2:])], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
