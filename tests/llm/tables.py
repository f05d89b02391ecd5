"""Small tables with the awkward rows that every operator must bear."""

import random

DOC = "doc_id long, text string, source string, row string, n long, v string, id long, size long"


def documents(spark, texts, ids=None, sources=None):
    """Documents with further columns whose names operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    sources = ["a"] * len(texts) if sources is None else sources
    rows = [(i, t, s, "r", 7, "v", 9, 11) for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, DOC)


def prose(count, words, seed=0, vocabulary=400):
    rng = random.Random(seed)
    names = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(names) for _ in range(words)) for _ in range(count)]


def changed(text, places, seed=0):
    rng = random.Random(seed)
    words = text.split(" ")
    for place in rng.sample(range(len(words)), places):
        words[place] = f"new{rng.randrange(10**6)}"
    return " ".join(words)
