"""Ranked lexical search against sums by hand, and its sharing plan."""

import math
import random
import re
from collections import Counter

import pytest

from llm.tables import documents, prose
from ridelake.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_by_hand(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked_by_hand(docs, items, most=20):
    """(item, rank, id, score) for lists of (id, text)."""
    docs = [(i, Counter(terms_by_hand(t))) for i, t in docs]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    count, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c, n in docs:
            m = 100 - 25 + (25 * n * count) // length
            worth = ((math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))), c[t]) for t in terms_by_hand(text) if c[t])
            score = sum(w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m)) for w, tf in worth)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(scored)[:most], 1)]
    return out


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, id long, rank int")


def found(spark, docs, items):
    frame = documents(spark, [t for _, t in docs], [i for i, _ in docs])
    rows = lexical.ranked(frame, "doc_id", "text", items_of(spark, [(i, t, 5, 6) for i, t in items]), "item_id", "text").collect()
    return Counter((r["item"], r["rank"], r["id"], r["score"]) for r in rows)


AWKWARD = [(None, None), (1, ""), (2, "..."), (3, "Äpfel ÄPFEL äpfel"), (4, "one, ONE; one"), (4, "one two"), (None, "two one"), (5, "x" * 3000), (6, "one " * 5000)]


def test_ranks_are_those_by_hand(spark):
    docs = AWKWARD + list(enumerate(prose(120, 30, vocabulary=60), 10)) + list(enumerate(prose(30, 30, vocabulary=60), 10))
    items = [(f"q{i}", t) for i, t in enumerate(prose(25, 12, seed=5, vocabulary=60))]
    items += [("q0", "one one two äpfel"), ("none", None), ("empty", ""), ("unknown", "zzzz"), ("long", "x" * 3000), (None, "One two")]
    assert found(spark, docs, items) == Counter(ranked_by_hand(docs, items))


@pytest.mark.parametrize("name, value", [("PART_BYTES", 300), ("BLOCK", 3), ("DOCUMENTS", 7), ("PIECE", 5)])
def test_parts_blocks_and_pieces_change_nothing(spark, monkeypatch, name, value):
    docs = AWKWARD + list(enumerate(prose(60, 20, vocabulary=40), 10))
    items = [(f"q{i}", t) for i, t in enumerate(prose(10, 9, seed=5, vocabulary=40))]
    expected = Counter(ranked_by_hand(docs, items))
    monkeypatch.setattr(lexical, name, value)
    assert found(spark, docs, items) == expected


def test_equal_scores_rank_by_id(spark):
    docs = [(i, "same text") for i in random.Random(1).sample(range(100), 60)] + [(200, "other")]
    rows = found(spark, docs, [("q", "same")])
    assert [r[2] for r in sorted(rows, key=lambda r: r[1])] == sorted(i for i, _ in docs)[:20]


def test_repeated_items_and_documents(spark):
    docs = [(1, "a b"), (1, "a b"), (2, "c")]
    assert found(spark, docs, [("q", "a"), ("q", "a")]) == Counter(ranked_by_hand(docs, [("q", "a")]))


def test_empty_tables(spark):
    assert not found(spark, [], [("q", "a")]) and not found(spark, [(1, "a")], []) and not found(spark, [(1, None)], [("q", "a")])


def test_plan_shares_sums_and_adds_up():
    rng = random.Random(3)
    items = [set(rng.sample(range(30), rng.randrange(1, 20))) for _ in range(40)] + [{1, 2, 3}] * 3
    sums, left = lexical.shared_sums(items, 30)
    held = [{x} for x in range(30)]
    for x, y in sums:
        assert not held[x] & held[y]
        held.append(held[x] | held[y])
    assert [set().union(*(held[x] for x in item)) for item in left] == items
    assert all(sum(map(len, (held[x] for x in item))) == len(whole) for item, whole in zip(left, items))
    additions = len(sums) + sum(len(item) - 1 for item in left)
    assert additions < 0.7 * sum(len(item) - 1 for item in items)
    shared = [frozenset((x, y)) for item in left for x in item for y in item if x < y]
    assert max(Counter(shared).values()) == 1
