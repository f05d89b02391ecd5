"""Near duplicates, benchmark items and chunks against brute force."""

import random
import re
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from llm.tables import DOC, changed, documents, prose

from ridelake.llm import chunks, containment, forest
from ridelake.llm.components import components
from ridelake.llm.shingles import MinHash, Shingler

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} if words else set()


def components_by_hand(ids, texts, share, of):
    sets = [shingles(t) for t in texts]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and of * both >= share * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(ids)):
        groups[find(i)].append(i)
    out = {}
    for members in groups.values():
        low = min((ids[m] for m in members if ids[m] is not None), default=None)
        for m in members:
            out[m] = (len(sets[m]), low)
    return [out[i] for i in range(len(ids))]


def corpus():
    base = prose(60, 60, seed=1)
    star = [changed(base[0], 2, seed=s) for s in range(40)]
    pairs = [changed(t, 1, seed=5) for t in base[10:30]] + [t.upper().replace(" ", "\t ") for t in base[30:35]]
    odd = [None, "", " \n", "one", "One", "one two three", "one two three four five", base[40], base[40], "É a b c d", "é a b c d"]
    long_one = " ".join(prose(30, 600, seed=9))
    return base + star + pairs + odd + [long_one, changed(long_one, 100), "a b c d e " * 300, "a b c d e " * 400]


@pytest.mark.parametrize(("share", "common"), [(85, 17), (80, 8)])
def test_pairs_just_similar_enough_share_a_deepest_prefix(share, common):
    rng = np.random.default_rng(5)
    alone = {17: (2, 1), 8: (1, 1)}[common]
    orders, width = MinHash(forest.trees_for(share, 100) * forest.DEEPEST, forest.SEED), forest.DEEPEST
    missed, missed_by_few = 0, 0
    for _ in range(4000):
        hashes = rng.integers(0, 2**64, common + sum(alone), dtype=np.uint64)
        one, two = (orders.signature(part) for part in (hashes[: common + alone[0]], np.delete(hashes, slice(common, common + alone[0]))))
        met = (one == two).reshape(-1, width).all(axis=1)
        missed += not met.any()
        missed_by_few += not met[: forest.TREES].any()
    assert missed <= 2 and (share >= 85 or missed_by_few > 2)


def test_sketches_have_as_many_trees_as_the_similarity_needs(spark, monkeypatch):
    seen = []
    own = forest.candidate_edges
    monkeypatch.setattr(forest, "candidate_edges", lambda rows: seen.append(len(rows.first()["signature"])) or own(rows))
    docs = documents(spark, prose(6, 30))
    for share in (85, 80):
        forest.near_components(docs, "doc_id", "text", share, 100).count()
    assert [size // (4 * forest.DEEPEST) for size in seen] == [20, 32]


@pytest.mark.parametrize(("share", "of"), [(85, 100), (80, 100), (50, 100)])
def test_components_as_by_hand(spark, share, of):
    texts = corpus()
    ids = [1000 - i for i in range(len(texts))]
    docs = documents(spark, texts, ids=ids)
    rows = forest.near_components(docs, "doc_id", "text", share, of).collect()
    expected = components_by_hand(ids, texts, share, of)
    if share >= 80:
        assert {r["id"]: (r["n_shingles"], r["component"]) for r in rows} == dict(zip(ids, expected))
    else:
        # Below the similarity that the forest is built for, links found are still true links.
        assert len({r["component"] for r in rows}) >= len({c for _, c in expected})
    stay = forest.one_of_each(docs, "doc_id", "text", share, of)
    assert stay.columns == docs.columns
    if share >= 80:
        assert sorted(r["doc_id"] for r in stay.collect()) == sorted({c for _, c in expected})


def test_blocks_of_a_region_find_the_same_links(spark, monkeypatch):
    texts = corpus()
    docs = documents(spark, texts)
    whole = {r["id"]: r["component"] for r in forest.near_components(docs, "doc_id", "text", 85, 100).collect()}
    monkeypatch.setattr(forest, "BLOCK", 200)
    assert {r["id"]: r["component"] for r in forest.near_components(docs, "doc_id", "text", 85, 100).collect()} == whole


def test_repeated_rows_null_ids_and_empty_tables(spark):
    text = prose(1, 40)[0]
    docs = documents(spark, [text, text, text, "", "", None], ids=[3, 3, None, 4, None, 5])
    rows = forest.near_components(docs, "doc_id", "text").collect()
    assert sorted((r["id"] or 0, r["n_shingles"], r["component"] or 0) for r in rows) == [
        (0, 0, 0), (0, 36, 3), (3, 36, 3), (3, 36, 3), (4, 0, 4), (5, 0, 5),
    ]
    stay = forest.one_of_each(docs, "doc_id", "text").collect()
    assert sum(r["text"] == text for r in stay) == 1 and len(stay) == 4
    empty = spark.createDataFrame([], DOC)
    assert forest.near_components(empty, "doc_id", "text").count() == 0
    assert forest.one_of_each(empty, "doc_id", "text").count() == 0


def test_components_of_chains_and_stars(spark):
    names = [f"{i:05}".encode() for i in range(400)]
    edges = [(names[i], names[i + 1]) for i in range(0, 199)] + [(names[399], names[i]) for i in range(200, 399)]
    edges += [(b"z", b"z"), (None, b"y"), (names[3], names[4])]
    found = {bytes(r["v"]): bytes(r["root"]) for r in components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert found == {n: names[0] if n < names[200] else names[200] for n in names}
    assert components(spark.createDataFrame([], "a binary, b binary")).count() == 0


def test_signatures_estimate_similarity():
    text = prose(1, 2000)[0]
    one, two = (np.unique(Shingler().sequence(t)) for t in (text, changed(text, 40)))
    orders = MinHash(2000, 1)
    same = (orders.signature(one) == orders.signature(two)).mean()
    assert same == pytest.approx(len(np.intersect1d(one, two)) / len(np.union1d(one, two)), abs=0.05)


def test_items_as_by_hand(spark):
    rng = random.Random(4)
    items = prose(60, 30, seed=2, vocabulary=3000) + prose(20, 8, seed=3, vocabulary=3000) + prose(5, 200, seed=4, vocabulary=3000)
    items += ["one two", "ONE two", None, "", items[0]]
    hosts = prose(120, 300, seed=6, vocabulary=3000) + prose(3, 30_000, seed=7, vocabulary=3000)
    texts = []
    for i, host in enumerate(hosts):
        words = host.split(" ")
        for _ in range(i % 3):
            item = rng.choice(items[:85])
            at = rng.randrange(len(words))
            words[at:at] = changed(item, rng.choice([0, 0, 1]) if len(item.split()) > 25 else 0, seed=i).upper().split(" ")
        texts.append(" \n".join(words))
    texts += [None, "", "One  two", "one two three"]
    found = containment.found_items(
        documents(spark, texts), "doc_id", "text",
        spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), "item_id", "text",
    )
    expected = set()
    sets = [shingles(t) for t in texts]
    for number, item in enumerate(items):
        own = shingles(item)
        expected |= {(number, d, len(own & s), len(own)) for d, s in enumerate(sets) if own and 5 * len(own & s) >= 4 * len(own)}
    assert len(expected) > 100
    assert {tuple(r) for r in found.collect()} == expected
    docs = documents(spark, texts)
    left = containment.without_items(docs, "text", spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), "item_id", "text")
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - {d for _, d, _, _ in expected}


@pytest.mark.parametrize("words", [5, 6, 7, 9, 12, 13])
def test_short_items_are_never_missed_in_long_documents(words):
    texts = prose(800, 200, seed=words, vocabulary=20_000)
    items = [" ".join(text.split(" ")[i % 190 :][:words]) for i, text in enumerate(texts)]
    index = containment.ItemIndex(list(enumerate(items)), 80, 100)
    whole = [shingles(text) for text in texts]
    wanted = [shingles(item) for item in items]
    for i, text in enumerate(texts):
        shared = len(wanted[i] & whole[i])
        assert {"item": i, "shared": shared, "size": len(wanted[i])} in index.find(text)


def test_short_items_that_lack_some_shingles():
    words = prose(1, 12, seed=3, vocabulary=20_000)[0].split(" ")
    long = prose(1, 60, seed=4, vocabulary=20_000)[0]
    index = containment.ItemIndex([(1, " ".join(words)), (2, " ".join(words[:9]))], 80, 100)
    for first in range(3):
        for last in range(6, 13):
            text = " ".join([long, *words[first:last], long])
            held = [(n, len(shingles(" ".join(own)) & shingles(text)), len(own) - 4) for n, own in ((1, words), (2, words[:9]))]
            assert index.find(text) == [{"item": n, "shared": s, "size": z} for n, s, z in held if 100 * s >= 80 * z]


def test_items_come_in_parts(spark, monkeypatch):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(prose(40, 20))], "item_id long, text string")
    docs = documents(spark, prose(40, 20) + prose(5, 20, seed=8))
    whole = {tuple(r) for r in containment.found_items(docs, "doc_id", "text", items, "item_id", "text").collect()}
    monkeypatch.setattr(containment, "PART_BYTES", 500)
    assert len(containment.item_parts(items, "item_id", "text")) > 5
    assert {tuple(r) for r in containment.found_items(docs, "doc_id", "text", items, "item_id", "text").collect()} == whole
    left = containment.without_items(docs, "text", items, "item_id", "text")
    assert {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in docs.collect()} - {d for _, d, _, _ in whole}
    # A part is dropped before the next one is sent.
    events, sent, drop = [], containment.SentItems, containment.SentItems.drop
    monkeypatch.setattr(sent, "drop", lambda self: events.append("drop") or drop(self))
    monkeypatch.setattr(containment, "SentItems", lambda part: events.append("send") or sent(part))
    containment.found_items(docs, "doc_id", "text", items, "item_id", "text")
    assert events == ["send", "drop"] * (len(events) // 2) and len(events) > 10
    none = items.limit(0)
    assert containment.found_items(docs, "doc_id", "text", none, "item_id", "text").count() == 0
    assert containment.without_items(docs.limit(0), "text", items, "item_id", "text").count() == 0


@pytest.mark.parametrize("kind, keys", [("string", ["q1", None, "q1", "é"]), ("decimal(30,2)", [Decimal("1.50"), None, Decimal(2), Decimal(3)]), ("struct<a: int, b: string>", [(1, "x"), (2, None), None, (1, "x")])])
@pytest.mark.parametrize("part_bytes", [8_000_000, 200])
def test_keys_of_items_are_of_any_type(spark, monkeypatch, kind, keys, part_bytes):
    monkeypatch.setattr(containment, "PART_BYTES", part_bytes)
    texts = prose(3, 20, seed=3)
    texts.append(texts[0])
    items = spark.createDataFrame(list(zip(keys, texts)), f"item_id {kind}, text string")
    docs = documents(spark, [f"so {texts[0]} it is", texts[1], "none of them", texts[2]], ids=[7, None, 9, 9])
    found = containment.found_items(docs, "doc_id", "text", items, "item_id", "text")
    assert found.schema["item"].dataType == items.schema["item_id"].dataType
    rows = sorted(((r["id"], r["item"]) for r in found.collect()), key=str)
    assert rows == sorted([(7, keys[0]), (7, keys[3]), (None, keys[1]), (9, keys[2])], key=str)
    assert [r["text"] for r in containment.without_items(docs, "text", items, "item_id", "text").collect()] == ["none of them"]


def cuts_by_hand(data):
    """A cut where the hash of the last bytes is the least nearby, straight from the definition."""
    size, hashes = len(data), []
    for i in range(size):
        h = 0
        for byte in data[max(0, i - chunks.WINDOW + 1) : i + 1]:
            h = (h << 1) + int(chunks.GEAR[byte])
        hashes.append(0xFFFF if data[i] & 0xC0 == 0x80 else h & ((1 << chunks.WINDOW) - 1) & 0xFFFF)
    reach, found = chunks.REACH, [0]
    for i in range(reach, size):
        if hashes[i] < min(hashes[i - reach : i]) and hashes[i] <= min(hashes[i + 1 : i + 1 + reach], default=0xFFFF) and hashes[i] < 0xFFFF:
            found.append(i)
    return [*found, size]


def test_cuts_as_by_hand():
    for text in [*prose(5, 80), "éà 中文 " * 30, "x", "short", "\U0001f600" * 40]:
        assert chunks.cuts(text.encode()) == cuts_by_hand(text.encode())


def test_long_runs_are_cut_between_characters():
    data = ("中" * 10_000).encode()
    bounds = chunks.cuts(data)
    assert all(b - a <= chunks.LONGEST for a, b in zip(bounds, bounds[1:])) and bounds[-1] == len(data)
    assert all(data[a:b].decode() for a, b in zip(bounds, bounds[1:]))


def test_shared_passages_are_found_and_clean_documents_left_alone(spark):
    passages = prose(12, 60, seed=20, vocabulary=2000)
    clean = prose(40, 150, seed=21, vocabulary=2000)
    texts, shared = [], set()
    for i, host in enumerate(clean):
        words = host.split(" ")
        if i % 2:
            words[40 + i : 40 + i] = passages[i // 2 % 6].split(" ")
            shared.add(i)
        texts.append(" ".join(words))
    within = passages[9] + " and then once more " + passages[9]
    texts += [None, "", "été", within]
    docs = documents(spark, texts)
    rows = chunks.repeated_passages(docs, "doc_id", "text").collect()
    assert {r["id"] for r in rows} == shared
    first = {min(i for i in shared if i // 2 % 6 == p) for p in range(6)}
    assert {r["id"] for r in rows if r["n_dropped"] == 0} == first
    kept = {r["row"]["doc_id"]: r["kept"] for r in chunks.without_repeats(docs, "doc_id", "text").collect()}
    assert len(kept) == len(texts)
    for i, text in enumerate(texts):
        gone = sum(r["n_dropped"] for r in rows if r["id"] == i)
        assert len((kept[i] or "").encode()) == len((text or "").encode()) - gone
        if i not in shared or i in first:
            assert kept[i] == (text or "")


def passages_by_hand(docs, cuts):
    """``(id, start, bytes, dropped bytes)`` of the passages that documents ``(id, text)`` share, straight from the definition."""
    docs = sorted({(i, text or "") for i, text in docs})
    pieces, owners = [], defaultdict(dict)
    for n, (_, text) in enumerate(docs):
        data = text.encode()
        bounds = cuts(data) if data else [0]
        pieces.append([(a, data[a:b]) for a, b in zip(bounds, bounds[1:])])
        for a, piece in pieces[-1]:
            owners[piece].setdefault(n, a)
    found = []
    for n, (i, _) in enumerate(docs):
        run = []
        for a, piece in [*pieces[n], (None, None)]:
            if piece is not None and len(owners[piece]) > 1:
                run.append((a, len(piece), min(owners[piece].items()) != (n, a)))
                continue
            size = sum(length for _, length, _ in run)
            if size >= chunks.PASSAGE:
                found.append((i, run[0][0], size, sum(length for _, length, gone in run if gone)))
            run = []
    return sorted(found)


def test_passages_as_by_hand(spark):
    passages, hosts = prose(5, 70, seed=31, vocabulary=900), prose(30, 90, seed=32, vocabulary=900)
    texts = [f"{host[: 11 * i]} {passages[i % 5]}{host[11 * i :]}" if i % 4 else host for i, host in enumerate(hosts)]
    texts += [None, "", "", hosts[1], hosts[1], "été " * 90, "Été " * 90 + passages[0], f"{passages[2]} | {passages[2]}"]
    found = chunks.repeated_passages(documents(spark, texts), "doc_id", "text").collect()
    expected = passages_by_hand(enumerate(texts), cuts_by_hand)
    assert len(expected) > 20 and sorted((r["id"], r["start"], r["n_bytes"], r["n_dropped"]) for r in found) == expected


def test_copies_keep_one_and_repeated_rows_are_one(spark):
    text = prose(1, 200)[0]
    docs = documents(spark, [text] * 6 + ["other " * 3], ids=[5, 4, 4, 8, None, 9, 1])
    rows = chunks.repeated_passages(docs, "doc_id", "text").collect()
    assert sorted((r["id"] or 0, r["n_bytes"], r["n_dropped"]) for r in rows) == [
        (0, len(text), 0), (4, len(text), len(text)), (5, len(text), len(text)), (8, len(text), len(text)), (9, len(text), len(text)),
    ]
    empty = spark.createDataFrame([], DOC)
    assert chunks.repeated_passages(empty, "doc_id", "text").count() == 0
    assert chunks.without_repeats(empty, "doc_id", "text").count() == 0
