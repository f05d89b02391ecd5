"""Slots, mixing and line runs against plain Python."""

import hashlib
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from llm.tables import DOC, documents, prose
from pyspark.sql import functions as F

from ridelake.llm import line_runs, mixing, slots

BLANKS = " \t\n\x0b\f\r"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def lines_by_hand(texts, enough):
    split = [(t or "").split("\n") for t in texts]
    keys = [[lower(line.strip(BLANKS)) for line in lines] for lines in split]
    often = Counter(k for each in keys for k in set(each))
    out = []
    for lines, each in zip(split, keys):
        kept = [line for line, k in zip(lines, each) if not k or often[k] < enough]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


TEXTS = [
    None, "", "\n", "One line\nTwo\n\n two  ", "one LINE\nÉcole", "ONE line \x1c", " one line\t\nécole", "two\ntwo\nTWO",
    "x" * 50_000 + "\none line", "\n".join(f"line {i}" for i in range(3000)), "TWO\r\nİ", "i̇", "  \t", "one line", "one line",
]


@pytest.mark.parametrize("enough", [1, 2, 4])
@pytest.mark.parametrize("batches", [1, 5])
def test_lines_as_by_hand(spark, enough, batches):
    docs = documents(spark, TEXTS)
    batch = F.pmod(F.col("doc_id"), F.lit(batches))
    rows = line_runs.drop_common_lines(docs, "text", batch, batches, enough).collect()
    found = {r["row"]["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in rows}
    assert found == dict(enumerate(lines_by_hand(TEXTS, enough)))
    assert rows[0]["row"].asDict().keys() == set(docs.columns)


def test_lines_of_repeated_rows_and_none(spark):
    docs = documents(spark, ["a\nb", "a\nb", "a\nc"], ids=[1, 1, None])
    rows = line_runs.drop_common_lines(docs, "text", F.lit(0), 1, 3).collect()
    assert sorted(r["kept"] for r in rows) == ["b", "b", "c"]
    assert line_runs.drop_common_lines(docs.limit(0), "text", F.lit(0), 1, 3).count() == 0


def test_runs_are_compacted_and_leave_out_what_is_known(spark):
    runs = line_runs.LineRuns(spark, enough=3, fanout=2)
    for number in range(5):
        runs.add(spark.createDataFrame([(1, 3), (number + 10, 1), (2, 1)], line_runs.RUN))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    totals = {r["key"]: r["n"] for r in runs.totals().collect()}
    # Key 1 was common after the first batch, key 2 after the third; neither is added again.
    assert totals == {1: 3, 2: 3, **{number + 10: 1 for number in range(5)}}
    assert {r["key"] for r in runs.common().collect()} == {1, 2}


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_names, target = Fraction(sum(sizes.values())), list(names), {}
    while open_names:
        whole = sum(weight[s] for s in open_names)
        over = [s for s in open_names if left * weight[s] / whole > 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / whole for s in open_names}
        for s in over:
            target[s] = Fraction(3 * sizes[s])
            open_names.remove(s)
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 10, "b": 1000, "c": 5}, {"a": 1, "b": 1, "c": 100000, None: 3}, {"a": 0, "b": 0}, {"a": 0, "b": 4}, {"x": 7},
        {"￿": 5, "\U0001f600": 90, "Z": 4, "a": 40, None: 0}, {f"s{i:02}": (i * 37) % 19 * (i + 1) for i in range(23)},
    ],
)
def test_targets_as_by_hand(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    assert found == pytest.approx({s: float(t) for s, t in targets_by_hand(sizes).items()})


def test_mix_takes_what_it_says(spark):
    texts = [None, "", " \t"] + [f"{t}\x0b x" for t in prose(300, 12)] + ["w " * 30_000]
    sources = [("hot", None, "b", "c")[0 if i % 3 else i % 4] for i in range(len(texts))]
    docs = documents(spark, texts, ids=[None if i % 50 == 0 else i for i in range(len(texts))], sources=sources)
    planned = mixing.with_copies(docs, "text", "source", "doc_id").collect()
    assert len(planned) == len(texts)
    by_source = defaultdict(list)
    for row in planned:
        text = (row["row"]["text"] or "").translate({ord(c): " " for c in BLANKS})
        assert row["size"] == len([w for w in text.split(" ") if w])
        rate = row["target"] / row["source_size"] if row["source_size"] else 0
        assert int(rate) <= row["copies"] <= min(3, int(rate) + 1)
        by_source[row["row"]["source"]].append(row)
    mixed = mixing.mix(docs, "text", "source", "doc_id")
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(row["copies"] for row in planned)
    assert mixing.mix(docs, "text", "source", "doc_id").count() == mixed.count()
    assert mixing.mix(docs.limit(0), "text", "source", "doc_id").count() == 0


@pytest.mark.parametrize("rate", [0.25, 0.43])
def test_the_chance_is_the_fraction(spark, monkeypatch, rate):
    # Two long documents among short ones, in many sources: each is a draw of its own.
    sizes, count = [900, 400] + [10] * 120, 400
    monkeypatch.setattr(mixing, "LEVELS", 1)
    sources = spark.range(count).selectExpr("cast(id as string) source")
    each = spark.createDataFrame([(n, str(i)) for i, n in enumerate(sizes)], "size long, identity string")
    rows = sources.join(each, F.lit(True))
    rates = sources.withColumns({"source_size": F.lit(sum(sizes)).cast("long"), "target": F.lit(rate * sum(sizes)), "whole": F.lit(0), "fraction": F.lit(rate)})
    names = {r["identity"]: r["name"] for r in each.select("identity", mixing._name().alias("name")).collect()}
    draws = [(set(r["taken"]), r["chance"]) for r in mixing._drawn(rows, rates, 0).collect()]
    error = 3 * (rate * (1 - rate) / count) ** 0.5
    for place in "01":
        assert abs(sum(names[place] in taken for taken, _ in draws) / count - rate) < error
    assert all(0 <= chance <= 1 for _, chance in draws) and len({chance for _, chance in draws}) > 1
    assert abs(sum(chance for _, chance in draws) / count - rate) < error
    # The short ones make up for the long ones, as far as their chance allows.
    share = min(1, min(rate, 1 - rate) / 2 * 1200 / 900)
    for taken, chance in draws:
        missed = sum(sizes[int(place)] for place in "01" if names[place] in taken) - rate * 1300
        assert missed + (chance - rate) * 1200 == pytest.approx((1 - share) * missed, abs=1e-6)


def test_a_lone_document_is_drawn_by_its_fraction(spark):
    # A thousand sources of one document and the rate of 0.43: each is a draw of its own.
    count = 1000
    rows = spark.range(count).selectExpr("cast(id as string) source", "100L size", "'1' identity")
    rates = spark.range(count).selectExpr("cast(id as string) source", "100L source_size", "143d target", "1L whole", "0.43d fraction")
    taken = mixing._drawn(rows, rates, 0).filter("size(taken) > 0").count()
    assert abs(taken / count - 0.43) < 3 * (0.43 * 0.57 / count) ** 0.5


def test_sources_come_near_their_targets(spark):
    lengths = {"a": [7 + i % 90 for i in range(400)] + [9000], "b": [300 + i % 60 for i in range(60)], "c": [2000] + [5] * 3000}
    texts, sources = zip(*[("w " * n, s) for s, sizes in lengths.items() for n in sizes])
    docs = documents(spark, list(texts), sources=list(sources))
    takes, target, longest = Counter(), {}, {s: max(sizes) for s, sizes in lengths.items()}
    for row in mixing.with_copies(docs, "text", "source", "doc_id").collect():
        source = row["row"]["source"]
        takes[source] += row["copies"] * row["size"]
        target[source] = row["target"]
    for source in lengths:
        assert abs(takes[source] - target[source]) < max(longest[source], 0.02 * target[source])


def test_many_parts_give_the_same_targets(spark):
    sizes = {f"s{i:04}": (i * 7919) % 1013 for i in range(500)}
    rows = spark.createDataFrame([*sizes.items()], "source string, size long")
    conf, found = spark.conf, {}
    old = conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    finally:
        conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert found == pytest.approx({s: float(t) for s, t in targets_by_hand(sizes).items()})


def test_slots_are_level_and_gapless(spark):
    texts = [None, ""] + ["é" * (i % 90) for i in range(4000)] + ["x" * 9000] * 3
    docs = documents(spark, texts, ids=[None if i % 9 == 0 else i // 2 for i in range(len(texts))])
    rows = slots.sharded(docs, "doc_id", "text", 7).collect()
    places, load = defaultdict(list), Counter()
    for row in rows:
        text = row["row"]["text"]
        assert row["size"] == 8 + len((text or "").encode())
        assert row["text_crc32"] == (None if text is None else zlib.crc32(text.encode()))
        places[row["shard"]].append(row["position"])
        load[row["shard"]] += row["size"]
    assert len(rows) == len(texts) and set(places) == set(range(7))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) < 1.01 * min(load.values())
    assert slots.sharded(spark.createDataFrame([], DOC), "doc_id", "text", 7).count() == 0


def test_rebalancing_moves_little():
    sizes = {slot: 100 + int(hashlib.md5(str(slot).encode()).hexdigest(), 16) % 50 for slot in range(1000)}
    old = slots.rebalanced({slot: slot % 10 for slot in range(1000)}, sizes, 10)
    new = slots.rebalanced(old, sizes, 11)
    load = Counter()
    for slot, shard in new.items():
        load[shard] += sizes[slot]
    assert max(load.values()) - min(load.values()) < min(sizes.values())
    assert sum(old[s] != new[s] for s in old) < 1000 / 11 * 1.3


def shards_by_slot(spark, path, version):
    return {r["slot"]: r["shard"] for r in slots.read_map(spark, path, version).collect()}


def test_a_stored_map_is_edited(spark, folder):
    path, texts = f"{folder}/map", ["é" * (i % 90) for i in range(4000)]
    first = slots.sharded(documents(spark, texts), "doc_id", "text", 6, 500, path)
    before = {r["row"]["doc_id"]: r["shard"] for r in first.collect()}
    assert shards_by_slot(spark, path, 0) == {slot: slot % 6 for slot in range(500)}
    # More data and one more shard: the map is edited, so most records stay.
    grown = documents(spark, texts + ["x" * (i % 70) for i in range(400)])
    after = slots.sharded(grown, "doc_id", "text", 7, 500, path).collect()
    old, new = shards_by_slot(spark, path, 1), shards_by_slot(spark, path, 2)
    moved = {slot for slot in new if old[slot] != new[slot]}
    assert 0 < len(moved) < 500 / 7 * 1.5
    for row in after:
        doc = row["row"]["doc_id"]
        assert row["shard"] == new[row["virtual_slot"]]
        if doc in before and row["virtual_slot"] not in moved:
            assert row["shard"] == before[doc]
    load = Counter()
    for row in after:
        load[row["shard"]] += row["size"]
    assert set(load) == set(range(7)) and max(load.values()) < 1.02 * min(load.values())
    # Fewer shards: the slots of the lost ones are dealt to the others. Earlier versions stay.
    fewer = slots.sharded(grown, "doc_id", "text", 3, 500, path)
    assert {r["shard"] for r in fewer.collect()} == {0, 1, 2}
    assert shards_by_slot(spark, path, 1) == old and shards_by_slot(spark, path, None) == shards_by_slot(spark, path, 3)
    with pytest.raises(ValueError, match="500 slots"):
        slots.sharded(grown, "doc_id", "text", 3, 600, path)
