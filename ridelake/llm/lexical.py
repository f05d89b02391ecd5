"""Ranked lexical search of many items at once, with the sums that items share added once.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z in lower case. One pass over the
texts writes a table of postings: for every document with a term its ``n`` terms, and which of the items' terms it has how
often. Document frequencies are counted from it.

Items share terms. A sharing plan is mined from each ``BLOCK`` of them: the two accumulators that most items have in common become
one new accumulator, again and again, until no two are in two items. That gives a graph of sums whose leaves are
terms and whose ends are items. For ``DOCUMENTS`` documents at a time every accumulator is filled once, a leaf from the postings
and any other as the sum of two before it, and an item adds up the few that it is left with. All are whole numbers of
64 bits, so the order of adding changes nothing.

A task keeps the highest scores so far of each item and gives out the documents that reach them; those are ranked per item
first within salts, then over all. Items are taken ``PART_BYTES`` at a time (by their measured size): the driver, the broadcast and
a worker hold one such part and its plan, and every part is a pass over the texts. Documents are never collected.

Null texts and texts without a term are no documents and rank nowhere. Items without a known term (null or empty ones) get no rows. Rows of
items alike in id and text are one item; other items of the same id are ranked each on its own, under that id. Repeated rows of
documents are documents of their own. Equal scores rank by ascending id, null ids last. Without items or documents
the result is empty. Columns other than id and text are not read.
"""

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ridelake.sources.workspace import written

PART_BYTES, BLOCK, DOCUMENTS, PIECE = 4 << 20, 256, 1024, 1 << 20
SALTS = 64
# What a term holds, by byte: ASCII letters (in lower case), digits, and all bytes of characters beyond ASCII.
LETTERS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
PLAN = "block int, places array<int>, factors array<int>, left array<int>, right array<int>, items array<int>, sums array<array<int>>"


def terms(data: bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some ``PIECE`` bytes of it at a time."""
    plain, at = (data or b"").translate(LETTERS), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def _postings(vocabulary: Broadcast, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            rows, counts, numbers, times, ends = [], [], [], [], [0]
            for row, text in enumerate(batch.column(1)):
                n, found = 0, Counter()
                for some in terms(text.as_py()):
                    n += len(some)
                    found.update(map(known.get, some))
                if n:
                    found.pop(None, None)
                    rows.append(row)
                    counts.append(n)
                    numbers += found.keys()
                    times += found.values()
                    ends.append(len(numbers))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(values, pa.int32())) for values in (numbers, times)]
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(counts, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def shared_sums(items: list[set[int]], leaves: int) -> tuple[list[tuple[int, int]], list[set[int]]]:
    """Pairs of accumulators to add up, which are numbered on from the ``leaves``, and what every item is then the sum of.

    The pair that most items have comes first, of equal ones the one with the smallest numbers.
    """
    items = [set(item) for item in items]
    holders = defaultdict(set)
    for i, item in enumerate(items):
        for x in item:
            holders[x].add(i)
    common = Counter(pair for item in items for pair in combinations(sorted(item), 2))
    heap = [(-count, pair) for pair, count in common.items() if count > 1]
    heapq.heapify(heap)
    sums = []
    while heap:
        count, (x, y) = heapq.heappop(heap)
        both = holders[x] & holders[y]
        if len(both) < 2:
            continue
        if len(both) != -count:
            heapq.heappush(heap, (-len(both), (x, y)))
            continue
        z = leaves + len(sums)
        sums.append((x, y))
        beside = Counter()
        for i in both:
            items[i] -= {x, y}
            beside.update(items[i])
            items[i].add(z)
        holders[x], holders[y], holders[z] = holders[x] - both, holders[y] - both, both
        for w, count in beside.items():
            if count > 1:
                heapq.heappush(heap, (-count, (w, z)))
    return sums, items


def _planned(schema: pa.Schema):
    def plan(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """The sharing plan of a block of items: leaves are terms (``places``) times the ``factors`` they have in an item."""
        rows = sorted(rows.select(["item", "terms", "times"]).to_pylist(), key=lambda row: row["item"])
        items = [list(zip(row["terms"], row["times"])) for row in rows]
        leaves = {pair: i for i, pair in enumerate(sorted({pair for item in items for pair in item}))}
        sums, left = shared_sums([{leaves[pair] for pair in item} for item in items], len(leaves))
        columns = {
            "block": key[0].as_py(),
            "places": [place for place, _ in leaves],
            "factors": [factor for _, factor in leaves],
            "left": [x for x, _ in sums],
            "right": [y for _, y in sums],
            "items": [row["item"] for row in rows],
            "sums": [sorted(item) for item in left],
        }
        return pa.Table.from_pylist([columns], schema)

    return plan


class _Scorer:
    """Scores documents by one plan."""

    def __init__(self, plan, weights: np.ndarray, terms: int):
        self.items, self._sums = plan["items"], [np.array(item, dtype=np.int64) for item in plan["sums"]]
        self._steps = list(zip(plan["left"], plan["right"]))
        places = np.array(plan["places"], dtype=np.int64)
        self._factors = np.array(plan["factors"], dtype=np.int64) * weights[places]
        # The leaves of a term lie side by side.
        self._first = np.searchsorted(places, np.arange(terms), side="left")
        self._count = np.searchsorted(places, np.arange(terms), side="right") - self._first

    def scores(self, document: np.ndarray, term: np.ndarray, worth: np.ndarray, documents: int) -> np.ndarray:
        """A row for every item, a column for every document."""
        leaves = len(self._factors)
        sums = np.zeros((leaves + len(self._steps), documents), dtype=np.int64)
        count = self._count[term]
        leaf = np.arange(count.sum()) + np.repeat(self._first[term] - (np.cumsum(count) - count), count)
        sums[leaf, np.repeat(document, count)] = np.repeat(worth, count) * self._factors[leaf]
        for z, (x, y) in enumerate(self._steps, leaves):
            np.add(sums[x], sums[y], out=sums[z])
        return np.stack([sums[item].sum(axis=0) for item in self._sums])


def _ranked(plans: Broadcast, most: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = plans.value
        weights, documents, length = known["weights"], known["documents"], known["length"]
        scorers = [_Scorer(plan, weights, len(weights)) for plan in known["plans"]]
        reached = [np.zeros((len(s.items), most), dtype=np.int64) for s in scorers]
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS):
                some = pa.Table.from_batches([batch.slice(at, DOCUMENTS)])
                # By id, so that of equal scores the first is the smallest id.
                some = some.take(pc.sort_indices(some, [("id", "ascending")])).combine_chunks()
                n = some.column("n").to_numpy()
                lists = [some.column(name).combine_chunks() for name in ("terms", "times")]
                sizes = pc.list_value_length(lists[0]).to_numpy()
                document = np.repeat(np.arange(len(n)), sizes)
                term, times = (pc.list_flatten(x).to_numpy().astype(np.int64) for x in lists)
                m = 100 - 25 + 25 * n * documents // length
                worth = 1_000_000_000 * times // (1000 * times + 12 * m[document])
                for scorer, best in zip(scorers, reached):
                    scores = scorer.scores(document, term, worth, len(n))
                    order = np.argsort(-scores, axis=1, kind="stable")[:, :most]
                    top = np.take_along_axis(scores, order, axis=1)
                    item, place = np.nonzero((top > 0) & (top >= best[:, -1:]))
                    best[:] = -np.sort(-np.concatenate([best, top], axis=1), axis=1)[:, :most]
                    columns = [
                        pa.array(np.array(scorer.items, dtype=np.int32)[item]),
                        some.column("id").take(pa.array(order[item, place])).combine_chunks(),
                        pa.array(top[item, place]),
                    ]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _first_by(rows: DataFrame, most: int, *group) -> DataFrame:
    order = Window.partitionBy("item", *group).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _ranked_part(docs: DataFrame, items: list, most: int) -> DataFrame | None:
    """``item`` (its place among the items), ``rank``, ``id`` and ``score``; none if the items have no term."""
    spark = docs.sparkSession
    counted = [Counter(term for some in terms(bytes(item["text"] or b"")) for term in some) for item in items]
    vocabulary = {term: i for i, term in enumerate(sorted({term for item in counted for term in item}))}
    if not vocabulary:
        return None
    sent = spark.sparkContext.broadcast(vocabulary)
    key = docs.schema["id"].dataType
    lists = T.ArrayType(T.IntegerType())
    shape = T.StructType().add("id", key).add("n", "long").add("terms", lists).add("times", lists)
    postings = written(docs.mapInArrow(_postings(sent, to_arrow_schema(shape)), shape), "postings")
    sent.unpersist()
    documents, length = postings.agg(F.count("*"), F.sum("n")).first()
    held = dict(postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for term, df in held.items():
        weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
    rows = []
    for i, item in enumerate(counted):
        useful = sorted((vocabulary[t], times) for t, times in item.items() if weights[vocabulary[t]])
        if useful:
            rows.append((i // BLOCK, i, [t for t, _ in useful], [times for _, times in useful]))
    if not rows:
        return None
    blocks = spark.createDataFrame(rows, "block int, item int, terms array<int>, times array<int>").groupBy("block")
    shape = T.StructType.fromDDL(PLAN)
    plans = [row.asDict() for row in blocks.applyInArrow(_planned(to_arrow_schema(shape)), shape).collect()]
    sent = spark.sparkContext.broadcast({"plans": plans, "weights": weights, "documents": documents, "length": length})
    shape = T.StructType().add("item", "integer").add("id", key).add("score", "long")
    found = postings.mapInArrow(_ranked(sent, most, to_arrow_schema(shape)), shape)
    found = _first_by(found, most, F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    return _first_by(found, most)


def ranked(docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, most: int = 20) -> DataFrame:
    """``item``, ``rank``, ``id`` and ``score`` of the ``most`` documents with the highest scores, for every item."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("id"), F.col(text).cast("binary").alias("text")).filter("text is not null")
    items = items.select(F.col(item_key).alias("id"), F.col(item_text).cast("binary").alias("text")).distinct()
    held = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-held // PART_BYTES)
    shape = T.StructType().add("item", items.schema["id"].dataType).add("rank", "integer")
    shape = shape.add("id", docs.schema["id"].dataType).add("score", "long")
    result = spark.createDataFrame([], shape)
    for part in range(parts):
        some = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == part).collect()
        names = T.StructType().add("place", "integer").add("name", items.schema["id"].dataType)
        found = _ranked_part(docs, some, most)
        if found is not None:
            named = F.broadcast(spark.createDataFrame([(i, row["id"]) for i, row in enumerate(some)], names))
            found = found.join(named, F.col("item") == F.col("place")).select(F.col("name").alias("item"), "rank", "id", "score")
            result = result.union(found)
    return result
