"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by ``m`` random directions: its places along them, cut into cells of one
width, name a bucket. A query visits its own bucket of every table and then the ``PROBES`` - 1 buckets
around it that are likeliest to hold its neighbours. The order of these perturbations is fixed
beforehand from the expected squared distances to the borders of cells, the nearest border first; each query
then applies them to its own borders, ranked by their distance. What the tables find is merged and
ranked by the exact measure, the inner product in double precision on the original vectors.

Nearness in hashing is distance, so vectors get one more component that makes all lengths equal
(queries get 0), which turns the largest inner product into the smallest distance. The number of directions
grows with the logarithm of the rows. The cell width is fitted on ``SAMPLE`` rows chosen by a
hash of the key: the smallest of a ladder that finds ``GOAL`` of the sample's own neighbours. All
rows are indexed. A query that finds too few is searched against all rows, in blocks.

Rows are dealt by their key to parts of about ``PART``, each with its share of every bucket of all tables, and queries to blocks of
about ``ASKED`` (fewer if vectors are longer than ``COMPONENTS``); a task searches one part for one block, so what it holds follows neither
the number of rows nor the size of a bucket. It scores ``SCORES`` pairs at a time and keeps the k best of a query. Of equal vectors only the k + 1
smallest keys can be among anyone's k nearest, so no others are indexed, and equal queries are searched once.

Vectors that are null, empty, zero, of another length than most, or hold null or non-finite
components take no part, neither do rows with a null key. Repeated rows are one; of a key with several vectors a query
gets the best. Ties go to the smaller key. An empty
table gives an empty result. Only the two named columns are read.
"""

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.sources.workspace import written

TABLES, PROBES = 16, 100
SAMPLE, SAMPLE_QUERIES, GOAL = 4096, 128, 0.95
PART, ASKED, COMPONENTS = 25_000, 16_384, 64
SCORES = 500_000
BLOCK = 1024
LADDER = [0.75 * 1.1**i for i in range(40)]
SEED = 5


def perturbations(m: int, count: int) -> list[tuple[int, ...]]:
    """Sets of ranks of borders to cross, likeliest first: rank 0 is the nearest border of 2 * m.

    Ranks r and 2 * m - 1 - r are the two borders of one direction, so a set has one of them at most.
    """
    near = [(r + 1) * (r + 2) / (4 * (m + 1) * (m + 2)) for r in range(m)]
    far = [1 - (r + 1) / (m + 1) + (r + 1) * (r + 2) / (4 * (m + 1) * (m + 2)) for r in range(m)]
    cost = near + far[::-1]
    found, queue = [()], [(cost[0], (0,))]
    while queue and len(found) < count:
        total, ranks = heapq.heappop(queue)
        if all(2 * m - 1 - r not in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(queue, (total - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(queue, (total + cost[last + 1], (*ranks, last + 1)))
    return found


class Tables:
    """The directions of all tables, for vectors of ``size`` components and one cell width."""

    def __init__(self, size: int, m: int, width: float, longest: float):
        rng = np.random.default_rng(SEED)
        self._directions = rng.standard_normal((TABLES, size + 1, m))
        self._shifts = rng.random((TABLES, m)) * width
        self._names = rng.integers(-(2**63), 2**63, (TABLES, m), dtype=np.int64) | 1
        self._width, self._longest, self._m = width, longest, m
        # For every number of borders, the ranks that the sets of so many cross.
        sets = perturbations(m, PROBES)
        self._sets = [np.array([x for x in sets if len(x) == n]) for n in sorted({len(x) for x in sets})]

    def _places(self, table: int, vectors: np.ndarray, lift: bool) -> np.ndarray:
        rest = np.maximum(0, self._longest**2 - (vectors**2).sum(axis=1)) if lift else np.zeros(len(vectors))
        whole = np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)
        return (whole @ self._directions[table] + self._shifts[table]) / self._width

    def buckets(self, table: int, vectors: np.ndarray) -> np.ndarray:
        """The bucket of every vector in a table, as one number."""
        cells = np.floor(self._places(table, vectors, True)).astype(np.int64)
        return (cells * self._names[table]).sum(axis=1)

    def probes(self, table: int, queries: np.ndarray) -> np.ndarray:
        """The buckets that every query visits in a table."""
        places = self._places(table, queries, False)
        cells = np.floor(places).astype(np.int64)
        within = places - cells
        own = (cells * self._names[table]).sum(axis=1)
        order = np.argsort(np.concatenate([within, 1 - within], axis=1), axis=1, kind="stable")
        # What crossing the border of each rank adds to the bucket's number.
        step = np.where(order < self._m, -1, 1) * self._names[table][order % self._m]
        visited = [own[:, None] + sum(step[:, sets[:, i]] for i in range(sets.shape[1])) for sets in self._sets]
        return np.concatenate([np.broadcast_to(v, (len(queries), len(sets))) for v, sets in zip(visited, self._sets)], axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(values.flatten(), dtype=np.float64).reshape(len(values), -1)


def _fitted_width(vectors: np.ndarray, k: int, m: int, longest: float) -> float:
    """The smallest width of the ladder, in units of the longest vector, that finds the sample's neighbours."""
    queries = vectors[:SAMPLE_QUERIES]
    scores = queries @ vectors.T
    np.fill_diagonal(scores, -np.inf)
    count = min(k, len(vectors) - 1)
    if count < 1:
        return LADDER[-1] * longest
    true = np.argpartition(-scores, count - 1, axis=1)[:, :count]
    for step in LADDER:
        tables = Tables(vectors.shape[1], m, step * longest, longest)
        found = np.zeros((len(queries), len(vectors)), dtype=bool)
        for table in range(TABLES):
            buckets, probes = tables.buckets(table, vectors), tables.probes(table, queries)
            for q in range(len(queries)):
                found[q] |= np.isin(buckets, probes[q])
        if np.take_along_axis(found, true, axis=1).mean() >= GOAL:
            return step * longest
    return LADDER[-1] * longest


class _Best:
    """The k best rows met so far for every query of a block, by the exact measure; ties to the smaller key."""

    def __init__(self, asked: np.ndarray, k: int):
        self._asked, self._k = asked, k
        self._least = np.full(len(asked), -np.inf)
        self._lengths = np.sqrt((asked**2).sum(axis=1))
        self._fresh: list[tuple] = []
        self._waiting = 0
        self.queries, self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def offer(self, queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, longest: float, copies: int) -> None:
        """All pairs of some queries and rows. No row is longer than ``longest``, no key has more than ``copies`` rows."""
        for first in range(0, len(ids), SCORES):
            rows, keys = vectors[first : first + SCORES], ids[first : first + SCORES]
            high = max(1, SCORES // len(keys))
            for start in range(0, len(queries), high):
                self._meet(queries[start : start + high], rows, keys, longest, self._k * copies)

    def _meet(self, block: np.ndarray, rows: np.ndarray, keys: np.ndarray, longest: float, enough: int) -> None:
        asked = self._asked[block]
        scores = asked @ rows.T
        # A product of matrices sums in an order of its own: by this much it may differ from the measure.
        slack = 1e-12 * longest * self._lengths[block]
        least = self._least[block] - slack
        a, b = np.nonzero(scores >= least[:, None])
        if len(keys) > enough and len(a) > enough * len(block):
            least = np.fmax(least, np.partition(scores, -enough, axis=1)[:, -enough] - 2 * slack)
            a, b = np.nonzero(scores >= least[:, None])
        few = max(1, 4 * SCORES // asked.shape[1])
        for start in range(0, len(a), few):
            x, y = a[start : start + few], b[start : start + few]
            # The measure itself, summed in one order whatever the block.
            self._fresh.append((block[x], keys[y], (asked[x] * rows[y]).sum(axis=1)))
        self._waiting += len(a)
        if self._waiting > SCORES:
            self.settle()

    def settle(self) -> None:
        q, i, s = (np.concatenate(x) for x in zip((self.queries, self.ids, self.scores), *self._fresh))
        self._fresh, self._waiting = [], 0
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        # A row is met in several tables, and a key may have several rows: only its best pair counts.
        by_key = np.lexsort((i, q))
        again = (np.diff(q[by_key]) == 0) & (np.diff(i[by_key]) == 0)
        single = np.ones(len(q), dtype=bool)
        single[by_key[1:][again]] = False
        q, i, s = q[single], i[single], s[single]
        nth = np.arange(len(q)) - np.searchsorted(q, q, side="left")
        self.queries, self.ids, self.scores = q[nth < self._k], i[nth < self._k], s[nth < self._k]
        full = nth == self._k - 1
        self._least[q[full]] = s[full]

    def table(self, names: pa.Array) -> pa.Table:
        found = [names.take(pa.array(self.queries)), pa.array(self.ids), pa.array(self.scores)]
        return pa.Table.from_arrays(found, schema=RESULT)


RESULT = pa.schema([("query", pa.binary()), ("id", pa.int64()), ("score", pa.float64())])
FOUND = "query binary, id long, score double"


def _facts(vectors: np.ndarray, ids: np.ndarray) -> tuple[float, int]:
    """The longest row, and the most rows that a key has."""
    return np.sqrt((vectors**2).sum(axis=1).max()), np.unique(ids, return_counts=True)[1].max()


def _part_search(tables: Tables, k: int):
    """The k best rows of a part, in the buckets that each query of a block visits."""

    def search(part: pa.Table, block: pa.Table) -> pa.Table:
        if not part.num_rows or not block.num_rows:
            return RESULT.empty_table()
        vectors, asked = _matrix(part["vector"]), _matrix(block["vector"])
        ids, names = part["id"].to_numpy(), block["query"].combine_chunks()
        longest, copies = _facts(vectors, ids)
        best = _Best(asked, k)
        for table in range(TABLES):
            buckets = tables.buckets(table, vectors)
            order = np.argsort(buckets, kind="stable")
            rows, keys = vectors[order], ids[order]
            buckets, first = np.unique(buckets[order], return_index=True)
            last = np.append(first[1:], len(order))
            probes = tables.probes(table, asked)
            place = np.searchsorted(buckets, probes.ravel())
            place[place == len(buckets)] = 0
            met = np.flatnonzero(buckets[place] == probes.ravel())
            visited, guests = place[met], met // probes.shape[1]
            order = np.argsort(visited, kind="stable")
            visited, guests = visited[order], guests[order]
            cuts = np.append(np.flatnonzero(np.diff(visited, prepend=-1)), len(visited))
            for start, end in zip(cuts[:-1], cuts[1:]):
                bucket = visited[start]
                cell = slice(first[bucket], last[bucket])
                best.offer(guests[start:end], rows[cell], keys[cell], longest, copies)
        best.settle()
        return best.table(names)

    return search


def _whole_search(queries: list, k: int):
    """The k best rows of a partition for a block of queries."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(np.array([vector for _, vector in queries], dtype=np.float64), k)
        everyone = np.arange(len(queries))
        for batch in batches:
            if batch.num_rows:
                vectors, ids = _matrix(batch.column("vector")), batch.column("id").to_numpy()
                best.offer(everyone, vectors, ids, *_facts(vectors, ids))
        best.settle()
        yield from best.table(pa.array([name for name, _ in queries], pa.binary())).to_batches()

    return search


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _top(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = found.dropDuplicates(["query", "id"]).withColumn("rank", F.row_number().over(nearest))
    return ranked.filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, key: str, vector: str, asks: Column, k: int) -> DataFrame:
    """``query``, ``rank``, ``id`` and ``score`` of the k nearest rows found for every row that ``asks`` names.

    ``asks`` is a condition on a column named ``id``, the key. A row is no neighbour of its own.
    """
    plain = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))
    plain = plain.filter(F.col("id").isNotNull() & _valid(F.col("vector"))).distinct()
    sized = plain.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = sized["size"] if sized else 1
    # Equal vectors have equal texts; adding 0 makes -0.0 and 0.0 one.
    text = F.transform("vector", lambda x: x + F.lit(0).cast("float")).cast("string")
    plain = plain.filter(F.size("vector") == size).withColumn("query", F.unhex(F.md5(text.cast("binary"))))
    plain = written(plain, "vectors")
    alike = Window.partitionBy("query").orderBy("id")
    indexed = plain.withColumn("nth", F.row_number().over(alike)).filter(F.col("nth") <= k + 1).drop("nth")
    indexed = written(indexed, "indexed-vectors")
    asked = written(
        plain.filter(asks).groupBy("query").agg(F.min_by("vector", "id").alias("vector")), "asked-vectors"
    )
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    rows, longest = indexed.agg(F.count("*"), F.max(F.sqrt(square))).first()
    if not rows:
        return _answers(plain.filter(asks), indexed.select("query", "id", F.lit(0.0).alias("score")).limit(0), k)
    # A hash of the key chooses the sample; sorted, the driver gets as many rows as it asks for.
    sample = indexed.orderBy(F.xxhash64("id"), "id").select("vector").limit(SAMPLE).collect()
    sample = np.array([row["vector"] for row in sample], dtype=np.float64)
    m = max(6, round(0.75 * np.log2(rows)))
    tables = Tables(size, m, _fitted_width(sample, k, m, longest), longest)
    found = written(_searched(indexed, asked, tables, rows, size, k + 1), "found")
    found = found.union(_exact(indexed, asked, found, min(rows, k + 1), k + 1))
    return _answers(plain.filter(asks), found, k)


def _searched(indexed: DataFrame, asked: DataFrame, tables: Tables, rows: int, size: int, k: int) -> DataFrame:
    weight = max(1, size / COMPONENTS)
    parts, blocks = (max(1, math.ceil(count * weight / most)) for count, most in ((rows, PART), (asked.count(), ASKED)))

    def each(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    part, block = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"), F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")
    dealt = indexed.select("id", "vector", part.alias("part"), each(blocks).alias("block")).groupBy("part", "block")
    asking = asked.select("query", "vector", each(parts).alias("part"), block.alias("block")).groupBy("part", "block")
    return dealt.cogroup(asking).applyInArrow(_part_search(tables, k), FOUND)


def _exact(indexed: DataFrame, asked: DataFrame, found: DataFrame, enough: int, k: int) -> DataFrame:
    """All rows searched for the queries that found fewer than ``enough``, a block of queries at a time."""
    counts = found.groupBy("query").agg(F.countDistinct("id").alias("n"))
    short = asked.join(counts, "query", "left").filter(F.coalesce("n", F.lit(0)) < enough).select("query", "vector")
    short = written(short, "short")
    blocks = -(-short.count() // BLOCK)
    searched = found.limit(0)
    block = F.pmod(F.xxhash64("query"), F.lit(max(1, blocks)))
    for number in range(blocks):
        queries = [(bytes(row["query"]), list(row["vector"])) for row in short.filter(block == number).collect()]
        if queries:
            searched = searched.union(indexed.select("id", "vector").mapInArrow(_whole_search(queries, k), FOUND))
    return searched


def _answers(asks: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """From the k + 1 nearest of every different query vector to the k nearest of every query row."""
    best = _top(found, k + 1).select("query", "id", "score", F.col("rank").alias("place"))
    own = asks.select(F.col("id").alias("asking"), "query").join(best, "query").filter("asking != id")
    nearest = Window.partitionBy("asking").orderBy("place")
    ranked = own.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select(F.col("asking").alias("query"), "rank", "id", "score")
