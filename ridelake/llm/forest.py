"""Near-duplicate documents by an LSH forest over MinHash signatures.

A forest has as many trees as the similarity asked for needs, ``TREES`` at least. A tree is a sorted order of all distinct shingle sets by a
label of ``DEEPEST`` MinHash values of its own. Neighbours in an order that share a prefix of at least
``SHALLOWEST`` values are candidates; a run of more than ``DENSE`` neighbours with one prefix is cut by
longer prefixes, so the depth adapts to how dense a region is. Two sets of similarity s
share a prefix of depth d in some of t trees with probability 1 - (1 - s**d)**t. The trees are so many that of
the pairs just as similar as asked this misses ``MISSED`` at most in dense regions: at 0.85 it is 20 trees, which miss
4 of 10 million pairs in sparse and 8 of 100,000 in dense regions, at 0.8 32 trees, with 5 of 100 million and 6 of 100,000.

Runs that share members form a region. All links lie within regions, and
every region is searched whole: its sets are joined in blocks by an exact prefix-filtered
similarity join, whose links are confirmed on the full sets. A block reports a spanning forest of its
links, never all pairs.

Sets are shingle hashes of 64 bits; equal sets are one vertex, named by a 128-bit digest.
Null and empty texts, and texts of white space, have an empty set: linked with nothing, each
its own component. Rows with equal or null ids and equal texts share a component; the component
of rows whose ids are all null is null. An empty table gives an empty result. Columns of
any name stay as they are.
"""

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.batches import by_pieces
from ridelake.llm.components import components
from ridelake.llm.shingles import MinHash, Shingler
from ridelake.sources.workspace import written

TREES, SHALLOWEST, DEEPEST, DENSE = 20, 4, 6, 64
MISSED = 8e-5
# Shingles that one block of a region holds: 16 MB.
BLOCK = 2_000_000
SEED = 7
SKETCH = "n long, v binary, signature binary"


def trees_for(share: int, of: int) -> int:
    """Trees that miss ``MISSED`` of the pairs with a similarity of ``share`` / ``of`` where a region is dense."""
    alike = (share / of) ** DEEPEST
    return TREES if alike >= 1 else max(TREES, math.ceil(math.log(MISSED) / math.log1p(-alike)))


def _sketcher(trees: int):
    def sketches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from by_pieces(_sketched(trees))(batches)

    return sketches


def _sketched(trees: int):
    shingler, orders = Shingler(), MinHash(trees * DEEPEST, SEED)

    def sketched(texts: list) -> pa.Array:
        rows = []
        for text in texts:
            shingles = shingler.distinct(text)
            if len(shingles):
                # Big-endian, so that bytes sort as the values do.
                signature = orders.signature(shingles).astype(">u4").tobytes()
                rows.append((len(shingles), _digest(shingles), signature))
            else:
                rows.append((0, None, None))
        sizes, names, signatures = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(signatures, pa.binary())],
            names=["n", "v", "signature"],
        )

    return sketched


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every tree and vertex."""
    for batch in batches:
        vertices = batch.column("v")
        whole = np.frombuffer(b"".join(batch.column("signature").to_pylist()), dtype="S1").reshape(len(vertices), -1)
        width = 4 * DEEPEST
        for tree in range(whole.shape[1] // width):
            part = np.ascontiguousarray(whole[:, tree * width : (tree + 1) * width])
            labels = pa.array([row.tobytes() for row in part], pa.binary())
            trees = pa.array(np.full(len(vertices), tree, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([trees, labels, vertices], names=["tree", "label", "v"])


def _runs(shared: np.ndarray, first: int, last: int, depth: int) -> Iterator[tuple[int, int]]:
    """Runs of rows ``first`` to ``last`` with a common prefix; ``shared[i]`` is that of rows i and i + 1."""
    cuts = np.flatnonzero(shared[first : last - 1] < depth) + first + 1
    starts, ends = [first, *cuts.tolist()], [*cuts.tolist(), last]
    for start, end in zip(starts, ends):
        if end - start > DENSE and depth < DEEPEST:
            yield from _runs(shared, start, end, depth + 1)
        elif end - start > 1:
            yield start, end


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ties every row of a sorted partition to the first of its run, and tells the partition's two ends.

    A partition is read in pieces of some 100,000 rows; where pieces meet, their
    neighbours are tied as well.
    """
    before = None
    first = None
    for batch in batches:
        names, labels, trees = (batch.column(x) for x in ("v", "label", "tree"))
        names, labels, trees = names.to_pylist(), labels.to_pylist(), trees.to_pylist()
        if not names:
            continue
        if before is not None:
            names, labels, trees = [before[0], *names], [before[1], *labels], [before[2], *trees]
        else:
            first = (names[0], labels[0], trees[0])
        before = (names[-1], labels[-1], trees[-1])
        values = np.frombuffer(b"".join(labels), dtype=">u4").reshape(len(labels), DEEPEST)
        same = (values[1:] == values[:-1]) & (np.array(trees[1:]) == np.array(trees[:-1]))[:, None]
        shared = np.logical_and.accumulate(same, axis=1).sum(axis=1)
        members, heads = [], []
        for start, end in _runs(shared, 0, len(names), SHALLOWEST):
            heads += [names[start]] * (end - start - 1)
            members += names[start + 1 : end]
        yield _pairs(members, heads)
    if before is not None:
        yield _ends([first, before])


PAIRS = "a binary, b binary, tree int, label binary"
_PAIRS_ARROW = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("tree", pa.int32()), ("label", pa.binary())])


def _pairs(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.nulls(len(a), pa.int32()), pa.nulls(len(a), pa.binary())],
        schema=_PAIRS_ARROW,
    )


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    names, labels, trees = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.binary()), pa.nulls(len(rows), pa.binary()), pa.array(trees, pa.int32()), pa.array(labels, pa.binary())],
        schema=_PAIRS_ARROW,
    )


def candidate_edges(vertices: DataFrame) -> DataFrame:
    """``(a, b)``: ties that connect all members of every run of every tree."""
    rows = vertices.select("v", "signature").mapInArrow(_labels, "tree int, label binary, v binary")
    ordered = rows.repartitionByRange("tree", "label", "v").sortWithinPartitions("tree", "label", "v")
    tied = written(ordered.mapInArrow(_neighbours, PAIRS), "forest")
    # Two rows a partition: neighbours across the ends of partitions.
    ends = tied.filter("b is null").select("tree", "label", F.col("a").alias("v"))
    across = ends.coalesce(1).sortWithinPartitions("tree", "label", "v").mapInArrow(_neighbours, PAIRS)
    return tied.union(across).filter("b is not null").select("a", "b")


def _sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    shingler = Shingler()
    yield from by_pieces(lambda texts: pa.array([shingler.distinct(text).tobytes() for text in texts], pa.binary()))(batches)


def _linker(share: int, of: int):
    """Joins the blocks of a sorted partition; ``share`` / ``of`` is the similarity asked for."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        for batch in batches:
            columns = [batch.column(x).to_pylist() for x in ("region", "low", "high", "block", "v", "shingles")]
            edges = []
            for region, low, high, block, name, shingles in zip(*columns):
                if (region, low, high) != key:
                    edges += _links(group, key, share, of)
                    key, group = (region, low, high), []
                group.append((block, name, np.frombuffer(shingles, dtype=np.uint64)))
            if edges:
                yield _edges(edges)
        yield _edges(_links(group, key, share, of))

    return linked


def _edges(edges: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([e[i] for e in edges], pa.binary()) for i in (0, 1)], names=["a", "b"]
    )


def _links(group: list[tuple], key: tuple | None, share: int, of: int) -> list[tuple]:
    """A spanning forest of the links in a block, or between two blocks.

    Sets are taken by size. Those that can reach the similarity share one of the rarest shingles
    of a set, as many as it may lack and one more; candidates are then counted whole.
    """
    if len(group) < 2:
        return []
    group.sort(key=lambda member: len(member[2]))
    across = key[1] != key[2]
    blocks = np.array([member[0] for member in group])
    sizes = np.array([len(member[2]) for member in group])
    ids, inverse, often = np.unique(
        np.concatenate([member[2] for member in group]), return_inverse=True, return_counts=True
    )
    rank = np.empty(len(ids), dtype=np.int64)
    rank[np.argsort(often, kind="stable")] = np.arange(len(ids))
    sets = [np.sort(part) for part in np.split(rank[inverse], np.cumsum(sizes)[:-1])]
    shared_often = np.sort(often)
    root = np.arange(len(group))
    index: dict[int, list[int]] = defaultdict(list)
    marked = np.zeros(len(ids), dtype=bool)
    found = []
    for k, own in enumerate(sets):
        least = -(-share * len(own) // of)
        rare = own[: len(own) - least + 1]
        rare = rare[shared_often[rare] > 1].tolist()
        near = set()
        for x in rare:
            near.update(index[x])
            index[x].append(k)
        if not near:
            continue
        others = np.fromiter(near, dtype=np.int64, count=len(near))
        others = others[(sizes[others] >= least) & (root[others] != root[k])]
        if across:
            others = others[blocks[others] != blocks[k]]
        if not len(others):
            continue
        marked[own] = True
        bounds = np.concatenate([[0], np.cumsum(sizes[others])[:-1]])
        common = np.add.reduceat(marked[np.concatenate([sets[j] for j in others])], bounds, dtype=np.int64)
        marked[own] = False
        linked = others[of * common >= share * (len(own) + sizes[others] - common)]
        for j in linked.tolist():
            if root[j] != root[k]:
                root[root == root[j]] = root[k]
                found.append((group[j][1], group[k][1]))
    return found


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row``, ``id``, ``text`` and ``rid``, which rows alike in id and text share."""
    content = F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("none"))
    name = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("none")), content)
    return docs.select(F.struct("*").alias("row"), F.col(key).alias("id"), F.col(text).alias("text"), name.alias("rid"))


def _classes(rows: DataFrame, share: int, of: int) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and ``v``, ``at`` and ``class`` of all distinct sets."""
    sketch = F.arrow_udf(_sketcher(trees_for(share, of)), SKETCH)
    sketched = written(rows.select("id", "rid", sketch("text").alias("s")).select("id", "rid", "s.*"), "sketches")
    vertices = sketched.filter("v is not null").groupBy("v")
    vertices = vertices.agg(
        F.min("id").alias("low"),
        F.min(F.struct("id", "rid")).alias("at"),
        F.first("n").alias("n"),
        F.first("signature").alias("signature"),
    )
    vertices = written(vertices, "vertices")
    regions = written(components(candidate_edges(vertices)).withColumnRenamed("root", "region"), "regions")
    links = components(_confirmed(rows, vertices, regions, share, of))
    placed = vertices.select("v", "low", "at").join(links, "v", "left")
    return sketched, placed.withColumn("class", F.coalesce("root", "v"))


def _confirmed(rows: DataFrame, vertices: DataFrame, regions: DataFrame, share: int, of: int) -> DataFrame:
    """Links that connect every component of the sets' similarity graph, found region by region."""
    members = regions.join(vertices.select("v", "at.rid", "n"), "v")
    blocks = members.groupBy("region").agg(F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    wanted = members.join(blocks, "region").select("region", "v", "blocks", "rid")
    met = rows.select("rid", "text").join(wanted, "rid").dropDuplicates(["v"])
    shingles = F.arrow_udf(_sets, "binary")
    sets = met.select("region", "v", "blocks", shingles("text").alias("shingles"))
    block = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    dealt = sets.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    dealt = dealt.select("region", low, high, "block", "v", "shingles")
    order = ["region", "low", "high"]
    return dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(_linker(share, of), "a binary, b binary")


def near_components(docs: DataFrame, key: str, text: str, share: int = 80, of: int = 100) -> DataFrame:
    """``id``, ``n_shingles`` and the ``component`` (its smallest id) of every row.

    Documents are linked when ``of`` * common shingles >= ``share`` * shingles of either.
    """
    sketched, placed = _classes(_rows(docs, key, text), share, of)
    lowest = placed.groupBy("class").agg(F.min("low").alias("component"))
    component = placed.select("v", "class").join(lowest, "class").select("v", "component")
    found = sketched.select("id", "n", "v").join(component, "v", "left")
    own = F.when(F.col("v").isNull(), F.col("id")).otherwise(F.col("component"))
    return found.select("id", F.col("n").alias("n_shingles"), own.alias("component"))


def one_of_each(docs: DataFrame, key: str, text: str, share: int = 80, of: int = 100) -> DataFrame:
    """The documents that stay: of every component the one with the smallest id, and all without shingles.

    Rows alike in id and text are one document. The columns are those of ``docs``.
    """
    rows = _rows(docs, key, text)
    sketched, placed = _classes(rows, share, of)
    stay = placed.groupBy("class").agg(F.min("at").alias("at")).select("at.rid")
    stay = stay.union(sketched.filter("v is null").select("rid")).distinct()
    return rows.join(stay, "rid", "left_semi").dropDuplicates(["rid"]).select("row.*")
