"""Fingerprints of documents that stay alike when the documents do: a quartile bucket digest.

Every byte makes three triplets with the bytes before it (itself and two of the three last ones). Triplets are
hashed into ``BUCKETS`` buckets and counted. A bucket's code is the quarter of all buckets that its count is in, 0 for
the least. The fingerprint is, in hexadecimal: one byte for the length (``STEPS`` steps for each doubling of it), one for how the first and the
second quartile compare with the third, in sixteenths, and two bits a bucket.

The difference of two fingerprints adds up the steps between their codes (the farthest, between the least and the most, counts ``FAR``),
between their quartiles, and between their lengths up to ``LENGTHS``. It is bounded by ``MOST``; likeness is 1 for
no difference and 0 for that bound or more.

Equal texts have equal fingerprints. Null texts are empty; texts of fewer than four bytes have no triplets, and
codes of 0. Texts are read whole, ``PIECE`` bytes at a time, inside tasks, without a shuffle.

``against_next`` lays documents in the order of their ids, by a sort over ranges; rows of one id are ordered by their text, and
copies by where they come from, so that no id is all in one task. Tasks go along their range with one document in hand.
The last of each range meets the first of the next in a table with two rows a range. Null ids come last. Repeated rows are documents of their
own. An empty table gives an empty result. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ridelake.llm.batches import by_pieces
from ridelake.sources.workspace import written

BUCKETS, STEPS, FAR, LENGTHS, MOST = 256, 8, 6, 64, 512
PIECE, ROWS = 1 << 20, 500
# Odd 32-bit multipliers from the fractions of roots: three for each kind of triplet, one to mix.
_ROOTS = [int(2**32 * (n**0.5 % 1)) | 1 for n in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29)]
_TRIPLETS = [((0, 1, 2), _ROOTS[0:3]), ((0, 1, 3), _ROOTS[3:6]), ((0, 2, 3), _ROOTS[6:9])]
_SHIFT = np.uint32(32 - (BUCKETS.bit_length() - 1))
_STEP = np.array([0, 1, 2, FAR], dtype=np.int64)
ADDED = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def bucket_counts(data: bytes) -> np.ndarray:
    """Triplets by bucket."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, max(0, len(data) - 3), PIECE):
        letters = np.frombuffer(data[at : at + PIECE + 3], dtype=np.uint8).astype(np.uint32)
        size = len(letters) - 3
        for back, factors in _TRIPLETS:
            mixed = sum(letters[3 - b : 3 - b + size] * np.uint32(f) for b, f in zip(back, factors))
            mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(_ROOTS[9])
            counts += np.bincount(mixed >> _SHIFT, minlength=BUCKETS)
    return counts


def digest(text: str | None) -> bytes:
    """A text's fingerprint: length, quartiles, then the codes of four buckets a byte."""
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = bucket_counts(data)
    quarter = BUCKETS // 4
    first, second, third = np.sort(counts)[[quarter - 1, 2 * quarter - 1, 3 * quarter - 1]].tolist()
    codes = (counts > first).astype(np.uint8) + (counts > second) + (counts > third)
    length = min(255, int(STEPS * np.log2(len(data) + 1)))
    ratios = [min(15, 16 * q // third) if third else 0 for q in (first, second)]
    packed = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8)
    return bytes([length, ratios[0] << 4 | ratios[1]]) + packed.tobytes()


def differences(some: list[bytes], others: list[bytes]) -> np.ndarray:
    """The difference score of every two fingerprints, 0 to ``MOST``."""
    a, b = (np.frombuffer(b"".join(x), dtype=np.uint8).reshape(len(x), -1).astype(np.int64) for x in (some, others))
    length = np.minimum(np.abs(a[:, 0] - b[:, 0]), LENGTHS)
    ratios = np.abs((a[:, 1] >> 4) - (b[:, 1] >> 4)) + np.abs((a[:, 1] & 15) - (b[:, 1] & 15))
    codes = sum(_STEP[np.abs((a[:, 2:] >> s & 3) - (b[:, 2:] >> s & 3))].sum(axis=1) for s in (0, 2, 4, 6))
    return np.minimum(length + ratios + codes, MOST)


def likenesses(some: list[bytes], others: list[bytes]) -> np.ndarray:
    """1 less the difference as a share of its bound."""
    return 1 - differences(some, others) / MOST if some else np.zeros(0)


def _digests(texts: list) -> pa.Array:
    return pa.array([digest(text).hex() for text in texts], pa.string())


def fingerprint(text: Column) -> Column:
    """The fingerprint of every text."""
    return F.arrow_udf(by_pieces(_digests), "string")(text)


def _alike(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for pair in batches:
        some, others = ([bytes.fromhex(x) if x else digest("") for x in column.to_pylist()] for column in pair)
        yield pa.array(likenesses(some, others), pa.float64())


def likeness(some: Column, others: Column) -> Column:
    """How alike two fingerprints are, 0 to 1; a null one is that of an empty text."""
    return F.arrow_udf(_alike, "double")(some, others)


def edited(text: str, following: str) -> str:
    """A text whose last third is replaced by the beginning of another."""
    end = len(text) // 3
    return text[: len(text) - end] + following[:end]


def _compared(texts: list[str], digests: list[bytes], following: list[str], next_digests: list[bytes]) -> list[list]:
    """The columns of ``ADDED``."""
    changed = [edited(text, other) for text, other in zip(texts, following)]
    changed_digests = [d if new == old else digest(new) for new, old, d in zip(changed, texts, digests)]
    return [
        [len(text) for text in texts],
        [hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest() for new in changed],
        [d.hex() for d in digests],
        [d.hex() for d in changed_digests],
        likenesses(digests, changed_digests).tolist(),
        likenesses(digests, next_digests).tolist(),
    ]


def _along(schema: pa.Schema):
    """Compares every document of a range with the next; the first and the last are given out with their texts (``edge`` 1 and 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, open_end = TaskContext.get().partitionId(), None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                ids, texts = (column.to_pylist() for column in batch.slice(at, ROWS).columns)
                texts = [text or "" for text in texts]
                digests = [digest(text) for text in texts]
                if open_end is None:
                    yield edge(place, 1, ids[0], texts[0])
                else:
                    ids, texts, digests = [open_end[0], *ids], [open_end[1], *texts], [open_end[2], *digests]
                columns = _compared(texts[:-1], digests[:-1], texts[1:], digests[1:])
                n = len(ids) - 1
                rows = [ids[:-1], *columns, [place] * n, [0] * n, [None] * n]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)
                open_end = ids[-1], texts[-1], digests[-1]
        if open_end is not None:
            yield edge(place, 2, *open_end[:2])

    def edge(place: int, kind: int, key, text: str) -> pa.RecordBatch:
        row = {"id": key, "place": place, "edge": kind, "text": text}
        return pa.RecordBatch.from_pylist([row], schema)

    return run


def _over_edges(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch in batches:
        texts, following = (column.to_pylist() for column in batch)
        columns = _compared(texts, [digest(t) for t in texts], following, [digest(t) for t in following])
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [part.split()[0] for part in ADDED.split(", ")]
        yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def against_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id`` and, of every document, its fingerprint and how like it are its edited text and the next document.

    The next document is the one with the next smaller id, after the last the first. The edited
    text has the last third of the characters replaced by as many from the start of the next document (or all it has).
    """
    added = T.StructType.fromDDL(ADDED)
    rows = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    ranges = [F.desc_nulls_last("id"), F.col("_hash"), F.col("_origin")]
    rows = rows.withColumns({"_hash": F.xxhash64("text"), "_origin": F.spark_partition_id()})
    laid = rows.repartitionByRange(*ranges).sortWithinPartitions(*ranges, "text").select("id", "text")
    shape = T.StructType([T.StructField("id", docs.schema[key].dataType), *added.fields])
    shape = shape.add("place", "integer").add("edge", "integer").add("text", "string")
    found = written(laid.mapInArrow(_along(to_arrow_schema(shape)), shape), "fingerprints")
    # Two rows a range: the last of a range is followed by the first of the next, the very last by the very first.
    ends = Window.orderBy("place", "edge")
    whole = ends.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = F.coalesce(F.lead("text").over(ends), F.first("text").over(whole))
    edges = found.filter("edge > 0").select("id", "edge", "text", following.alias("following")).filter("edge = 2")
    edges = edges.select("id", F.arrow_udf(_over_edges, added)("text", "following").alias("found")).select("id", "found.*")
    return found.filter("edge = 0").select("id", *added.names).union(edges)
