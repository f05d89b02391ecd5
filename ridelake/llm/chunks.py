"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of a text: shifted by one bit, plus a fixed random number for
the byte. Its low bits forget a byte after ``WINDOW`` more, so equal passages have equal hashes
but for their first bytes. A chunk ends where the hash is the smallest within ``REACH`` bytes on
either side and a character begins. That depends on nothing further away, so an insertion changes
the chunks around it and no others, and chunks are longer than ``REACH`` bytes but for the last.
Where nothing is smallest (one character over and over), a chunk ends after ``LONGEST`` bytes.

Chunks are compared by a 128-bit digest. A chunk found in two documents or more is repeated; it stays
in the one with the smallest id (there at its first place) and goes from the others. Repeated
chunks in a row are one passage; passages of fewer than ``PASSAGE`` bytes are left alone, as a few common words may
be. A shared text of 51 words or more is found as such a passage unless it repeats one word all along. Repeats
within a single document stay.

Digests are counted in the map tasks before they are shuffled and joined back by a join that
adaptive execution splits, so a passage that a third of all documents share is no task of its own.
Null and empty texts have no chunks. Rows alike in id and text are one document and get the
same result; null ids come first. An empty table gives an empty result. Columns of any name stay as they are.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.batches import by_pieces
from ridelake.sources.workspace import written

WINDOW, REACH, LONGEST, PASSAGE = 8, 20, 4096, 128
GEAR = np.random.default_rng(3).integers(0, 2**32, 256, dtype=np.uint32)
# A document's name, 128 bits in two halves.
NAME = ["r1", "r2"]
CHUNKS = "array<struct<start int, length int, h1 long, h2 long>>"


def cuts(data: bytes) -> list[int]:
    """Where the chunks of a text begin, and the text's end."""
    size = len(data)
    letters = np.frombuffer(data, dtype=np.uint8)
    rolled = GEAR[letters]
    width = 1
    while width < WINDOW:
        rolled[width:] = rolled[width:] + (rolled[:-width] << np.uint32(width))
        width *= 2
    # Only bits that the window decides.
    rolled = (rolled & np.uint32((1 << WINDOW) - 1)).astype(np.uint16)
    rolled[(letters & 0xC0) == 0x80] = 0xFFFF
    # The least of REACH hashes from each place on, past the end the largest.
    least, width = np.concatenate([rolled, np.full(REACH, 0xFFFF, dtype=np.uint16)]), 1
    while 2 * width <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: size + 1], least[REACH - width : REACH - width + size + 1])
    after = least[1:]
    before = np.concatenate([np.full(min(REACH, size), 0xFFFF, dtype=np.uint16), least[: max(0, size - REACH)]])
    places = np.flatnonzero((rolled < before) & (rolled <= after) & (rolled < 0xFFFF))
    bounds, last = [0], 0
    for place in [*places[places >= REACH].tolist(), size]:
        while place - last > LONGEST:
            last += LONGEST
            while last < place and data[last] & 0xC0 == 0x80:
                last -= 1
            bounds.append(last)
        if place > last:
            bounds.append(place)
            last = place
    return bounds


def _chunks(texts: list) -> pa.Array:
    offsets, starts, lengths, digests = [0], [], [], []
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if data:
            bounds = cuts(data)
            starts += bounds[:-1]
            for a, b in zip(bounds, bounds[1:]):
                lengths.append(b - a)
                digests.append(xxhash.xxh3_128_digest(data[a:b]))
        offsets.append(len(starts))
    halves = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
    chunks = pa.StructArray.from_arrays(
        [
            pa.array(starts, pa.int32()),
            pa.array(lengths, pa.int32()),
            pa.array(np.ascontiguousarray(halves[:, 0])),
            pa.array(np.ascontiguousarray(halves[:, 1])),
        ],
        names=["start", "length", "h1", "h2"],
    )
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), chunks)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row``, ``id``, ``text`` and the two halves of a name that rows alike in id and text share."""
    content = F.coalesce(F.col(text), F.lit(""))
    names = F.xxhash64(key, content).alias("r1"), F.xxhash64(content, key).alias("r2")
    return docs.select(F.struct("*").alias("row"), F.col(key).alias("id"), content.alias("text"), *names)


def _repeated(rows: DataFrame) -> DataFrame:
    """``id``, its name, ``start``, ``length`` and ``first`` (it stays) of all chunks found in several documents.

    Chunks are cut twice rather than kept in between: they take more room than the texts. Only half
    of the digest goes through the first grouping; what it lets through is told apart by all of it.
    """
    chunk = F.explode(F.arrow_udf(by_pieces(_chunks), CHUNKS)("text")).alias("chunk")
    every = rows.select(*NAME, chunk).select(*NAME, "chunk.*")
    several = (F.min("r1") != F.max("r1")) | (F.min("r2") != F.max("r2"))
    shared = every.groupBy("h1").agg(several.alias("several")).filter("several").select("h1")
    near = written(every.join(shared, "h1", "left_semi"), "repeated-chunks")
    digest = ["h1", "h2"]
    owned = near.join(rows.select(*NAME, "id").distinct(), NAME)
    place = F.struct("id", *NAME, "start")
    origin = owned.groupBy(*digest).agg(several.alias("several"), F.min(place).alias("origin"))
    origin = origin.filter("several").drop("several")
    return owned.join(origin, digest).select("id", *NAME, "start", "length", (place == F.col("origin")).alias("first"))


def _passages(rows: DataFrame) -> DataFrame:
    """Repeated chunks with ``passage``, the start of the passage they are in, and its ``size``."""
    # Rows alike in id and text have the same chunks; one of each will do. Windows go over one document.
    repeated = _repeated(rows).distinct()
    along = Window.partitionBy(*NAME).orderBy("start")
    opens = F.coalesce(F.col("start") != F.lag(F.col("start") + F.col("length")).over(along), F.lit(True))
    marked = repeated.withColumn("opened", F.when(opens, F.col("start")))
    marked = marked.withColumn("passage", F.max("opened").over(along))
    size = F.sum("length").over(Window.partitionBy(*NAME, "passage"))
    return marked.withColumn("size", size).filter(F.col("size") >= PASSAGE)


def repeated_passages(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``start``, ``n_bytes`` and ``n_dropped`` bytes of all passages that several documents share."""
    parts = _passages(_rows(docs, key, text))
    dropped = F.sum(F.when(F.col("first"), 0).otherwise(F.col("length"))).alias("n_dropped")
    groups = parts.groupBy(*NAME, "passage").agg(F.min("id").alias("id"), F.sum("length").alias("n_bytes"), dropped)
    return groups.select("id", F.col("passage").alias("start"), "n_bytes", "n_dropped")


def _rest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, drops in batches:
        kept = []
        for text, spans in zip(texts.to_pylist(), drops.to_pylist()):
            data, last, parts = (text or "").encode("utf-8", "surrogatepass"), 0, []
            for span in sorted(spans or [], key=lambda s: s["start"]):
                parts.append(data[last : span["start"]])
                last = span["start"] + span["length"]
            kept.append(b"".join([*parts, data[last:]]).decode("utf-8", "surrogatepass"))
        yield pa.array(kept, pa.string())


def without_repeats(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``row`` (the whole input row) and the ``kept`` text, without passages that stay in another document."""
    rows = _rows(docs, key, text)
    dropped = _passages(rows).filter("not first").groupBy(*NAME)
    dropped = dropped.agg(F.collect_list(F.struct("start", "length")).alias("dropped"))
    rest = F.arrow_udf(_rest, "string")
    return rows.join(dropped, NAME, "left").select("row", rest("text", "dropped").alias("kept"))
