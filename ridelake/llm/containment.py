"""Benchmark decontamination: short test items inside long documents.

A set of twenty shingles inside one of ten thousand has a similarity too small for any
MinHash signature. So items are partitioned by size, in powers of two, and for the items
of up to u shingles every document is cut into windows of 2u shingles, one every u: whatever
run of u shingles an item may be in lies whole within a window of comparable size. A window
and an item that agree in one of ``ORDERS`` MinHash values are candidates, and candidates are verified by
counting the item's shingles in the whole document. Of the items that a document holds in one
piece this misses 1 in 100,000, of those with the least containment asked for 5 in 100,000.

Items of up to ``SMALLEST`` shingles are too short for windows and none is missed: a document that holds enough of such
an item holds one of any so many of its shingles as it may lack and one more, and these are looked up exactly.

The windows' minima come from minima over blocks of u shingles, and those of
larger sizes from the smaller ones, so a document is hashed once, whatever its length.

Items are sent to the tasks in parts of about ``PART_BYTES``, one after the other: each part is one pass over the documents, which is
written before the next part is sent, so the driver and a worker hold one part at a time. Nothing is shuffled and no document
leaves its row. Keys of items may be of any type, and null.

Items without words (null, empty, blank) are found nowhere. An item of fewer than five words is
one shingle, and only found in a document of the same words. Equal items are all reported. Documents
without words hold nothing; repeated documents are each reported. Empty tables on either
side give no pairs. Columns of any name stay as they are.
"""

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import LongType, StructField, StructType

from ridelake.llm.shingles import MinHash, Shingler
from ridelake.sources.workspace import written

ORDERS = 48
SEED = 11
PART_BYTES = 8_000_000
# ``item`` is its number in its part.
HITS = "array<struct<item long, shared long, size long>>"
_HITS_ARROW = pa.list_(pa.struct([("item", pa.int64()), ("shared", pa.int64()), ("size", pa.int64())]))
SMALLEST = 8


class ItemIndex:
    """The items of one part, by size class and MinHash value."""

    def __init__(self, items: list[tuple[int, str]], share: int, of: int):
        self._share, self._of = share, of
        self._shingler, self._orders = Shingler(), MinHash(ORDERS, SEED)
        self._sets, self._owners = [], defaultdict(lambda: defaultdict(list))
        self._small: dict[int, list[int]] = defaultdict(list)
        keys = defaultdict(set)
        for item, text in items:
            shingles = self._shingler.distinct(text)
            if not len(shingles):
                continue
            if len(shingles) <= SMALLEST:
                least = max(1, -(-share * len(shingles) // of))
                for shingle in shingles[: len(shingles) - least + 1].tolist():
                    self._small[shingle].append(len(self._sets))
                self._sets.append((item, shingles))
                continue
            size = 1 << (len(shingles) - 1).bit_length()
            for key in self._keys(self._orders.signature(shingles)[:, None]).ravel().tolist():
                self._owners[size][key].append(len(self._sets))
                keys[size].add(key)
            self._sets.append((item, shingles))
        self._known = {size: np.array(sorted(found), dtype=np.uint64) for size, found in keys.items()}
        self._small_known = np.array(sorted(self._small), dtype=np.uint64)
        # A quick test by some bits of a key; what passes is looked up.
        self._filter = {}
        for size, known in self._known.items():
            self._filter[size] = np.zeros(1 << 20, dtype=bool)
            self._filter[size][known & np.uint64((1 << 20) - 1)] = True

    @staticmethod
    def _keys(minima: np.ndarray) -> np.ndarray:
        """Values with their order's number; the low bits differ by order."""
        number = np.arange(len(minima), dtype=np.uint64)[:, None]
        return (number << np.uint64(32)) | (minima.astype(np.uint64) ^ (number * np.uint64(0x9E3779B1) & np.uint64(0xFFFFFFFF)))

    def find(self, text: str | None) -> list[dict]:
        """The items that ``text`` holds at least ``share`` / ``of`` of."""
        shingles = self._shingler.sequence(text)
        if not len(shingles):
            return []
        candidates = self._small_matches(shingles)
        if self._known:
            candidates |= self._window_matches(shingles)
        if not candidates:
            return []
        whole = np.unique(shingles)
        hits = []
        for number in candidates:
            item, wanted = self._sets[number]
            shared = int(np.isin(wanted, whole, assume_unique=True).sum())
            if self._of * shared >= self._share * len(wanted):
                hits.append({"item": item, "shared": shared, "size": len(wanted)})
        return sorted(hits, key=lambda hit: hit["item"])

    def _small_matches(self, shingles: np.ndarray) -> set[int]:
        if not len(self._small_known):
            return set()
        at = np.minimum(np.searchsorted(self._small_known, shingles), len(self._small_known) - 1)
        found = np.unique(shingles[self._small_known[at] == shingles]).tolist()
        return {number for shingle in found for number in self._small[shingle]}

    def _window_matches(self, shingles: np.ndarray) -> set[int]:
        candidates = set()
        blocks, width = self._block_minima(shingles), SMALLEST
        largest = max(self._known)
        while True:
            if width in self._known:
                windows = np.minimum(blocks[:, :-1], blocks[:, 1:]) if blocks.shape[1] > 1 else blocks
                candidates |= self._matches(width, windows)
            if width >= largest:
                return candidates
            if blocks.shape[1] % 2:
                blocks = np.concatenate([blocks, blocks[:, -1:]], axis=1)
            blocks, width = np.minimum(blocks[:, ::2], blocks[:, 1::2]), 2 * width

    def _block_minima(self, shingles: np.ndarray) -> np.ndarray:
        """Minima over blocks of the smallest width, piece by piece, so that long texts need no more memory."""
        parts, step = [], 512 * SMALLEST
        for i in range(0, len(shingles), step):
            places = self._orders.ordered(shingles[i : i + step])
            starts = np.arange(0, places.shape[1], SMALLEST)
            parts.append(np.minimum.reduceat(places, starts, axis=1))
        return np.concatenate(parts, axis=1)

    def _matches(self, width: int, windows: np.ndarray) -> set[int]:
        keys = self._keys(windows)
        keys = keys[self._filter[width][keys & np.uint64((1 << 20) - 1)]]
        if not len(keys):
            return set()
        known = self._known[width]
        keys = np.unique(keys)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        found = keys[known[at] == keys].tolist()
        return {number for key in found for number in self._owners[width][key]}


def _searcher(part, share: int, of: int):
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = ItemIndex(part.value, share, of)
        for texts in batches:
            yield pa.array([index.find(text) for text in texts.to_pylist()], _HITS_ARROW)

    return search


def item_parts(items: DataFrame, key: str, text: str) -> list[DataFrame]:
    """The items as ``item`` and ``text``, in parts of about ``PART_BYTES``; one part if there are none."""
    plain = items.select(F.col(key).alias("item"), F.col(text).alias("text")).filter("text is not null")
    total = plain.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    count = max(1, -(-total // PART_BYTES))
    if count == 1:
        return [plain]
    plain = written(plain, "items")
    part = F.pmod(F.xxhash64(F.col("item").cast("string"), "text"), F.lit(count))
    return [plain.filter(part == number) for number in range(count)]


class SentItems:
    """One part of the items, sent to the tasks until it is dropped."""

    def __init__(self, part: DataFrame):
        spark, rows = part.sparkSession, part.collect()
        kind = StructType([StructField("number", LongType()), part.schema["item"]])
        self.names = spark.createDataFrame([(number, row["item"]) for number, row in enumerate(rows)], kind)
        self._rows = spark.sparkContext.broadcast([(number, row["text"]) for number, row in enumerate(rows)])

    def contained(self, text: Column, share: int, of: int) -> Column:
        """A column of the items that a text holds: item's number, shingles shared, shingles of the item."""
        return F.arrow_udf(_searcher(self._rows, share, of), HITS)(F.coalesce(text, F.lit("")))

    def drop(self) -> None:
        self._rows.destroy()


def found_items(
    docs: DataFrame, key: str, text: str, items: DataFrame, item_key: str, item_text: str, share: int = 80, of: int = 100
) -> DataFrame:
    """``item``, ``id`` of the document, ``shared`` and ``size`` for every item that a document holds."""
    parts, found = item_parts(items, item_key, item_text), []
    for part in parts:
        sent = SentItems(part)
        hits = docs.select(F.col(key).alias("id"), F.explode(sent.contained(F.col(text), share, of)).alias("hit"))
        hits = hits.join(F.broadcast(sent.names), F.col("hit.item") == F.col("number"))
        hits = hits.select("item", "id", "hit.shared", "hit.size")
        if len(parts) == 1:
            return hits
        found.append(written(hits, "found-items"))
        sent.drop()
    return reduce(DataFrame.union, found)


def without_items(
    docs: DataFrame, text: str, items: DataFrame, item_key: str, item_text: str, share: int = 80, of: int = 100
) -> DataFrame:
    """The documents that hold no item, with their columns."""
    parts = item_parts(items, item_key, item_text)
    for part in parts:
        sent = SentItems(part)
        hits = docs.select(F.struct("*").alias("row"), sent.contained(F.col(text), share, of).alias("hits"))
        docs = hits.filter(F.size("hits") == 0).select("row.*")
        if len(parts) > 1:
            docs = written(docs, "unseen")
            sent.drop()
    return docs
