"""Sharding over fixed virtual slots.

A record's hash names one of ``SLOTS`` slots for good. Bytes are summed per slot, and a
versioned map says which shard holds which slot. Version 0 deals slots in turn. A map is kept under a path: given that path
again, with more data or another number of shards, its latest version is read, only as many slots are moved
as bring the shards' bytes level, and the result is added as the next version. Records of all other slots stay where they are.
The driver holds one row per slot, ``SLOTS`` at most, never one per record.

Records of one text are spread by their ids, as a group of equal texts may be larger than a shard's share of the bytes.

Null texts have a size of 8. Records with a null id are spread by their texts.
Repeated rows go to the same slot, in positions of their own. An empty table gives an
empty result. Columns of any name stay as they are.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridelake.sources.workspace import list_folder, new_folder

SLOTS = 8192
MAP = "version int, slot int, shard int, bytes long, first long"


def slot_of(key: Column, text: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key, F.crc32(text.cast("binary"))), F.lit(slots)).cast("int")


def rebalanced(shards: dict[int, int], sizes: dict[int, int], count: int) -> dict[int, int]:
    """Moves slots one by one from the fullest to the emptiest shard while that evens them out."""
    held: dict[int, dict[int, int]] = {shard: {} for shard in range(count)}
    for slot, shard in shards.items():
        held[shard][slot] = sizes.get(slot, 0)
    load = {shard: sum(slots.values()) for shard, slots in held.items()}
    while True:
        full, empty = max(load, key=lambda s: (load[s], -s)), min(load, key=lambda s: (load[s], s))
        gap = load[full] - load[empty]
        movable = [(size, -slot) for slot, size in held[full].items() if 0 < size < gap]
        if not movable:
            return {slot: shard for shard, slots in held.items() for slot in slots}
        size, slot = min(movable, key=lambda m: (abs(gap - 2 * m[0]), m[1]))
        held[empty][-slot] = held[full].pop(-slot)
        load[full] -= size
        load[empty] += size


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a stored map, by default the latest: a row for every slot."""
    versions = spark.read.schema(MAP).parquet(path)
    latest = versions.agg(F.max("version")).first()[0] if version is None else version
    return versions.filter(F.col("version") == latest)


def slot_map(sized: DataFrame, shards: int, slots: int = SLOTS, path: str | None = None) -> tuple[DataFrame, str]:
    """The next version of the map under ``path``, level by bytes, and the path (a new one if none is given).

    ``sized`` has ``slot`` and ``size`` of every record. A new map gets version 0, slots in turn, first. Slots of shards that are
    no longer there are dealt in turn to those that are. ``first`` numbers the rows of a shard: the position of
    the slot's first row. One call for a path at a time.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()
    sizes = {row["slot"]: row["bytes"] for row in totals}
    rows = {row["slot"]: row["n"] for row in totals}
    versions = {}
    if path is not None and list_folder(spark, path):
        stored = read_map(spark, path).collect()
        if len(stored) != slots:
            raise ValueError(f"the map under {path} has {len(stored)} slots, not {slots}")
        latest = stored[0]["version"]
        before = {row["slot"]: row["shard"] if row["shard"] < shards else row["slot"] % shards for row in stored}
    else:
        path = new_folder(spark, "slot-map") if path is None else path
        before, latest = {slot: slot % shards for slot in range(slots)}, 0
        versions[0] = before
    versions[latest + 1] = rebalanced(before, sizes, shards)
    table = []
    for version, shard_of in versions.items():
        filled = [0] * shards
        for slot in range(slots):
            shard = shard_of[slot]
            table.append((version, slot, shard, sizes.get(slot, 0), filled[shard]))
            filled[shard] += rows.get(slot, 0)
    spark.createDataFrame(table, MAP).coalesce(1).write.mode("append").partitionBy("version").parquet(path)
    return read_map(spark, path, latest + 1), path


def sharded(
    docs: DataFrame, key: str, text: str, shards: int, slots: int = SLOTS, path: str | None = None
) -> DataFrame:
    """``row``, ``size``, ``text_crc32``, ``virtual_slot``, ``shard`` and the row's ``position`` in its shard, from 0.

    Sizes of shards are nearly equal in bytes. Rows are numbered within a slot, a few
    thousandths of the records, and slots within their shard, so no task sees a whole shard. ``path`` is that of the
    map: under the path of an earlier call its map is edited.
    """
    data = F.col(text).cast("binary")
    sized = docs.select(
        F.struct("*").alias("row"),
        F.col(key).alias("key"),
        slot_of(F.col(key), F.col(text), slots).alias("slot"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(data).alias("crc"),
    )
    places, _ = slot_map(sized.select("slot", "size"), shards, slots, path)
    in_slot = Window.partitionBy("slot").orderBy("key", "crc", "size")
    numbered = sized.withColumn("nth", F.row_number().over(in_slot) - 1)
    placed = numbered.join(F.broadcast(places.select("slot", "shard", "first")), "slot")
    return placed.select(
        "row",
        "size",
        F.col("crc").alias("text_crc32"),
        F.col("slot").alias("virtual_slot"),
        "shard",
        (F.col("first") + F.col("nth")).cast("long").alias("position"),
    )
