"""Mixing sources to target weights by repeating documents (Spark functions only).

Sources share all words by weight. No source may be repeated more than ``most`` times,
so a source whose share is larger gets ``most`` times its words, and what it leaves is
shared again by weight. That ends at one level ``x`` with target = min(x * weight,
most * words), found from running sums over the sources in order of most * words / weight.

Every document is then emitted floor(target / words) times, and once more with a probability
equal to the fraction left, decided by hashes. Draws of their own would let a few long documents make a source miss its
target by much. So documents of similar length are drawn together, first those with at least 1/8 of their source's words, then those with 1/64,
1/512 and 1/4096 (no more than 4096 in all): in falling order of words, from a start that a hash of the source gives, the running sum of the
chance takes a document whenever it passes a whole number. So each is taken with that chance, and together they miss what is expected by
less than the longest of them. All that come after make up for it: their common chance is moved by the words missed. The miss is nought on average, so
over all seeds every document's chance is the fraction. It is moved no further than it surely stays between 0 and 1, by a
share that the source's sizes decide. All shorter documents are drawn one by one, by the hash of their ids.

Null texts have no words and stay in the result. A null source is a source of its
own, the last. Rows of a source with equal ids and word counts fall alike; rows with a null id are told apart by
their texts. An empty table gives an empty result. Columns of any name stay as they are.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.rows import word_count
from ridelake.sources.workspace import written

WEIGHTS = (5, 2, 1)
MOST = 3
# Documents of at least 1 / STEP**k of their source's words are of level k at most; one task orders those of a source and level.
STEP, LEVELS = 8, 4
# A source is a row of about 100 bytes, a large document taken once more another 8: a broadcast of a few MB at most.
BROADCAST_SOURCES, BROADCAST_TAKEN = 50_000, 500_000


def _dealt(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows dealt by ``order`` to numbered parts, each after the one before; a table."""
    return written(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-ordered")


def _summed_before(dealt: DataFrame, order: list[Column], **values: Column) -> DataFrame:
    """Of every value, its sum ``<name>_before`` the row and its sum ``<name>_whole`` over all rows.

    Sums run within the parts; one row per part is all that ever meets in one task.
    """
    sums = dealt.groupBy("part").agg(*[F.sum(value).alias(name) for name, value in values.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sums.select(
        F.col("part").alias("at"),
        *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_parts") for name in values],
        *[F.sum(name).over(Window.partitionBy()).alias(f"{name}_whole") for name in values],
    )
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = dealt.join(F.broadcast(parts), F.col("part") == F.col("at"))
    for name, value in values.items():
        inside = F.coalesce(F.sum(value).over(within), F.lit(0))
        joined = joined.withColumn(f"{name}_before", F.col(f"{name}_parts") + inside)
    return joined.drop("part", "at", *[f"{name}_parts" for name in values])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` from rows of ``source`` and ``size``; one row per source.

    Sources are ranked by code point, null last, and take the weights in turn.
    """
    by_source = [F.col("source").asc_nulls_last()]
    per_source = written(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    ranked = _summed_before(_dealt(per_source, *by_source), by_source, turn=F.lit(1))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("turn_before") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * most
    leveled = ranked.select("source", "source_size", F.col("turn_before").alias("turn"), weight.alias("weight"))
    leveled = leveled.withColumn("level", limit / F.col("weight"))
    by_level = [F.col("level"), F.col("turn")]
    summed = _summed_before(_dealt(leveled, *by_level), by_level, limit=limit, weight=F.col("weight"), words=F.col("source_size"))
    # If all sources before this one are at their limit, the rest share what is left. Of the sources that this keeps under
    # their limits the first has the level, and the largest share.
    shared = (F.col("words_whole") - F.col("limit_before")) / (F.col("weight_whole") - F.col("weight_before"))
    summed = written(summed.withColumn("shared", shared), "mix-levels")
    x = summed.agg(F.max(F.when(F.col("shared") <= F.col("level"), F.col("shared")))).first()[0]
    target = F.least(F.lit(x).cast("double") * F.col("weight"), limit.cast("double"))
    return summed.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def uniform(identity: Column, seed: Column) -> Column:
    """A number from 0 up to 1 from the first 52 bits of a hash; the same on every run."""
    digest = F.md5(F.concat_ws(":", seed.cast("string"), identity).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def _level() -> Column:
    """1 for the longest documents of a source; null for those that are drawn one by one."""
    reach = [F.when(F.col("size") * STEP**level >= F.col("source_size"), level) for level in range(1, LEVELS + 1)]
    return F.when(F.col("size") > 0, F.coalesce(*reach))


def _name() -> Column:
    """Tells the large documents of one source apart."""
    return F.xxhash64("identity", "size")


def _with_source(docs: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Documents with what is known of their source; nulls meet as well.

    A few sources are sent to all tasks. For more, the adaptive skew join splits a hot one.
    """
    side = sources.withColumnRenamed("source", "known")
    side = F.broadcast(side) if few else side
    return docs.join(side, F.col("source").eqNullSafe(F.col("known")), "left").drop("known")


def _drawn(sizes: DataFrame, rates: DataFrame, seed: int) -> DataFrame:
    """The rates with the names of the documents ``taken`` once more, of all that have a level, and the ``chance`` of all others."""
    few = rates.count() <= BROADCAST_SOURCES
    known = _with_source(sizes, rates, few).withColumn("level", _level()).filter("level is not null")
    # Rows that fall alike are one document of all their words.
    large = known.groupBy("source", "level", "identity", "size").agg(F.sum("size").alias("words"))
    falling = Window.partitionBy("source", "level")
    falling = falling.orderBy(F.desc("words"), uniform(F.col("identity"), F.lit(seed)), "identity", "size")
    start = uniform(F.concat_ws(":", F.lit("source"), "level", "source"), F.lit(seed))
    placed = large.select("source", "level", "words", start.alias("start"), F.row_number().over(falling).alias("place"), _name().alias("name"))
    placed = written(placed, "mix-large")
    state = rates.withColumns({"chance": F.col("fraction"), "room": F.least(F.col("fraction"), 1 - F.col("fraction"))})
    state = state.withColumns({"others": F.col("source_size"), "taken": F.array().cast("array<long>")})
    for level in range(1, LEVELS + 1):
        state = written(_after_level(placed.filter(F.col("level") == level), state, few), "mix-state")
    return state.select("source", "source_size", "target", "whole", "taken", "chance")


def _after_level(placed: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """The sources once the documents of one level are drawn, and the chance that this leaves to all shorter ones."""
    passed = F.floor(F.expr("start + place * chance")) > F.floor(F.expr("start + (place - 1) * chance"))
    drawn = _with_source(placed, state.select("source", "chance"), few).withColumn("passed", passed)
    sums = drawn.groupBy(F.col("source").alias("drawn")).agg(
        F.sum("words").alias("words"),
        F.max("words").alias("longest"),
        F.sum(F.when(F.col("passed"), F.col("words")).otherwise(0)).alias("got"),
        F.collect_list(F.when(F.col("passed"), F.col("name"))).alias("names"),
    )
    joined = state.join(sums, F.col("source").eqNullSafe(F.col("drawn")), "left")
    joined = joined.withColumn("others", F.col("others") - F.coalesce("words", F.lit(0)))
    share = F.least(F.lit(1.0), F.expr("room / 2 * others / longest"))
    moved = F.when(F.col("others") > 0, share * F.expr("(got - chance * words) / others"))
    return joined.withColumns(
        {
            "chance": F.col("chance") - F.coalesce(moved, F.lit(0.0)),
            "room": F.when(F.col("words").isNull(), F.col("room")).otherwise(F.col("room") / 2),
            "taken": F.concat("taken", F.coalesce("names", F.array().cast("array<long>"))),
        }
    ).select(*state.columns)


def with_copies(docs: DataFrame, text: str, source: str, key: str, seed: int = 0) -> DataFrame:
    """Every document once: ``row``, ``size``, ``source_size``, ``target`` and how many ``copies`` the mix takes."""
    identity = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), F.md5(F.col(text).cast("binary"))))
    known = [
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.coalesce(identity, F.lit("")).alias("identity"),
    ]
    sizes = written(docs.select(*known), "mix-sizes")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = targets(sizes.select("source", "size")).withColumn("whole", F.floor(rate)).withColumn("fraction", rate - F.floor(rate))
    drawn = written(_drawn(sizes, written(rates, "mix-rates"), seed), "mix-draws")
    sources, taken = drawn.agg(F.count("*"), F.coalesce(F.sum(F.size(F.coalesce("taken", F.array()))), F.lit(0))).first()
    few = sources <= BROADCAST_SOURCES and taken <= BROADCAST_TAKEN
    joined = _with_source(docs.select(F.struct("*").alias("row"), *known), drawn, few)
    once_more = F.when(_level().isNotNull(), F.array_contains("taken", _name())).otherwise(
        uniform(F.col("identity"), F.lit(seed)) < F.col("chance")
    )
    copies = (F.col("whole") + once_more.cast("long")).alias("copies")
    return joined.select("row", "size", "source_size", "target", copies)


def mix(docs: DataFrame, text: str, source: str, key: str, seed: int = 0) -> DataFrame:
    """The mixed documents themselves, each as often as the mix takes it, with the columns of ``docs``."""
    planned = with_copies(docs, text, source, key, seed).filter("copies > 0")
    return planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
