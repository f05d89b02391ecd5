"""The joins of the lake: by cluster, and by key within a time interval."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.columns import spread

SALTS = 64
NULL_SPREAD = 4096


def left_join_small(rides: DataFrame, dim: DataFrame, on: str) -> DataFrame:
    """Left equi-join that broadcasts ``dim``; the caller has checked its size."""
    return rides.join(F.broadcast(dim), on, "left")


def left_join_salted(rides: DataFrame, dim: DataFrame, on: str, salts: int = SALTS) -> DataFrame:
    """The same join for a ``dim`` too large to broadcast.

    The join column has few values, so joining on it alone would send a third of
    the rides to one task. Each ride gets one of ``salts`` numbers and each
    ``dim`` row is repeated once per number: every pair still meets exactly once.
    """
    salted = rides.withColumn("_salt", spread(rides, salts))
    repeated = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [on, "_salt"], "left").drop("_salt")


def _bucket(micros: str, width: int) -> Column:
    """Number of the ``width``-microsecond slot that holds ``micros``, in exact integers."""
    return F.expr(f"(({micros}) - pmod({micros}, {width}L)) div {width}L")


def _with_slot(left: DataFrame, key: str, time: str, width: int) -> DataFrame:
    """Adds the slot of a left row; rows that can match nothing are spread so they form no hot group."""
    unmatchable = F.col(key).isNull() | F.col(time).isNull()
    slot = F.when(unmatchable, spread(left, NULL_SPREAD).cast("bigint"))
    return left.withColumn("_slot", slot.otherwise(_bucket(f"unix_micros(`{time}`)", width)))


def interval_left_join(
    left: DataFrame,
    right: DataFrame,
    *,
    key: str = "key",
    time: str = "pickup_datetime",
    right_key: str = "near_key",
    right_time: str = "near_time",
    minutes: int = 10,
) -> DataFrame:
    """Left rows with every right row of the same key whose time is at most ``minutes`` away.

    Both ends count, unmatched left rows stay, and the right key and time are
    dropped. On streams both sides need a watermark.

    The pairs are the result, so a key with many rows close together gives many;
    where only the distinct labels near a ride are wanted, ``reattach`` forms none.

    Joining on the key alone would compare all rows of a hot key with each other.
    Time is cut into slots instead: a left row belongs to one slot, a right row
    goes to the one or two slots its interval touches, and the join is on
    ``(key, slot)``. A pair meets in the left row's slot only, so it comes out
    once, and a hot key is spread over as many tasks as it has slots.
    """
    reach = minutes * 60 * 1_000_000
    # A wider slot repeats fewer right rows (1.5 times on average here) but
    # compares more rows of a hot key that lie further apart than the interval.
    width = 4 * reach
    micros = f"unix_micros(`{right_time}`)"
    slots = F.sequence(_bucket(f"{micros} - {reach}L", width), _bucket(f"{micros} + {reach}L", width))
    placed = right.filter(F.col(right_key).isNotNull()).withColumn("_right_slot", F.explode(slots))
    near = F.expr(
        f"`{key}` = `{right_key}` AND _slot = _right_slot"
        f" AND `{time}` BETWEEN `{right_time}` - INTERVAL {minutes} MINUTES"
        f" AND `{right_time}` + INTERVAL {minutes} MINUTES"
    )
    return (
        _with_slot(left, key, time, width)
        .join(placed, near, "left")
        .drop("_slot", "_right_slot", right_key, right_time)
    )


def reattach(
    rides: DataFrame,
    assigned: DataFrame,
    label: str,
    *,
    key: str = "key",
    time: str = "pickup_datetime",
    minutes: int = 10,
) -> DataFrame:
    """Rides with each distinct ``label`` that ``assigned`` gives their key within ``minutes``.

    Equal to ``interval_left_join`` followed by a distinct over rides that are
    themselves distinct, but no pair of rides is formed. Slots are twice
    ``minutes`` wide, so a labelled time reaches exactly two of them: from the
    first half of its slot, all of that slot up to some moment and the end of the
    slot before; from the second half, all of its slot since some moment and the
    start of the slot after. Each slot and label thus needs two facts only, the
    latest such "until" and the earliest "since". They are a max and a min, which
    combine in the map tasks. Batch only; ``reattach_stream`` is the same for streams.
    """
    reach = minutes * 60 * 1_000_000
    width = 2 * reach
    early = f"pmod(_at, {width}L) < {reach}L"
    since, until, no = f"_at - {reach}L", f"_at + {reach}L", "CAST(NULL AS BIGINT)"
    spans = F.expr(
        "stack(2,"
        f" _own, IF({early}, {no}, {since}), IF({early}, {until}, {no}),"
        f" IF({early}, _own - 1, _own + 1), IF({early}, {since}, {no}), IF({early}, {no}, {until}))"
        " AS (_label_slot, _since, _until)"
    )
    labels = (
        assigned.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
        .select(
            F.col(key).alias("_label_key"),
            F.col(label),
            F.unix_micros(time).alias("_at"),
            _bucket(f"unix_micros(`{time}`)", width).alias("_own"),
        )
        .select("_label_key", label, spans)
        .groupBy("_label_key", "_label_slot", label)
        .agg(F.min("_since").alias("_since"), F.max("_until").alias("_until"))
    )
    return (
        _with_slot(rides, key, time, width)
        .join(
            labels,
            F.expr(
                f"`{key}` = _label_key AND _slot = _label_slot"
                f" AND (unix_micros(`{time}`) <= _until OR unix_micros(`{time}`) >= _since)"
            ),
            "left",
        )
        .drop("_slot", "_label_key", "_label_slot", "_since", "_until")
    )


def reattach_stream(
    rides: DataFrame,
    assigned: DataFrame,
    label: str,
    *,
    key: str = "key",
    time: str = "pickup_datetime",
    minutes: int = 10,
    slot: str = "_slot",
    spread_over: int = 1,
) -> DataFrame:
    """``reattach`` on streams: distinct rides with each distinct label of their key within ``minutes``.

    Both sides need a watermark on ``time``; rows without a time are to be left out. A labelled time reaches the two slots whose
    span, made longer by ``minutes`` at either end, holds it: those are sliding windows. The two facts a slot
    and label needs are a streaming aggregate, and once a slot is closed they are joined to its rides. So
    the state holds rides until their slot closes, and a row for every key, open slot and label; never a pair, however many rides
    a key has. Rides are made distinct first, and come out once per label (NULL if they met none).

    The result has the ``slot`` as its event time, for whatever state follows; ``time`` is a plain column. All rides of a key
    and slot are joined in one task unless ``spread_over`` deals them to more, each with a copy of the slot's few facts.
    """
    reach = F.expr(f"INTERVAL {minutes} MINUTES")

    def windowed(df: DataFrame) -> DataFrame:
        spans = F.window(time, f"{4 * minutes} minutes", f"{2 * minutes} minutes", f"{minutes} minutes")
        return df.withColumn(slot, spans)

    first, last = F.col(f"{slot}.start") + reach, F.col(f"{slot}.end") - reach
    at = F.unix_micros(time)
    # What a label's interval covers of a slot begins with the slot or ends with it.
    until = F.when(F.col(time) - reach <= first, at + minutes * 60_000_000)
    since = F.when(F.col(time) + reach >= last, at - minutes * 60_000_000)
    labels = (
        windowed(assigned.filter(F.col(key).isNotNull()).select(key, label, time))
        .groupBy(key, slot, label)
        .agg(F.min(since).alias("_since"), F.max(until).alias("_until"))
        .withColumnsRenamed({key: "_label_key", slot: "_label_slot"})
    )
    own = windowed(rides).filter((F.col(time) >= first) & (F.col(time) < last))
    # One event time only: from here on it is the slot.
    own = own.withColumn(time, F.timestamp_micros(at)).dropDuplicates()
    met = f"`{key}` = _label_key AND `{slot}` = _label_slot AND (unix_micros(`{time}`) <= _until OR unix_micros(`{time}`) >= _since)"
    if spread_over > 1:
        own = own.withColumn("_task", F.pmod(F.xxhash64(*rides.columns), F.lit(spread_over)))
        labels = labels.withColumn("_label_task", F.explode(F.sequence(F.lit(0), F.lit(spread_over - 1))))
        met += " AND _task = _label_task"
    joined = own.join(labels, F.expr(met), "left")
    return joined.drop("_label_key", "_label_slot", "_since", "_until", "_task", "_label_task")
