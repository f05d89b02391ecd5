"""Tool-call linking: calls meet their results, in an order that respects what they need.

Calls and results are joined by conversation and call id, so a conversation of any length is spread over
tasks. Calls are ordered topologically by level: those that need nothing have level 0, every other one more than
the highest level among the calls it needs. A conversation's needs (ids only, no texts) are put in order in one pass, in one task if there are
``IN_ONE_TASK`` of them at most; calls of a conversation with more are settled round by round, a level a round. Neither
forms a pair that was not given. Arguments are parsed and checked against
their tool's schema (``json_rules``: any form of schema), and every call with its result becomes one line of canonical JSON: sorted
keys, no spaces, no escapes but those JSON asks for. Sort by conversation, level, position and id for the order.

Statuses: ``linked``, ``no result``, ``no call`` (a result whose call is missing), ``repeated`` (a call
whose id an earlier position or, at the same one, a smaller row has) and ``cycle`` (a call that needs itself in the end; no level).
Of several results of a call the first by position and text counts; ``linked`` has one row a call, and ``further_results``
has the others, ``repeated`` too. A result without a call, or a further one, has a line of its id and content.
Needs that are no call of the conversation are a problem and do not hold a call back.

Calls without an id or a conversation meet no result; a null position comes first; null arguments,
arguments that are not a JSON object, that hold a number beyond double precision's range (such as 1e400) or that are nested too deeply to be read are a
problem and null in the line, as is an unknown tool (whose arguments stay). Null texts are JSON's null. Empty tables
give empty results. Only the columns named below are read.
"""

import json
import math
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ridelake.llm.json_rules import broken_rules
from ridelake.sources.workspace import written

CALL = ["conv", "call_id"]
LINE = "line string, problems array<string>"
_LINE_ARROW = pa.struct([("line", pa.string()), ("problems", pa.list_(pa.string()))])
IN_ONE_TASK = 200_000
DEEPEST = 200


def canonical(value) -> str:
    line = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    try:
        line.encode("utf-8")
    except UnicodeEncodeError:
        # Half a character, as "\\ud800" is, can only be written as an escape.
        line = json.dumps(value, sort_keys=True, separators=(",", ":"), allow_nan=False)
    return line


def _no_repeats(pairs: list[tuple]) -> dict:
    found = dict(pairs)
    if len(found) < len(pairs):
        raise ValueError("a key is repeated")
    return found


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


class _OutOfRange(ValueError):
    pass


def _finite(number: str) -> float:
    value = float(number)
    if math.isinf(value):
        raise _OutOfRange(number)
    return value


def parsed(arguments: str | None) -> tuple[dict | None, list[str]]:
    """The arguments as an object, or what is wrong with them."""
    if arguments is None:
        return None, ["arguments are missing"]
    try:
        value = json.loads(arguments, object_pairs_hook=_no_repeats, parse_constant=_no_constant, parse_float=_finite)
        # What can be read may still be nested too deeply to be checked and written.
        _depth_fits(value)
    except _OutOfRange:
        return None, ["arguments hold a number out of range"]
    except RecursionError:
        return None, ["arguments are nested too deeply"]
    except ValueError:
        return None, ["arguments are not JSON"]
    return (value, []) if isinstance(value, dict) else (None, ["arguments are no object"])


def _depth_fits(value, most: int = DEEPEST) -> None:
    """Raises ``RecursionError`` if objects and lists are nested more than ``most`` deep."""
    level = [value]
    for _ in range(most):
        level = [own for x in level if isinstance(x, (dict, list)) for own in (x.values() if isinstance(x, dict) else x)]
        if not level:
            return
    raise RecursionError


def _lines(schemas: dict):
    def lines(
        batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array, pa.Array]],
    ) -> Iterator[pa.Array]:
        for ids, names, arguments, needs, results in batches:
            rows = []
            for row in zip(*(column.to_pylist() for column in (ids, names, arguments, needs, results))):
                call_id, name, given, needed, result = row
                value, problems = parsed(given)
                if name not in schemas:
                    problems.append("the tool is unknown")
                elif value is not None:
                    problems += broken_rules(value, schemas[name])
                needed = sorted(need for need in needed or [] if need is not None)
                record = {"arguments": value, "id": call_id, "name": name, "needs": needed, "result": result}
                rows.append({"line": canonical(record), "problems": problems})
            yield pa.array(rows, _LINE_ARROW)

    return lines


def _result_lines(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for ids, contents in batches:
        rows = zip(ids.to_pylist(), contents.to_pylist())
        yield pa.array([canonical({"id": call_id, "result": content}) for call_id, content in rows], pa.string())


def _results_alone(results: DataFrame, status: str) -> DataFrame:
    """Rows of results that stand beside the calls: without a level or problems."""
    line = F.arrow_udf(_result_lines, "string")("call_id", "content").alias("line")
    nothing = F.array().cast("array<string>").alias("problems")
    return results.select(*CALL, "position", F.lit(None).cast("int").alias("level"), F.lit(status).alias("status"), nothing, line)


def further_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """All but the first result of every call, as rows that ``linked`` leaves out of its one row a call."""
    least = F.min(F.struct("position", "content")).alias("answer")
    several = results.dropna(subset=CALL).groupBy(*CALL).agg(F.count("*").alias("n"), least).filter("n > 1")
    several = several.join(calls.select(*CALL).distinct(), CALL, "left_semi").drop("n")
    # Equal results are one row with their number, so that just one of them counts as the first.
    alike = results.join(several, CALL).groupBy(*CALL, "position", "content").agg(F.count("*").alias("n"), F.first("answer").alias("answer"))
    first = F.struct("position", "content").eqNullSafe(F.col("answer"))
    copies = F.explode(F.array_repeat(F.lit(1), (F.col("n") - first.cast("int")).cast("int")))
    return _results_alone(alike.select(*CALL, "position", "content", copies.alias("copy")), "repeated")


def levels_in_order(edges: list[tuple]) -> dict:
    """The level of every call of one conversation that needs another, from ``(call, need)``; None in or behind a cycle."""
    needs, needed_by = defaultdict(set), defaultdict(list)
    for call, need in edges:
        if need not in needs[call]:
            needs[call].add(need)
            needed_by[need].append(call)
    waiting = {call: len(own) for call, own in needs.items()}
    level = dict.fromkeys(waiting)
    settled = [(need, 0) for need in needed_by if need not in waiting]
    # Each call comes in once, after all that it needs, the last of which has the highest level.
    while settled:
        further = []
        for need, own in settled:
            for call in needed_by[need]:
                waiting[call] -= 1
                if not waiting[call]:
                    level[call] = own + 1
                    further.append((call, own + 1))
        settled = further
    return level


def _conversations(schema: pa.Schema):
    """Levels from edges that come sorted by conversation."""

    def rows(conv, edges):
        found = levels_in_order(edges)
        columns = [[conv] * len(found), list(found), list(found.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, edges = None, []
        for batch in batches:
            for own, call, need in zip(*(column.to_pylist() for column in batch.columns)):
                if own != conv and edges:
                    yield rows(conv, edges)
                    edges = []
                conv = own
                edges.append((call, need))
        if edges:
            yield rows(conv, edges)

    return run


def _level_by_level(edges: DataFrame) -> DataFrame:
    """The same for conversations of any size: each round takes away the calls that need none of those left."""
    left = edges
    found, level, count = edges.select(*CALL, F.lit(0).alias("level")).limit(0), 0, edges.count()
    while count:
        level += 1
        waiting = left.select("conv", F.col("call_id").alias("need")).distinct()
        still = written(left.join(waiting, ["conv", "need"], "left_semi").select(*CALL, "need"), "waiting")
        settled = left.select(*CALL).distinct().join(still.select(*CALL).distinct(), CALL, "left_anti")
        found = written(found.union(settled.withColumn("level", F.lit(level))), "levels")
        before, count, left = count, still.count(), still
        if count == before:
            break
    # What is left needs itself in the end.
    return found.union(left.select(*CALL, F.lit(None).cast("int")).distinct())


def _levels(edges: DataFrame) -> DataFrame:
    """``conv``, ``call_id`` and ``level`` of every call that needs another; null for those in or behind a cycle."""
    edges = edges.select(*CALL, "need")
    large = edges.groupBy("conv").count().filter(F.col("count") > IN_ONE_TASK).select("conv")
    shape = T.StructType([*edges.schema.fields[:2], T.StructField("level", T.IntegerType())])
    if large.isEmpty():
        return _in_tasks(edges, shape)
    large = written(large, "large-conversations")
    rest = written(edges.join(large, "conv", "left_semi").select(*CALL, "need").distinct(), "waiting")
    return _in_tasks(edges.join(large, "conv", "left_anti"), shape).union(_level_by_level(rest))


def _in_tasks(edges: DataFrame, shape: T.StructType) -> DataFrame:
    together = edges.repartition("conv").sortWithinPartitions("conv")
    return together.select(*CALL, "need").mapInArrow(_conversations(to_arrow_schema(shape)), shape)


def linked(calls: DataFrame, results: DataFrame, schemas: dict) -> DataFrame:
    """One row for every call, and every result without one; ``further_results`` has what a call got besides its first result.

    ``calls`` has ``conv``, ``call_id``, ``position``, ``name``, ``arguments`` (JSON) and ``needs`` (call ids);
    ``results`` has ``conv``, ``call_id``, ``position`` and ``content``. The result has ``conv``, ``call_id``,
    ``position``, ``level``, ``status``, ``problems`` and the ``line``.
    """
    calls = calls.select(*CALL, "position", "name", "arguments", F.array_distinct("needs").alias("needs"))
    in_turn = Window.partitionBy(*CALL).orderBy("position", "name", "arguments", F.col("needs").cast("string"))
    nth = F.when(F.col("conv").isNull() | F.col("call_id").isNull(), 1).otherwise(F.row_number().over(in_turn))
    calls = written(calls.withColumn("nth", nth), "calls")
    first = calls.filter("nth = 1")
    known = first.select(*CALL).dropna()
    edges = first.select(*CALL, F.explode("needs").alias("need")).filter("need is not null")
    there = known.select("conv", F.col("call_id").alias("need"), F.lit(True).alias("there"))
    edges = written(edges.join(there, ["conv", "need"], "left"), "edges")
    missing = edges.filter("there is null").groupBy(*CALL)
    missing = missing.agg(F.sort_array(F.collect_set(F.concat("need", F.lit(" is no call")))).alias("missing"))
    levels = _levels(edges.filter("there")).withColumn("needing", F.lit(True))
    answers = results.groupBy(*CALL).agg(F.min(F.struct("position", "content")).alias("answer"))
    met = first.join(answers, CALL, "left").join(levels, CALL, "left").join(missing, CALL, "left")
    cycle = F.col("needing").isNotNull() & F.col("level").isNull()
    status = F.when(cycle, "cycle").when(F.col("answer").isNull(), "no result").otherwise("linked")
    rows = met.select(
        *CALL,
        "position",
        F.when(~cycle, F.coalesce("level", F.lit(0))).alias("level"),
        status.alias("status"),
        "name",
        "arguments",
        "needs",
        F.col("answer.content").alias("content"),
        F.coalesce("missing", F.array().cast("array<string>")).alias("missing"),
    )
    nothing = F.array().cast("array<string>")
    again = calls.filter("nth > 1").select(
        *CALL, "position", F.lit(None).cast("int"), F.lit("repeated"), "name", "arguments", "needs",
        F.lit(None).cast("string"), nothing,
    )
    orphans = _results_alone(results.join(known, CALL, "left_anti"), "no call")
    line = F.arrow_udf(_lines(schemas), LINE)("call_id", "name", "arguments", "needs", "content").alias("made")
    made = rows.union(again).withColumn("made", line)
    made = made.select(
        *CALL, "position", "level", "status", F.concat("made.problems", "missing").alias("problems"), "made.line"
    )
    return made.union(orphans)
