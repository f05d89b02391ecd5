"""The registered queries of the operators, each over its whole table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake.llm import alignment, chunks, containment, fingerprints, forest, lexical, line_runs, mixing, neighbours
from ridelake.llm import slots, token_counts, tool_calls, toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERY_EVERY, NEAREST = 20, 20
SHARDS = 24
# The label columns there are; toxicity last, so that it can lean on quality.
CATEGORIES = ["quality", "toxic"]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 1024
LINE_BATCHES = 4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = neighbours.nearest(vectors, "vec_id", "embedding", F.col("id") % QUERY_EVERY == 0, NEAREST)
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = slots.sharded(docs, "doc_id", "text", SHARDS)
    return placed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("position").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op3_near_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = forest.near_components(docs, "doc_id", "text", 85, 100)
    kept = (F.col("id") == F.col("component")).alias("kept")
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept)


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit_chain(docs, _table(spark, sf_dir, "labels"), "doc_id", "text", CATEGORIES)
    return chain.scored(docs, "text").select(
        F.col("row.doc_id").alias("doc_id"), "quality", F.col("toxic").alias("toxicity"), toxicity.rejected("toxic").alias("toxic")
    )


def op5_prefix_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.counted(docs, "text", token_counts.read_vocabulary(spark, TOKENIZER))
    over = (F.col("table.n_tokens") > TOKEN_LIMIT).alias("over_limit")
    return counted.select(F.col("row.doc_id").alias("doc_id"), "table.n_bytes", "table.n_tokens", over)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    planned = mixing.with_copies(docs, "text", "source", "doc_id")
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return planned.select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", taken)


def op7_benchmark_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = containment.found_items(docs, "doc_id", "text", _table(spark, sf_dir, "benchmark"), "item_id", "text")
    return found.select(
        F.col("item").alias("item_id"), F.col("id").alias("doc_id"), "shared", F.col("size").alias("item_shingles")
    )


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = chunks.repeated_passages(docs, "doc_id", "text")
    kept = (F.col("n_dropped") == 0).alias("kept")
    return found.select(F.col("id").alias("doc_id"), "start", "n_bytes", "n_dropped", kept)


# The tools that assistant turns are taken to call, and what their arguments may be.
SCHEMAS = {
    "search": {
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1, "maximum": 50}},
    },
    "summarise": {
        "required": ["text"],
        "properties": {"text": {"type": "string"}, "words": {"type": "integer", "minimum": 10}},
    },
    "translate": {
        "required": ["text", "to"],
        "properties": {"text": {"type": "string"}, "to": {"type": "string", "enum": ["en", "de", "fr", "es"]}},
    },
}


def calls_of(turns: DataFrame) -> DataFrame:
    """Assistant turns as calls: the tool goes by the turn, its arguments come from the text, and it needs the call two turns before, if that is one."""
    name = F.element_at(F.array(*map(F.lit, SCHEMAS)), (F.floor(F.col("turn") / 2) % 3 + 1).cast("int"))
    length = F.char_length("text")
    search = F.to_json(F.struct((length % 60).alias("limit"), F.col("text").alias("query")))
    summarise = F.to_json(F.struct((length % 100).alias("words"), "text"))
    languages = F.array(*map(F.lit, ["en", "de", "fr", "es", "la"]))
    translate = F.to_json(F.struct(F.element_at(languages, (F.col("conv_id") % 5 + 1).cast("int")).alias("to"), "text"))
    arguments = F.when(name == "search", search).when(name == "summarise", summarise).otherwise(translate)
    needs = F.when(F.col("answers"), F.array(_call_id(-2))).otherwise(F.array().cast("array<string>"))
    return _after_call(turns.filter("role = 'assistant'"), turns, 2).select(
        F.col("conv_id").alias("conv"),
        _call_id(0).alias("call_id"),
        F.col("turn").alias("position"),
        name.alias("name"),
        arguments.alias("arguments"),
        needs.alias("needs"),
    )


def results_of(turns: DataFrame) -> DataFrame:
    """User turns that follow an assistant turn as its results; those that open a conversation or follow its system turn are prompts."""
    return _after_call(turns.filter("role = 'user'"), turns, 1).filter("answers").select(
        F.col("conv_id").alias("conv"), _call_id(-1).alias("call_id"), F.col("turn").alias("position"), F.col("text").alias("content")
    )


def _after_call(some: DataFrame, turns: DataFrame, back: int) -> DataFrame:
    """Some of the turns, each with whether the turn so far back is an assistant's (``answers``)."""
    calls = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") + back).alias("turn")).distinct()
    calls = calls.withColumn("found", F.lit(True))
    return some.join(calls, ["conv_id", "turn"], "left").withColumn("answers", F.col("found").isNotNull()).drop("found")


def _call_id(back: int) -> Column:
    return F.concat(F.lit("call-"), F.col("conv_id"), F.lit("-"), F.col("turn") + back)


def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    calls, results = calls_of(turns), results_of(turns)
    found = tool_calls.linked(calls, results, SCHEMAS).union(tool_calls.further_results(calls, results))
    problems = F.array_join("problems", "; ").alias("problems")
    return found.select(F.col("conv").alias("conv_id"), "call_id", "position", "level", "status", problems, "line")


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(LINE_BATCHES))
    kept = line_runs.drop_common_lines(docs, "text", batch, LINE_BATCHES)
    digest = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", digest)


def op11_shared_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = lexical.ranked(docs, "doc_id", "text", items, "item_id", "text", NEAREST)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.aligned(docs, "doc_id", "text", alignment.read_tokenizers(spark, TOKENIZER, PIECES))
    return found.withColumnRenamed("id", "doc_id")


def op13_bucket_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.against_next(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Query] = {
    "op1_multiprobe": op1_multiprobe,
    "op2_virtual_slots": op2_virtual_slots,
    "op3_near_components": op3_near_components,
    "op4_toxicity_chain": op4_toxicity_chain,
    "op5_prefix_tokens": op5_prefix_tokens,
    "op6_mix_sources": op6_mix_sources,
    "op7_benchmark_items": op7_benchmark_items,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_tool_calls": op9_tool_calls,
    "op10_line_runs": op10_line_runs,
    "op11_shared_ranking": op11_shared_ranking,
    "op12_token_alignment": op12_token_alignment,
    "op13_bucket_digests": op13_bucket_digests,
}
