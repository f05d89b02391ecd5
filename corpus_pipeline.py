"""The corpus pipeline: documents in, sharded training documents out.

Every stage works on all that its predecessor kept, is written as a table and read again. Documents that are
taken to be toxic go; of every group of near duplicates one stays; documents that hold a benchmark item go;
sources are mixed to their weights by repeating documents; what is left is dealt to shards.
"""

from pyspark.sql import DataFrame, SparkSession

from ridelake.llm import containment, forest, mixing, slots, toxicity
from ridelake.llm.queries import CATEGORIES, SHARDS
from ridelake.llm.rows import fresh_name
from ridelake.sources.workspace import drop_folder, folders_dropped, new_folder


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity chain rejects."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    chain = toxicity.fit_chain(docs, labels, "doc_id", "text", CATEGORIES)
    return chain.scored(docs, "text").filter(~toxicity.rejected("toxic")).select("row.*")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near duplicates."""
    return forest.one_of_each(docs, "doc_id", "text")


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return containment.without_items(docs, "text", items, "item_id", "text")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share asks for."""
    return mixing.mix(docs, "text", "source", "doc_id")


def deal_to_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their place in it."""
    placed = slots.sharded(docs, "doc_id", "text", SHARDS)
    added = [placed[name].alias(fresh_name(docs, name)) for name in ("shard", "position", "virtual_slot")]
    return placed.select("row.*", *added)


STAGES = [
    ("toxicity", keep_clean),
    ("near_duplicates", keep_one_of_each),
    ("benchmark_items", keep_unseen),
    ("source_mix", mix_sources),
    ("shards", deal_to_shards),
]

# A fitted classifier and a similarity join are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; a stage's own tables go once its documents are written, and its documents once the next stage has used them."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"pipeline-{name}")
        with folders_dropped(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            drop_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
