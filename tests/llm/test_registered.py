"""The registered queries over whole tables, and the pipeline against brute force."""

import json
import math
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from llm.test_near import components_by_hand, passages_by_hand, shingles  # noqa: E402
from ridelake.llm import chunks, queries, queries_sql  # noqa: E402

TABLES = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def as_bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [[float(f"{v:.9g}") if isinstance(v, float) and not math.isnan(v) else v for v in row] for row in rows]
    return Counter(tuple(row[i] for i in order) for row in plain)


@pytest.mark.parametrize("name", sorted(queries_sql.ORACLES))
def test_query_equals_its_oracle(spark, oracle, name):
    ours, theirs = queries.QUERIES[name](spark, str(TABLES)), oracle.sql(queries_sql.ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert as_bag(ours.collect(), ours.columns) == as_bag(theirs.fetchall(), theirs.columns)


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


TURNS = "conv_id long, turn long, role string, text string"


def test_every_call_takes_the_whole_text(spark):
    texts = {turn: f"turn {turn} " + "long " * 40 + "end" for turn in (1, 3, 5)}
    turns = spark.createDataFrame([(1, t, "assistant", text) for t, text in texts.items()], TURNS)
    calls = {r["position"]: (r["name"], json.loads(r["arguments"])) for r in queries.calls_of(turns).collect()}
    assert {name for name, _ in calls.values()} == set(queries.SCHEMAS)
    assert {t: given.get("query", given.get("text")) for t, (_, given) in calls.items()} == texts


@pytest.fixture
def turns_folder(spark, folder):
    def write(turns):
        spark.createDataFrame(turns, TURNS).write.parquet(f"{folder}/conversations.parquet")
        return queries.QUERIES["op9_tool_calls"](spark, folder).collect()

    return write


def test_turns_are_linked_by_their_roles(turns_folder):
    system = list(zip(range(7), ["system", "user", "assistant", "user", "assistant", "user", "user"]))
    plain = list(zip(range(4), ["user", "assistant", "user", "assistant"]))
    turns = [(1, t, role, f"s{t}") for t, role in system] + [(2, t, role, f"p{t}") for t, role in plain]
    rows = turns_folder([*turns, (3, 4, "assistant", "alone"), (None, 1, "assistant", "x"), (None, 2, "user", "y")])
    found = {(r["conv_id"], r["position"]): (r["level"], r["status"], r["problems"].count("no call")) for r in rows if r["conv_id"]}
    linked, open_end = "linked", "no result"
    assert found == {
        (1, 2): (0, linked, 0), (1, 4): (1, linked, 0), (2, 1): (0, linked, 0), (2, 3): (1, open_end, 0), (3, 4): (0, open_end, 0),
    }
    assert len(rows) == 6
    assert {json.loads(r["line"])["result"] for r in rows if r["status"] == linked} == {"s3", "s5", "p2"}


def test_every_result_of_a_call_has_a_row(turns_folder):
    rows = turns_folder([(1, 0, "assistant", "a"), *((1, 1, "user", text) for text in ("y", "x", "y", None, None))])
    lines = {status: sorted(str(json.loads(r["line"])["result"]) for r in rows if r["status"] == status) for status in ("linked", "repeated")}
    assert lines == {"linked": ["None"], "repeated": ["None", "x", "y", "y"]} and len(rows) == 5


def test_near_components_of_the_table(spark):
    rows = queries.QUERIES["op3_near_components"](spark, str(TABLES)).collect()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{TABLES}/documents.parquet'").fetchall()
    expected = components_by_hand([d for d, _ in docs], [t for _, t in docs], 85, 100)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == {d: e for (d, _), e in zip(docs, expected)}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_passages_of_the_table(spark):
    rows = queries.QUERIES["op8_repeated_passages"](spark, str(TABLES)).collect()
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{TABLES}/documents.parquet'").fetchall()
    assert sorted((r["doc_id"], r["start"], r["n_bytes"], r["n_dropped"]) for r in rows) == passages_by_hand(docs, chunks.cuts)
    assert all(r["kept"] == (r["n_dropped"] == 0) for r in rows)


def test_stages_of_the_pipeline(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    kept, frames = [docs], {}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = stage(spark, kept[-1], str(TABLES)).cache()
        kept.append(frames[name])
    assert all(frames[name].columns == docs.columns for name in names[:-1])
    ids = {name: [r["doc_id"] for r in frame.select("doc_id").collect()] for name, frame in frames.items()}
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{TABLES}/labels.parquet'").fetchall()
    clean, toxic = [d for d, t in labels if not t], [d for d, t in labels if t]
    assert sum(d in ids["toxicity"] for d in clean) >= 0.98 * len(clean)
    assert sum(d not in ids["toxicity"] for d in toxic) >= 0.9 * len(toxic)
    before = sorted(ids["toxicity"])
    groups = components_by_hand(before, [texts[d] for d in before], 80, 100)
    assert sorted(ids["near_duplicates"]) == sorted({low for _, low in groups})
    items = [shingles(t) for (t,) in duckdb.sql(f"SELECT text FROM '{TABLES}/benchmark.parquet'").fetchall()]
    free = [d for d in ids["near_duplicates"] if not any(5 * len(i & shingles(texts[d])) >= 4 * len(i) for i in items)]
    assert sorted(ids["benchmark_items"]) == sorted(free)
    assert set(ids["source_mix"]) <= set(free) and max(Counter(ids["source_mix"]).values()) <= 3
    assert Counter(ids["shards"]) == Counter(ids["source_mix"])
    assert {"shard", "position", "virtual_slot"} <= set(frames["shards"].columns)
    for frame in frames.values():
        frame.unpersist()


def test_stages_bear_awkward_documents(spark, tmp_path):
    rows = [(None, None, None), (1, "", "a"), (1, "", "a"), (2, "words " * 30_000, None), (3, "same text here", "b"), (3, "same text here", "b"), (None, "x y", "b")]
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, shard string, row int")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, str(TABLES))
            assert out.columns[: len(docs.columns)] == docs.columns, name
            assert out.count() >= (1 if frame is docs else 0)
