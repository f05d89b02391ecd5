"""Every registered query against its SQL, over whole tables."""

import math
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
duckdb = pytest.importorskip("duckdb")
import __spark_entry__ as contract  # noqa: E402
from ridelake.plans import catalog, catalog_sql  # noqa: E402

TABLES = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in TABLES.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def as_bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [[None if isinstance(v, float) and math.isnan(v) else v for v in row] for row in rows]
    return Counter(tuple(row[i] for i in order) for row in plain)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog_sql.ORACLES)


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 374


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_oracle(spark, oracle, name):
    ours = QUERIES[name](spark, str(TABLES))
    theirs = oracle.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert as_bag(ours.collect(), ours.columns) == as_bag(theirs.fetchall(), theirs.columns)


def differs(spark, oracle, name):
    ours, theirs = QUERIES[name](spark, str(TABLES)), oracle.sql(ORACLES[name])
    return as_bag(ours.collect(), ours.columns) != as_bag(theirs.fetchall(), theirs.columns)


def test_the_first_deliveries_oracle_sees_a_missing_state(spark, oracle, monkeypatch):
    monkeypatch.setattr(catalog, "first_deliveries", lambda rows, delay: rows)
    assert differs(spark, oracle, "stream_first_deliveries")


def test_the_interval_oracles_see_a_wider_interval(spark, oracle, monkeypatch):
    from functools import partial

    monkeypatch.setattr(catalog, "interval_left_join", partial(catalog.interval_left_join, minutes=60))
    assert differs(spark, oracle, "stream_interval_join")
    monkeypatch.setattr(catalog, "curate", partial(catalog.curate, minutes=60))
    assert differs(spark, oracle, "stream_reattach")


def test_the_reattach_oracle_sees_a_missing_interval(spark, oracle, monkeypatch):
    curate = catalog.curate
    monkeypatch.setattr(catalog, "curate", lambda *args, **named: curate(*args, **{**named, "by_interval": False}))
    assert differs(spark, oracle, "stream_reattach")


def test_the_window_oracle_sees_a_missing_tail(spark, oracle, monkeypatch):
    monkeypatch.setattr(catalog, "closing_ride", lambda rides: catalog.rides(spark, str(TABLES)).limit(0))
    assert differs(spark, oracle, "stream_window_fare")


def test_fares_are_summed_before_the_fan_out(spark):
    text = QUERIES["fare_by_day_region"](spark, str(TABLES))._jdf.queryExecution().optimizedPlan().toString()
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
    assert any("sum(" in line for line in lines[join:]) and not any("sum(" in line for line in lines[:join])


def test_a_random_split_reads_its_table_once(spark):
    text = QUERIES["random_split"](spark, str(TABLES))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") == 1 and "Sort" not in text
