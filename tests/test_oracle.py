"""Registered queries against their SQL twins on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
# one query per area; the driver compares all of them
CHOSEN = [
    "p01_tag_columns", "p16_move_tokens", "f02_silver_quarantine", "a04_player_months", "a05_opening_performance",
    "c02_silver_games", "c07_evaluated_positions", "w05_material_balance", "j03_time_pressure", "q05_drift",
    "a20_player_style", "m03_medians", "m07_stratified_split", "m13_ranking_metrics", "m18_m25_outcome_baselines",
    "m27_knowledge_corpus", "o06_nearest_vectors", "t02_envelopes", "u02_sql_functions",
    "a03_parser_diagnostics", "a17_overview", "c03_gate_and_publish", "j06_orphan_keys", "m05_one_hot", "m24_persona_scores",
    "q08_diagnostics_cards", "t05_unique_events", "t06_status_counts_streamed", "u03_partition_scorer", "w02_previous_month",
]


@pytest.fixture(scope="module")
def duck(small):
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"create view {name} as select * from '{small}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows(spark, duck, small, name):
    frame = contract.queries()[name](spark, small)
    columns = sorted(frame.columns)
    other = duck.sql(contract.oracle_sql()[name])
    assert sorted(other.columns) == columns
    ours = sorted(tuple(map(plain, row)) for row in frame.select(*columns).collect())
    theirs = sorted(tuple(map(plain, row)) for row in other.select(*[f'"{c}"' for c in columns]).fetchall())
    assert ours and ours == theirs


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).count() > 0
