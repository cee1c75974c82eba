"""Registered queries: every one has an oracle or a reason, and a sample of them is compared here.

``python check.py`` compares all of them.
"""

import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
WITHOUT_ORACLE = {"wf_train_eval", "ml_feature_importance", "score_latest"}
SAMPLE = [
    "src_wide_to_long", "scan_prices_range", "cast_numeric_coerce", "fn_ticker_strings", "target_date_bday",
    "join_fact_asset", "null_audit", "feat_lags", "feat_macd", "feat_rolling_stats", "gold_features", "silver_prices",
    "clean_interpolate", "dq_checks", "upsert_replace", "incr_gold", "drift_psi", "perf_by_period",
    "mon_rolling_accuracy", "bi_prediction_history", "stream_bronze_ingest", "stream_bars_hourly", "stream_ema",
]


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for t in check.TABLES:
        made.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return made


def test_every_query_has_an_oracle():
    own = set(entry.queries()) - set(entry.LLM_QUERIES)
    assert own - set(entry.oracle_sql()) == WITHOUT_ORACLE
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 5


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, connection, name):
    line = check.compare(spark, SF, name, connection)
    assert line.startswith("ok"), line
