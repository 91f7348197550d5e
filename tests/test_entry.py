"""The driver contract, and a few registered queries against their SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_names_need_no_session():
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True)
    n, known = out.stdout.split()
    assert int(n) > 120 and known == "True"


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: round(float(v), 6) if type(v).__name__ in ("float", "Decimal") else str(v)
    return sorted(repr([None if r[i] is None else cell(r[i]) for i in order]) for r in rows)


@pytest.mark.skipif(not FOLDER.exists(), reason="no tables here")
@pytest.mark.parametrize("name", ["macro_monthly", "latest_as_of_running_max", "scd2_periods", "classified_readings", "categorized_products", "file_profile", "parsed_prices", "published_changes", "upsert_incremental", "upserted_rows", "staged_rows", "graded_defects", "lines_streamed_once", "metric_price_change_count", "metric_vocabularies", "metric_refusals", "look_ahead_planted", "cells_not_projected", "release_states", "gate_results_of_replay", "audited_deliveries", "rows_upserted_in_buckets", "products_ruled_by_table", "metric_policy_percent", "graded_file_defects"])
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    df = entry.queries()[name](spark, str(FOLDER))
    assert sorted(df.columns) == sorted(columns)
    assert plain(df.collect(), df.columns) == plain(want.fetchall(), columns)


@pytest.mark.skipif(not FOLDER.exists(), reason="no tables here")
def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
