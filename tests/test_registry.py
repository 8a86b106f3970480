"""The driver contract: every key runs, SQL keys agree with DuckDB on the sf0.001 tables."""

import hashlib
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMALL
from marquee.plans import oracle, registry

DRIVER_TABLES = ("part", "orders", "lineitem", "events")
ROWS_ONLY = {"als_predictions", "als_metrics", "recommendations", "recommend_all_users", "cold_start_predictions"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if hasattr(v, "as_tuple"):
        return f"{float(v):.9g}"
    return repr(v)


def _digest(rs, order):
    return hashlib.sha1("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rs)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMALL, t + '.parquet')}')")
    return con


def test_every_key_but_the_model_has_sql():
    assert set(registry.queries()) - set(oracle.oracle_sql()) == ROWS_ONLY
    assert set(E.oracle_sql()) <= set(E.queries())


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    """Also where a library that they need cannot be imported."""
    (tmp_path / "xxhash.py").write_text("raise ImportError('not here')")
    code = f"import sys; sys.path[:0] = [{str(tmp_path)!r}, {os.path.dirname(os.path.abspath(E.__file__))!r}]; import __spark_entry__ as E; print('KEYS', len(E.queries()), len(E.oracle_sql()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert f"KEYS {len(registry.queries())} {len(oracle.oracle_sql())}" in done.stdout, done.stderr


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["genre", "first_user", "second_user"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(oracle.oracle_sql()))
def test_matches_duckdb(spark, duck, key):
    df = E.queries()[key](spark, SMALL)
    s_rows, s_cols = [tuple(r) for r in df.collect()], df.columns
    rel = duck.sql(E.oracle_sql()[key])
    o_rows, o_cols = rel.fetchall(), rel.columns
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    o_idx = [o_cols.index(c) for c in s_cols]
    o_rows = [tuple(r[i] for i in o_idx) for r in o_rows]
    assert _digest(s_rows, order) == _digest(o_rows, order)


def test_schemas_do_not_depend_on_scale(spark):
    writers = {"scan_movies", "scan_ratings", "scan_tags", "sink_csv_roundtrip", "save_tables", "export_summaries", "top_inner_products", "recommend_all_ranks"}
    for key, fn in E.queries().items():
        if key in writers or key in ROWS_ONLY:
            continue
        assert fn(spark, SMALL).schema == fn(spark, "/root/testdata/sf0.01").schema, key
