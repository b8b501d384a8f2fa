"""The driver contract, and every registered query against its DuckDB oracle at sf0.001."""

import glob
import math
import os
import subprocess
import sys

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from placerank.plans.catalog import QUERIES
from placerank.plans.oracle import oracle_queries

from .conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
ROWS_ONLY = {"cluster_items", "tfidf_vectors", "listing_features"}


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["item", "grp", "review_count", "keyword_freq", "relevance_score", "final_score"]
    assert df.count() >= 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(QUERIES) - set(oracle_queries()) == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())


def test_entry_imports_from_the_pyspark_archive_without_a_jvm():
    """The module must import, and give its queries and SQL, where PySpark is loaded from
    pyspark.zip (no jars folder beside it) and no session exists."""
    import pyspark

    lib = os.path.join(os.path.dirname(pyspark.__file__), "python", "lib")
    archives = sorted(glob.glob(os.path.join(lib, "*.zip")))
    if not archives:
        pytest.skip("this PySpark has no pyspark.zip")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import __spark_entry__ as e, pyspark; assert '.zip' in pyspark.__file__, pyspark.__file__; "
        "from pyspark import SparkContext; assert SparkContext._active_spark_context is None; "
        "print(len(e.queries()), len(e.oracle_sql()))"
    )
    env = {**os.environ, "PYTHONPATH": os.pathsep.join([*reversed(archives), here])}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd="/", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    n_queries, n_sql = map(int, done.stdout.split()[-2:])
    assert n_queries >= len(QUERIES) and n_sql >= len(oracle_queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(row):
    return tuple("NaN" if isinstance(x, float) and math.isnan(x) else x for x in row)


def _key(row):
    return tuple((x is None, str(type(x)), x) for x in row)


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF_SMALL)
    rel = con.sql(oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in sdf.columns]
    theirs = sorted((_norm(tuple(r[i] for i in order)) for r in rel.fetchall()), key=_key)
    ours = sorted((_norm(tuple(r)) for r in sdf.collect()), key=_key)
    assert ours == theirs
