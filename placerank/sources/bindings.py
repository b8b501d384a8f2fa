"""Bindings from the shared test tables to the canonical schemas.

Each binding is a list of SQL select expressions written once and used by both engines:
Spark evaluates them with ``selectExpr`` over the parquet scan (so only the referenced
columns are read), and the DuckDB oracle embeds the same text in a CTE. The only dialect
difference is the year-month formatting of a timestamp.

The dirty cells of ``posts_raw`` and ``listings_raw`` are made by the binding because the
source tables hold no NULL or empty values; every source row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

POSTS_EXPRS = [
    "doc_id AS post_id",
    "source AS item",
    "lang AS grp",
    "concat(doc_id % 12, ' months ago') AS period",
    "text",
]

POSTS_RAW_EXPRS = [
    "doc_id AS post_id",
    "CASE WHEN doc_id % 29 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN '' ELSE source END AS item",
    "CASE WHEN doc_id % 37 = 0 THEN NULL ELSE lang END AS grp",
    "concat(doc_id % 12, ' months ago') AS period",
    "CASE WHEN doc_id % 41 = 0 THEN '' ELSE text END AS text",
]

_STARS_DIGITS = "concat('', 30 + (p_partkey * 7) % 21)"

LISTINGS_RAW_EXPRS = [
    "p_partkey AS listing_id",
    "concat(p_name, ' #', p_partkey) AS name",
    "p_type AS room_type",
    "CASE WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 13 = 0 THEN 'n/a' "
    "ELSE concat(' ', p_size % 16, ' guests ') END AS guests_raw",
    "CASE WHEN p_partkey % 19 = 0 THEN '' WHEN p_partkey % 23 = 0 THEN 'New' "
    f"ELSE concat(substr({_STARS_DIGITS}, 1, 1), '.', substr({_STARS_DIGITS}, 2, 1)) END AS stars_raw",
]


def sales_exprs(dialect: str) -> list[str]:
    """Line items as posts: the item is the part name, the group its brand."""
    if dialect == "spark":
        period = "date_format(l_shipdate, 'yyyy-MM') AS period"
    else:
        period = "strftime(l_shipdate, '%Y-%m') AS period"
    return [
        "l_orderkey * 10 + l_linenumber AS post_id",
        "p_name AS item",
        "p_brand AS grp",
        period,
        "p_type AS text",
    ]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").selectExpr(*POSTS_EXPRS)


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").selectExpr(*POSTS_RAW_EXPRS)


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` joined to ``part``; the join strategy is left to Catalyst/AQE (a
    broadcast of ``part`` when its measured size allows, a sort-merge join otherwise, with
    AQE splitting a skewed part key)."""
    lineitem = _table(spark, sf_dir, "lineitem")
    part = _table(spark, sf_dir, "part")
    joined = lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"], "inner")
    return joined.selectExpr(*sales_exprs("spark"))


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(*LISTINGS_RAW_EXPRS)


def duckdb_ctes() -> str:
    """The same bindings as DuckDB common table expressions (for the oracle SQL)."""
    return (
        "WITH posts AS (SELECT " + ", ".join(POSTS_EXPRS) + " FROM documents), "
        "posts_raw AS (SELECT " + ", ".join(POSTS_RAW_EXPRS) + " FROM documents), "
        "sales AS (SELECT " + ", ".join(sales_exprs("duckdb"))
        + " FROM lineitem JOIN part ON l_partkey = p_partkey), "
        "listings_raw AS (SELECT " + ", ".join(LISTINGS_RAW_EXPRS) + " FROM part)"
    )
