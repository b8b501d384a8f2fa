"""Readers that deliver the canonical ``posts`` and ``listings_raw`` tables.

No schema inference: a CSV is read as all-string columns (one pass, no inference scan),
header names are normalised once with ``toDF``, columns are renamed to canonical names and
cast with ``try_cast``. Parquet/ORC/JSON inputs already carrying canonical names are
projected to the canonical schema, so a downstream operator only ever sees those columns
and the scan reads only what the plan uses.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LISTINGS_RAW, POSTS
from .split_csv import read_csv_in_splits

# The column names of the reference's review and listing files, mapped to
# the canonical names used here.
REVIEW_COLUMNS = {"Destination": "item", "District": "grp", "Timespan": "period", "Review": "text"}
LISTING_COLUMNS = {
    "name": "name",
    "roomType": "room_type",
    "numberOfGuests": "guests_raw",
    "stars": "stars_raw",
}

# multiLine: a quoted review may span lines. The caller has to say how to read: ``True`` takes each
# CSV file as one split; ``False`` reads large files by many tasks, but they must hold no embedded
# newlines; ``"split"`` reads files with embedded newlines by many tasks (``split_csv``).
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',  # "" inside a quoted field is one quote
    "mode": "PERMISSIVE",
    "encoding": "UTF-8",
}


def normalise_header(name: str) -> str:
    """Strip blanks, a byte-order mark and quote characters from a header name."""
    return name.strip().replace("\ufeff", "").replace('"', "").strip()


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[normalise_header(c) for c in df.columns])


def _load(spark: SparkSession, path: str, fmt: str, options: Mapping[str, str] | None,
          multiline: bool | str | None) -> DataFrame:
    reader = spark.read.format(fmt)
    opts = dict(CSV_OPTIONS) if fmt == "csv" else {}
    if fmt == "csv":
        if multiline not in (True, False, "split"):
            raise ValueError("say multiline=True (quoted line breaks, one task a file), 'split' (the same by many tasks) or False (none)")
        if multiline == "split":
            return normalise_headers(read_csv_in_splits(spark, path, {**opts, **(options or {})}))
        opts["multiLine"] = str(multiline).lower()
    opts.update(options or {})
    if opts:
        reader = reader.options(**opts)
    df = reader.load(path)
    return normalise_headers(df) if fmt == "csv" else df


def _conform(df: DataFrame, schema: T.StructType, columns: Mapping[str, str] | None,
             id_col: str) -> DataFrame:
    mapping = dict(columns or {})
    renamed = df.select([F.col(f"`{c}`").alias(mapping.get(c, c)) for c in df.columns])
    cols: list[Column] = []
    missing: list[str] = []
    for field in schema.fields:
        if field.name in renamed.columns:
            src = F.col(field.name)
            if isinstance(field.dataType, T.StringType):
                cols.append(src.cast(T.StringType()).alias(field.name))
            else:
                cols.append(src.try_cast(field.dataType).alias(field.name))
        elif field.name == id_col:
            # Used only to order ties: a hash of the row's content, the same however the
            # files are split (equal rows are alike).
            content = [F.col(f"`{c}`").cast("string") for c in sorted(renamed.columns)]
            cols.append(F.xxhash64(*content).alias(field.name))
        else:
            missing.append(field.name)
    if missing:
        raise ValueError(f"no column for {missing} among {df.columns}; name them with columns={{...}}")
    return renamed.select(cols)


def read_posts(spark: SparkSession, path: str, fmt: str = "parquet",
               columns: Mapping[str, str] | None = None,
               options: Mapping[str, str] | None = None, multiline: bool | str | None = None) -> DataFrame:
    """Read a posts table. For the reference's CSV layout pass ``columns=REVIEW_COLUMNS``;
    for CSV say ``multiline=False`` (large files are split; no embedded newlines),
    ``multiline=True`` or ``multiline="split"``. A canonical column that the file lacks is an error; a missing
    ``post_id`` is made from the row's content."""
    return _conform(_load(spark, path, fmt, options, multiline), POSTS, columns, "post_id")


def read_listings(spark: SparkSession, path: str, fmt: str = "parquet",
                  columns: Mapping[str, str] | None = None,
                  options: Mapping[str, str] | None = None, multiline: bool | str | None = None) -> DataFrame:
    """Read an uncleaned listings table (``listings_raw``); clean it with ``clean_listings``.
    For the reference's CSV layout pass ``columns=LISTING_COLUMNS``; ``multiline``, missing
    columns and a missing ``listing_id`` are as in ``read_posts``."""
    return _conform(_load(spark, path, fmt, options, multiline), LISTINGS_RAW, columns, "listing_id")
