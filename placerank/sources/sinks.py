"""Sinks. Operators return lazy DataFrames; writing is the caller's choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Write a result (or a cleaned input, e.g. typed listings so that later ``stars >= x``
    predicates reach the parquet row groups) to a shared path."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write string columns as CSV that reads back as it was: a header, every field quoted, quotes
    doubled, blanks kept. A NULL is an unquoted empty field."""
    df.write.mode(mode).options(
        header="true", quoteAll="true", quote='"', escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
    ).csv(path)
