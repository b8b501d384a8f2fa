from . import bindings
from .layout import catalogue_bounds, write_bucketed, write_catalogue
from .readers import (
    LISTING_COLUMNS,
    REVIEW_COLUMNS,
    normalise_header,
    normalise_headers,
    read_listings,
    read_posts,
)
from .sinks import write_csv, write_table
from .split_csv import csv_records, read_csv_in_splits

__all__ = [
    "LISTING_COLUMNS",
    "REVIEW_COLUMNS",
    "bindings",
    "catalogue_bounds",
    "csv_records",
    "normalise_header",
    "normalise_headers",
    "read_csv_in_splits",
    "read_listings",
    "read_posts",
    "write_bucketed",
    "write_catalogue",
    "write_csv",
    "write_table",
]
