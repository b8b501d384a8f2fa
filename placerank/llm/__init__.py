"""Operators for large training-data pipelines. Nothing else in the library imports this
subpackage; it uses the library's general helpers only."""
