"""Typed readers for the text formats of the pipeline, and the matching writers."""
