"""Fixture views over the driver tables, registered queries and their SQL twins."""

from __future__ import annotations


def all_queries() -> dict:
    """Table queries and the resampling and streaming ones, by name."""
    from locusloom.plans.queries import QUERIES
    from locusloom.plans import file_queries, model_queries, payload_queries, stream_queries  # noqa: F401  (they register themselves)

    return QUERIES
