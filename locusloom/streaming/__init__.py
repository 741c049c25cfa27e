"""Structured Streaming forms of the run-log and cohort operators."""
