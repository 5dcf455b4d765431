"""Composed pipelines, the fixtures derived from the given tables, and the registered queries."""
