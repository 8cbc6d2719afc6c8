"""All registered queries, by key."""

from changeflow.queries import decoding, folding, functions, measures, workflows
from changeflow.queries.registry import QUERIES

__all__ = ["QUERIES", "decoding", "folding", "functions", "measures", "workflows"]
