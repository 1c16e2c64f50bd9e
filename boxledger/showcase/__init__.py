"""The operators applied to the driver's tables, each with an equivalent SQL text for the correctness check."""

from . import (queries_aggregate, queries_facts, queries_measures, queries_model, queries_silver,  # noqa: F401
               queries_sources, queries_views)
from .registry import QUERIES

__all__ = ["QUERIES"]
