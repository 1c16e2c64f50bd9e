"""Training-data operators: thirteen components, each with a query in its own module."""

from . import chat, decontamination, fill_in_middle, filter_audit, license_scan, line_dedup, lm_scoring, near_dup, packing, quality, quality_rules, substring_dedup, toxicity
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "chat", "decontamination", "fill_in_middle", "filter_audit", "license_scan", "line_dedup", "lm_scoring", "near_dup", "packing", "quality", "quality_rules", "substring_dedup", "toxicity"]
