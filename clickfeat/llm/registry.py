"""Importing this module registers the queries of all operators here."""

from clickfeat.llm import (  # noqa: F401
    exact_dedup,
    html_text,
    language_id,
    mixing,
    near_dedup,
    packing,
    personal_data,
    quality_classifier,
    quality_rules,
    source_divergence,
    token_counts,
    warc,
    whitening,
)
from clickfeat.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
