"""Imports every operator, so that all queries of this subpackage are registered."""

from . import conversation_repair, decontaminate, language_model, licenses, near_duplicates, quality, resampling, sentencepiece_dropout, sharding, suffix_dedup, token_store, toxicity, warc  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
