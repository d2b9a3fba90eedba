"""Structured Streaming variants of the stateless (row-wise) models."""

from bazaar.streaming.incremental import ENRICH, enriched_stream, start_enrichment

__all__ = ["ENRICH", "enriched_stream", "start_enrichment"]
