"""Model graph and query registry."""

from bazaar.plans.graph import MODELS, Marketplace
from bazaar.plans.registry import queries

__all__ = ["MODELS", "Marketplace", "queries"]
