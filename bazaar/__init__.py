"""bazaar: marketplace analytics (facts, dimensions, scorecards, data quality)
expressed as PySpark DataFrame plans.

Layout
------
sources/    raw table schemas, readers/writers, test-fixture derivation
functions/  column helpers that pin numeric/temporal semantics
operators/  the models: intermediate, marts, scorecards, quality, reconcile, kpis
plans/      the model graph (lazy, shared DataFrames) and the query registry
streaming/  incremental (file-stream) variants of the stateless models
"""

from bazaar.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
