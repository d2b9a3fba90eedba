"""DuckDB SQL oracle: an independent SQL statement of every registered query.

``sql(name)`` returns one self-contained statement over the pre-registered
TPC-H views (customer, supplier, part, orders, ...).
"""

from oracle.checks import CHECK_SQL, RECONCILE_CTES, SPOILED_SQL
from oracle.distributions import DISTRIBUTION_SQL
from oracle.models import MODEL_CTES, MODEL_NAMES
from oracle.sources import SOURCE_CTES, SPOILED_CTES

def with_models(select: str, sources: str = SOURCE_CTES) -> str:
    """Prefix a SELECT with every source and model CTE."""
    return f"WITH {sources.strip()},\n{MODEL_CTES.strip()},\n{RECONCILE_CTES.strip()}\n{select}"


def oracle_queries() -> dict[str, str]:
    out = {name: with_models(f"SELECT * FROM {name}") for name in MODEL_NAMES}
    out.update({name: with_models(select) for name, select in CHECK_SQL.items()})
    out.update({name: with_models(select, SPOILED_CTES) for name, select in SPOILED_SQL.items()})
    out.update({name: with_models(select) for name, select in DISTRIBUTION_SQL.items()})
    return out
