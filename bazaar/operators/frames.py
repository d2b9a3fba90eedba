"""DataFrame combinators shared by the multi-check jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name, combined as a balanced tree.

    A left-deep chain of n unions is re-analysed at every step (quadratic
    driver time for many branches); a balanced tree keeps it n log n. The
    optimizer flattens nested unions into one Union node either way.
    """
    if not frames:
        raise ValueError("union_all needs at least one frame")
    level = list(frames)
    while len(level) > 1:
        level = [
            level[i].unionByName(level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)
        ]
    return level[0]
