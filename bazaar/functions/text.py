"""String normalisation used by the intermediate models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(c: str) -> Column:
    """lower(trim(c)); trim strips spaces only, tabs and newlines stay."""
    return F.lower(F.trim(F.col(c)))
