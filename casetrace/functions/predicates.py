"""Shared row predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the status the original reports treat as a death ('Muerte' in
# the original feed; a parameter here).
DEFAULT_DECEASED_STATUS = "Muerte"


def is_deceased(status: str, status_col: str = "status",
                died_col: str = "died_on") -> Column:
    """Dead by status *or* by a recorded date of death."""
    return (F.col(status_col) == F.lit(status)) | F.col(died_col).isNotNull()
