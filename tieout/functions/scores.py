"""The data-quality score."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dq_score(passed: Column, received: Column) -> Column:
    """Percentage passed, four decimals; 0 when nothing was received."""
    share = F.lit(100) * passed.cast("double") / received
    return F.when(received == 0, F.lit(0.0)).otherwise(F.round(share, 4))
