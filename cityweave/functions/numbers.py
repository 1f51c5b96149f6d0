"""What counts as a number."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_number(c: Column | str) -> Column:
    """Neither NULL nor NaN. NaN alone does not do: it is false for NULL."""
    return F.col(c).isNotNull() & ~F.isnan(c) if isinstance(c, str) else c.isNotNull() & ~F.isnan(c)
