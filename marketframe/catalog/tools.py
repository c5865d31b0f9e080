"""Small helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_up(c: Column, digits: int) -> Column:
    """Rounding as plain arithmetic: the check SQL does the same operations."""
    scale = float(10**digits)
    return F.floor(c * scale + 0.5) / scale


def rounded(df: DataFrame, *cols: str, digits: int = 6) -> DataFrame:
    """Round doubles whose last bits depend on the order of summation."""
    return df.withColumns({c: half_up(F.col(f"`{c}`"), digits) for c in cols})
