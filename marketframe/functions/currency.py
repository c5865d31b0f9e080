"""Currency pairs and minor-unit factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_minor(ccy: Column) -> Column:
    """A minor unit ends in a lower-case letter (pence, cents)."""
    return ccy.rlike("[a-z]$")


def same_currency(a: Column, b: Column) -> Column:
    return F.upper(a) == F.upper(b)


def fx_pair(source: Column, target: Column) -> Column:
    return F.concat(F.upper(target), F.upper(source), F.lit(" Curncy"))


def fx_factor(source: Column) -> Column:
    return F.when(is_minor(source), F.lit(100.0)).otherwise(F.lit(1.0))


def ccy_pair(local: Column, base: Column) -> Column:
    """struct<ticker,factor,power> between two currencies, the same currency included."""
    same = same_currency(local, base)
    up = F.when(is_minor(local), F.lit(100.0)).otherwise(F.lit(1.0))
    down = F.when(is_minor(base), F.lit(100.0)).otherwise(F.lit(1.0))
    return F.struct(
        F.when(same, F.lit("")).otherwise(fx_pair(local, base)).alias("ticker"),
        F.when(same, up / down).otherwise(up).alias("factor"),
        F.lit(1.0).alias("power"),
    )
