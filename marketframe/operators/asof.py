"""As-of lookup: for each point the latest value at or before it.

Points and values become one series per key, cut into time buckets. The last
value of every bucket is a small aggregate that enters the buckets after it as
one leading row; inside a bucket a running last value does the rest. Each point
is one row throughout, whatever the look-back, and no key is gathered in one
task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Days of a bucket of dates.
BUCKET_DAYS = 32


def day_bucket(day: Column) -> Column:
    """Bucket of a date: at most ``BUCKET_DAYS`` days, so a key has a bounded number of distinct dates in it."""
    return F.floor(F.unix_date(day) / BUCKET_DAYS)


def as_of(
    points: DataFrame, values: DataFrame, key: str, day: str, columns: Sequence[str], lookback: int,
    value_key: str | None = None, value_day: str | None = None, at: str = "as_of",
) -> DataFrame:
    """``points`` with ``columns`` of the latest of ``values`` on ``day`` or up to ``lookback`` days before, and its date as ``at``.

    Values must be unique per key and date (aggregate doubled ones first).
    Points with a null key or date, or without a value in reach, get nulls.
    """
    names = [f"_v_{c}" for c in columns]
    held = values.select(F.col(value_key or key).alias("_k"), F.col(value_day or day).alias("_t"), *[F.col(c).alias(n) for c, n in zip(columns, names)])
    held = held.where("_k IS NOT NULL AND _t IS NOT NULL").withColumn("_b", day_bucket(F.col("_t")))
    ends = held.groupBy("_k", "_b").agg(F.max("_t").alias("_t"), *[F.max_by(n, "_t").alias(n) for n in names])
    # the end of a bucket leads into as many buckets as the look-back reaches
    reach = math.ceil(lookback / BUCKET_DAYS)
    heads = ends.withColumn("_b", F.explode(F.sequence(F.col("_b") + 1, F.col("_b") + reach))) if reach else ends.limit(0)
    rows = points.withColumns({"_k": F.col(key), "_b": day_bucket(F.col(day)), "_at": F.col(day), "_row": F.lit(2)})
    merged = rows.unionByName(held.withColumns({"_at": F.col("_t"), "_row": F.lit(1)}), allowMissingColumns=True)
    merged = merged.unionByName(heads.withColumns({"_at": F.col("_t"), "_row": F.lit(0)}), allowMissingColumns=True)
    # values of a day stand before its points
    inside = Window.partitionBy("_k", "_b").orderBy("_at", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.last(F.when(F.col("_t").isNotNull(), F.struct("_t", *names)), ignorenulls=True).over(inside)
    found = merged.withColumn("_h", latest).where("_row = 2")
    fresh = F.col("_k").isNotNull() & (F.col("_h._t") >= F.date_sub(day, lookback))
    return found.select(*points.columns, *[F.when(fresh, F.col(f"_h.{n}")).alias(c) for n, c in zip(("_t", *names), (at, *columns))])
