"""Ordered series without a hot key: positions, running totals and blocks.

A plain window per ticker sends every row of a ticker to one task. Here a
series is cut first into time buckets (whose counts and totals are small and
give every bucket its offset), then into blocks of a fixed number of rows. A
block also carries the few rows before it that a look-back needs. Every task
therefore sees a bounded piece, whatever share of the rows one ticker holds,
and the results equal those of the plain window.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 65536


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match; the right side's keys are dropped."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def with_running(
    df: DataFrame, keys: list[str], order: list[Column], bucket: Column, totals: dict[str, Column], product: bool = False
) -> DataFrame:
    """Add running totals (or products) over ``order`` within ``keys``, the current row included.

    ``bucket`` must not decrease along ``order`` and one (keys, bucket) group
    must fit a task: a year for daily rows, an hour or less for ticks.
    """
    combine, neutral = (F.product, F.lit(1.0)) if product else (F.sum, F.lit(0))
    valued = {f"_v_{n}": F.coalesce(expr, neutral) for n, expr in totals.items()}
    rows = df.withColumns({"_bucket": bucket, **valued, "_row": F.lit(1)})
    sums = rows.groupBy(*keys, "_bucket").agg(*[combine(F.col(v)).alias(v) for v in valued])
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # what went before a bucket enters it as one leading row: no join, one shuffle of the rows
    heads = sums.select(
        *keys, "_bucket", *[F.coalesce(combine(F.col(v)).over(before), neutral).alias(v) for v in valued],
        F.lit(0).alias("_row"),
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_row", *order).rowsBetween(Window.unboundedPreceding, 0)
    merged = rows.unionByName(heads, allowMissingColumns=True)
    run = merged.withColumns({n: combine(F.col(f"_v_{n}")).over(inside) for n in totals})
    return run.where(F.col("_row") == 1).drop("_bucket", "_row", *valued)


def with_positions(
    df: DataFrame, keys: list[str], order: list[Column], bucket: Column, pos: str = "pos"
) -> DataFrame:
    """Add the zero-based position of each row within its keys, as bigint."""
    out = with_running(df, keys, order, bucket, {pos: F.lit(1).cast("bigint")})
    return out.withColumn(pos, F.col(pos) - 1)


def block_length(before: int, after: int = 0, block_rows: int | None = None) -> int:
    """Rows of a block: the length asked for, or the usual one, but no shorter than its look-back or look-ahead."""
    return max(block_rows or max(BLOCK_ROWS, 4 * (before + after)), before, after, 1)


def in_blocks(
    df: DataFrame, keys: list[str], before: int, after: int = 0, pos: str = "pos", block_rows: int | None = None
) -> DataFrame:
    """Cut positioned rows into blocks, copying look-back (and look-ahead) rows.

    Adds ``_blk`` and ``_own``; rows with ``_own`` false are copies that only
    feed a window and must be dropped after it (``own_rows``).
    """
    size = block_length(before, after, block_rows)
    blk = F.expr(f"{pos} div {size}")
    offset = F.col(pos) % size
    homes = [blk]
    if before:
        homes.append(F.when(offset >= size - before, blk + 1))
    if after:
        homes.append(F.when((offset < after) & (blk > 0), blk - 1))
    out = df.select("*", blk.alias("_home"), F.explode(F.array_compact(F.array(*homes))).alias("_blk"))
    return out.withColumn("_own", F.col("_blk") == F.col("_home")).drop("_home")


def own_rows(df: DataFrame) -> DataFrame:
    return df.where("_own").drop("_blk", "_own")


def block_window(keys: list[str], pos: str = "pos"):
    return Window.partitionBy(*keys, "_blk").orderBy(pos)


# Weights within a cell stay between exp(-RANGE) and exp(RANGE); what has decayed by exp(-VANISHED) is zero in a double.
RANGE, VANISHED = 280 * math.log(10), 345 * math.log(10)


def smoothed(
    df: DataFrame, keys: list[str], terms: dict[str, tuple[Column, float]], block_rows: int, pos: str = "pos"
) -> DataFrame:
    """Add ``y[i] = decay*y[i-1] + b[i]`` over whole series for each name -> (b, decay) in ``terms``; a null b counts as 0.

    ``df`` is cut into blocks; rows copied into a block get null. A block is cut
    into cells short enough that y[i] = decay**i * sum(b[j] * decay**-j) stays
    in the range of a double. The value at the end of each cell is a plain
    aggregate; folded along the cells of a series it gives the value every cell
    starts from, which enters the cell as one leading row. Nothing is cut off:
    the fold looks back until a value has decayed below the smallest double.
    """
    df = df.withColumns({n: b for n, (b, decay) in terms.items() if decay <= 0})
    decays = {n: decay for n, (_, decay) in terms.items() if decay > 0}
    if not decays:
        return df
    slowest = min(-math.log(d) for d in decays.values())
    cell = min(block_rows, *[int(2 * RANGE / -math.log(d)) for d in decays.values()])
    # the last cell of a block may be shorter, but never two in a row
    reach = math.ceil(VANISHED / slowest / cell) * 2

    values = {n: F.when(F.col("_own"), F.coalesce(terms[n][0], F.lit(0.0))).otherwise(0.0) for n in decays}
    offset = F.col(pos) % block_rows
    rows = df.withColumns({f"_b_{n}": v for n, v in values.items()}).withColumns({
        "_cell": F.floor(offset / cell), "_power": (offset % cell - cell // 2).cast("double"), "_row": F.lit(1)})
    length = F.least(F.lit(cell), F.lit(block_rows) - F.col("_cell") * cell)
    left = length - 1 - offset % cell
    ends = rows.where("_own").groupBy(*keys, "_blk", "_cell").agg(
        *[F.sum(F.col(f"_b_{n}") * F.pow(F.lit(d), left)).alias(f"_b_{n}") for n, d in decays.items()])
    earlier = Window.partitionBy(*keys).orderBy("_blk", "_cell").rowsBetween(-reach, -1)

    def start(n: str, decay: float) -> Column:
        cells = F.collect_list(F.struct(F.col(f"_b_{n}").alias("end"), length.alias("length"))).over(earlier)
        return F.aggregate(cells, F.lit(0.0), lambda y, c: y * F.pow(F.lit(decay), c["length"]) + c["end"]).alias(f"_b_{n}")

    heads = ends.select(*keys, "_blk", "_cell", F.lit(-1.0 - cell // 2).alias("_power"), F.lit(0).alias("_row"),
                        *[start(n, d) for n, d in decays.items()])
    inside = Window.partitionBy(*keys, "_blk", "_cell").orderBy("_row", pos).rowsBetween(Window.unboundedPreceding, 0)

    def value(n: str, decay: float) -> Column:
        run = F.sum(F.col(f"_b_{n}") * F.pow(F.lit(decay), -F.col("_power"))).over(inside)
        return F.when(F.col("_own"), run * F.pow(F.lit(decay), F.col("_power")))

    merged = rows.unionByName(heads, allowMissingColumns=True).withColumns({n: value(n, d) for n, d in decays.items()})
    return merged.where(F.col("_row") == 1).drop("_cell", "_power", "_row", *[f"_b_{n}" for n in decays])


def spread_join(rows: DataFrame, stats: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """Bring one row of ``stats`` per key back to positioned rows, without a hot key.

    ``stats`` names the first and last position of its key (``_lo``, ``_hi``);
    it is repeated once per block of rows, so each join key stays bounded.
    """
    size = BLOCK_ROWS
    rows = rows.withColumn("_cell", F.expr(f"{pos} div {size}"))
    cells = F.sequence(F.expr(f"_lo div {size}"), F.expr(f"_hi div {size}"))
    stats = stats.withColumn("_cell", F.explode(cells)).drop("_lo", "_hi")
    return null_safe(rows, stats, [*keys, "_cell"], "left").drop("_cell")
