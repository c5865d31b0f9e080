"""Embedding whitening over distinct vectors with weights.

Vectors become integers x, equal ones are one row with their number as weight,
and everything that costs arithmetic is done once for each distinct vector:
exact sums of x, the covariance as a weighted product of centred blocks (a
matrix a task, added up entry by entry), the projection on the eigenvectors and
its own covariance. The results are joined back to the rows by a name of x.

The fit list is every vector that takes part (weight = count); with
``counted=False`` every distinct vector counts once, so that copies do not tilt
the axes.

A vector that very many rows share would be one key of that join. Those with
more than one row in ``HEAVY`` are therefore joined by a broadcast of their own:
there are fewer than ``HEAVY`` of them, whatever the table. The driver holds
the sums and products of ``width`` and ``width``² entries.

Names are two 64-bit hashes of x; vectors whose names are equal are taken for
equal (2⁻¹²⁸ a pair).

Defined results: rows whose vector is null or holds a null or non-finite entry
are left out; null ids are kept; repeated rows each give their rows; shorter
vectors count as padded with entries of zero; components whose eigenvalue
vanishes (fewer distinct vectors than dimensions, constant entries) have null
``whitened`` and are left out of ``identity_error``, which is null where none
is left, as is ``explained`` where all vectors are equal; ``deviation`` is null
where it does not fit a long; an empty table and vectors without entries give an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import pick, stored
from marketframe.llm.topk import matrix

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
HEAVY = 256
# An eigenvalue below this share of the largest is rounding.
VANISHED = 1e-12
BLOCK = 4096
RESULT = "id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole(c: Column, scale: int, shift: int) -> Column:
    """floor(scale * c) + shift; entries beyond a long become the longest one."""
    return F.coalesce(F.try_add(F.floor(c.cast("double") * scale).cast("long"), F.lit(shift).cast("long")), F.lit((1 << 63) - 1))


def prepared(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """Rows that take part: (id, x, h1, h2)."""
    rows = pick(vectors, id=id_col, v=vector_col).where(F.col("v").isNotNull())
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = rows.where(finite).select("id", F.transform("v", lambda c: whole(c, scale, shift)).alias("x"))
    return rows.withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit("x"), "x")})


def padded(width: int, shift: int) -> Column:
    """x with as many entries as the longest vector."""
    return F.concat("x", F.array_repeat(F.lit(shift).cast("long"), F.lit(width) - F.size("x")))


def exact_sums(distinct: DataFrame, width: int) -> list[int]:
    """Sum of each entry over the fit list, ``width`` exact integers."""
    each = distinct.select("weight", F.posexplode("x").alias("i", "c"))
    got = each.groupBy("i").agg(F.sum(F.col("c").cast("decimal(19,0)") * F.col("weight").cast("decimal(19,0)")).alias("s")).collect()
    sums = dict.fromkeys(range(width), 0) | {r["i"]: int(r["s"]) for r in got}
    return [sums[i] for i in range(width)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x less the mean: whole parts are subtracted as integers, so that nothing is rounded away."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole).astype(float) - rest


def products(rows: DataFrame, width: int, of: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Weighted products of columns, summed over all rows: one matrix a task, added up by Spark; the driver gets width² sums.

    ``of`` makes a matrix of a batch whose first column is the weight.
    """
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                m = of(part)
                total += m.T @ (m * part.column(0).to_numpy()[:, None])
        i, j = np.divmod(np.arange(width * width), width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "x"])

    sums = rows.mapInArrow(block, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    full = np.zeros((width, width))
    full[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["x"].to_numpy()
    return (full + full.T) / 2


def axes(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors, the columns of a matrix."""
    values, vectors = np.linalg.eigh(covariance)
    return values[::-1], np.ascontiguousarray(vectors[:, ::-1])


def _exact_deviation(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum of (n * x - S)² in integers of any size; null beyond a long."""
    most = max((abs(n * int(e) - s) for e, s in ((m, s) for bound in (x.max(axis=0), x.min(axis=0)) for m, s in zip(bound, sums))), default=0)
    if most ** 2 * len(sums) < 1 << 63 and max(map(abs, sums)) < 1 << 63:
        return pa.array(((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1))
    exact = [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
             shift: int = SHIFT, counted: bool = True) -> DataFrame:
    """The first whitened components of every row: (id, component, n, deviation, whitened, explained, identity_error)."""
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, vector_col, scale, shift)
    schema = RESULT.format(id=rows.schema["id"].dataType.simpleString())
    distinct = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows")), "distinct-vectors")
    distinct = distinct.withColumn("weight", F.col("rows") if counted else F.lit(1).cast("long"))
    size = distinct.agg(F.max(F.size("x")).alias("width"), F.sum("weight").alias("n"), F.sum("rows").alias("rows")).first()
    width, n = size["width"], size["n"]
    if not width:
        return spark.createDataFrame([], schema)

    distinct = distinct.select("weight", "rows", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit("x"), "x").alias("h2"), padded(width, shift).alias("x"))
    sums = exact_sums(distinct, width)
    values, turn = axes(products(distinct.select("weight", "x"), width, lambda b: centred(matrix(b.column(1), width), n, sums)) / n)
    shown = min(components, width)
    real = int(sum(values[:shown] > VANISHED * values[0])) if values[0] > 0 else 0
    onto = turn[:, :real] / np.sqrt(values[:real])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(4), width)
            for at in range(0, batch.num_rows, BLOCK):
                part, block = batch.slice(at, BLOCK), x[at: at + BLOCK]
                z = centred(block, n, sums) @ onto
                lists = pa.ListArray.from_arrays(np.arange(len(z) + 1, dtype=np.int32) * real, z.ravel())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], _exact_deviation(block, n, sums), lists], names=["weight", "rows", "h1", "h2", "deviation", "z"])

    once = stored(distinct.mapInArrow(project, "weight long, rows long, h1 long, h2 long, deviation long, z array<double>"), "whitened-vectors")
    error = None
    if real:
        # a column of ones brings the sums along
        ones = lambda b: np.column_stack((b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, real), np.ones(b.num_rows)))
        got = products(once.select("weight", "z"), real + 1, ones) / n
        error = float(np.abs(got[:real, :real] - np.outer(got[real, :real], got[real, :real]) - np.eye(real)).max())

    heavy = F.col("rows") * HEAVY > F.lit(size["rows"])
    name = lambda df: df.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "deviation", "z")
    few, many = name(once.where(heavy)), name(once.where(~heavy))
    on = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    named = rows.select("id", "h1", "h2")
    of_heavy = named.join(F.broadcast(few), on)  # fewer than HEAVY rows
    of_rest = named.join(F.broadcast(few), on, "left_anti").join(many, on)
    back = of_heavy.unionByName(of_rest)
    trace = float(values.sum())
    share = [float(v) / trace if trace > 0 else None for v in values[:shown]]
    table = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.lit(s).cast("double").alias("explained")) for i, s in enumerate(share)])
    out = back.withColumn("c", F.explode(table))
    return out.select("id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", F.get("z", F.col("c.component") - 1).alias("whitened"),
                      "c.explained", F.lit(error).cast("double").alias("identity_error"))
