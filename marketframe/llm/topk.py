"""Exact top-k inner products over norm-sorted strata.

Candidates are cut into strata of descending length. A query needs a stratum
only if its own length times the stratum's longest reaches the query's bound,
the k-th best score so far (Cauchy-Schwarz). Within a stratum vectors are
rotated by the eigenvectors of the corpus' Gram matrix (its right singular
vectors): the first rotated components give a partial sum, and the lengths of
the rests bound what is missing. What the bounds leave is scored exactly on the
original integers.

The first bound of each query comes from the ``FIRST`` longest vectors. Queries
travel to the strata they need, strata are joined with blocks of queries of
bounded size; nothing grows with the table in one task or on the driver but one
number per stratum.

Defined results: vectors that are null, hold a null or non-finite component, or
have no id take no part; shorter vectors count as padded with zeros; a query
does not meet rows of its own id; equal scores go to the smaller id, equal
candidate rows each count; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import pick, stored

FIRST = 4096            # longest vectors that set the first bounds; sent to every task
STRATUM_ROWS = 65_536   # candidates held by a task at most
LEAST_STRATA = 32       # so that small tables use many tasks too
QUERY_ROWS = 65_536     # queries a task meets a stratum with, about
BLOCK, BATCH = 2048, 256
EXACT = float(1 << 53)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """Integer vectors and their lengths: (id, v, norm)."""
    rows = pick(vectors, id=id_col, x=vector_col).where(F.col("id").isNotNull() & F.col("x").isNotNull())
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = rows.where(finite).select("id", F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    return rows.withColumn("norm", F.sqrt(square))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of integers, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    for i, n in enumerate(sizes):
        out[i, :n] = flat[at[i]: at[i + 1]]
    return out


def rotation(rows: DataFrame, width: int) -> np.ndarray:
    """Right singular vectors of all vectors, strongest first; the driver gets width² sums."""
    def gram(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column(0), width).astype(float)
            total += x.T @ x
        i, j = np.divmod(np.arange(width * width), width)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "x"])

    sums = rows.select("v").mapInArrow(gram, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    full = np.zeros((width, width))
    full[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["x"].to_numpy()
    _, vectors = np.linalg.eigh((full + full.T) / 2)
    return np.ascontiguousarray(vectors[:, ::-1])


def _bucket(norm: Column) -> Column:
    """Lengths on a logarithmic scale: a bounded number of buckets, larger ones first."""
    return F.when(norm > 0, -F.floor(F.log2(norm) * 32)).otherwise(F.lit(1 << 20)).cast("long")


def strata_of(rows: DataFrame, strata_rows: int, least: int) -> tuple[dict[int, tuple[int, int]], list[float]]:
    """Where each length bucket goes, {bucket: (first stratum, strata)}, and the longest vector of each stratum."""
    buckets = rows.groupBy(_bucket(F.col("norm")).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("m")).orderBy("b").collect()
    total = sum(r["n"] for r in buckets)
    per = max(1, min(strata_rows, math.ceil(total / least)))
    place, longest, used = {}, [], per
    for r in buckets:
        if r["n"] > per:  # a crowded length is dealt to several strata by id
            parts = math.ceil(r["n"] / per)
            place[r["b"]] = (len(longest), parts)
            longest += [r["m"]] * parts
            used = per
        else:
            if used + r["n"] > per:
                longest.append(r["m"])
                used = 0
            place[r["b"]] = (len(longest) - 1, 1)
            used += r["n"]
    return place, longest


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer matrices."""
    most = max(1, int(np.abs(q).max(initial=0))) * max(1, int(np.abs(c).max(initial=0))) * max(1, q.shape[1])
    if most < EXACT:
        return (q.astype(float) @ c.astype(float).T).astype(np.int64)
    return q @ c.T


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: larger score, then smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _first_bounds(k: int, width: int, top_ids: np.ndarray, top: np.ndarray, longest: np.ndarray, chunks: int) -> Callable:
    """Queries with their first bound, one row for each stratum they may need."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                ids, norms = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                scores = _products(matrix(batch.column(1), width), top)
                bounds = np.full(len(ids), -np.inf)
                for i in range(len(ids)):
                    others = scores[i][top_ids != ids[i]]
                    if len(others) >= k:
                        bounds[i] = np.partition(others, len(others) - k)[len(others) - k]
                reach = norms[:, None] * longest[None, :] * (1 + 1e-9) + 1 >= bounds[:, None]
                row, stratum = np.nonzero(reach)
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(stratum.astype(np.int64)), pa.array(ids[row] % chunks), pa.array(np.ones(len(row), np.int32)),
                     *taken.columns, pa.array(bounds[row])], names=["stratum", "chunk", "kind", "id", "v", "norm", "bound"])
    return run


def _scored(k: int, width: int, turn: np.ndarray) -> Callable:
    """Over rows sorted by (stratum, chunk, kind): hold a stratum's candidates, score queries as they come."""
    lead = max(1, width // 4)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, blocks, held = None, None, []
        for whole in batches:
            group = whole.column(0).to_numpy() * (1 << 32) + whole.column(1).to_numpy()
            kind = whole.column(2).to_numpy()
            edges = np.flatnonzero((group[1:] != group[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(group)]):
                if group[a] != at:
                    at, blocks, held = group[a], None, []
                part = whole.slice(a, b - a)
                v, ids, norms = matrix(part.column(4), width), part.column(3).to_numpy(), part.column(5).to_numpy()
                if not kind[a]:
                    held.append((ids, v, norms))
                    continue
                if blocks is None:
                    blocks = _cut(held, turn, lead)
                    held = []
                for s in range(0, b - a, BATCH):
                    yield from _meet(ids[s: s + BATCH], v[s: s + BATCH], norms[s: s + BATCH], part.column(6).to_numpy()[s: s + BATCH], blocks, turn, lead, k)
    return run


def _cut(held: list, turn: np.ndarray, lead: int) -> list:
    """Blocks of a stratum, longest vectors first: ids, integers, rotated lead, length of the rest, longest."""
    if not held:
        return []
    ids, v, norms = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((ids, -norms))
    ids, v, norms = ids[order], v[order], norms[order]
    out = []
    for s in range(0, len(ids), BLOCK):
        turned = v[s: s + BLOCK].astype(float) @ turn
        out.append((ids[s: s + BLOCK], v[s: s + BLOCK], turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(axis=1)), norms[s]))
    return out


def _meet(ids, v, norms, bounds, blocks, turn, lead, k) -> Iterator[pa.RecordBatch]:
    """The k best candidates of a stratum for a batch of queries, or fewer where the bounds exclude them."""
    bounds = bounds.copy()
    turned = v.astype(float) @ turn
    first, rest = turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(axis=1))
    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
    for c_ids, c_v, c_first, c_rest, longest in blocks:
        live = np.flatnonzero(norms * longest * (1 + 1e-9) + 1 >= bounds)
        if not len(live):
            break  # later blocks are shorter still
        # sums in floating point: a slack far above their error, far below a score's step
        slack = 1e-9 * norms[live] * longest + 1
        may = first[live] @ c_first.T + rest[live][:, None] * c_rest[None, :] + slack[:, None] >= bounds[live][:, None]
        may &= ids[live][:, None] != c_ids[None, :]
        used = np.flatnonzero(may.any(axis=0))
        if not len(used):
            continue
        scores = _products(v[live], c_v[used])
        good = may[:, used] & (scores >= bounds[live][:, None])
        for row, i in enumerate(live.tolist()):
            hits = np.flatnonzero(good[row])
            if not len(hits):
                continue
            s, c = np.concatenate((best[i][0], scores[row, hits])), np.concatenate((best[i][1], c_ids[used[hits]]))
            top = _best(s, c, k)
            best[i] = s[top], c[top]
            if len(top) == k:
                bounds[i] = max(bounds[i], s[top[-1]])
    sizes = [len(s) for s, _ in best]
    if sum(sizes):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([c for _, c in best])), pa.array(np.concatenate([s for s, _ in best]))],
            names=["query_id", "id", "score"])


def top_k(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64, strata_rows: int = STRATUM_ROWS, least_strata: int = LEAST_STRATA) -> DataFrame:
    """The k best candidates of each query: (query_id, rank, id, score). ``is_query`` says which ids are queries."""
    spark = vectors.sparkSession
    rows = stored(prepared(vectors, id_col, vector_col, scale), "vectors")
    found = "query_id long, id long, score long"
    sizes = rows.agg(F.max(F.size("v")).alias("width"), F.count(F.when(is_query(F.col("id")), 1)).alias("queries")).first()
    if not sizes["queries"]:
        return spark.createDataFrame([], "query_id long, rank int, id long, score long")
    width, chunks = max(1, sizes["width"]), math.ceil(sizes["queries"] / QUERY_ROWS)
    turn = rotation(rows, width)
    place, longest = strata_of(rows, strata_rows, least_strata)
    top = rows.orderBy(F.desc("norm"), "id").limit(FIRST).select("id", "v").toArrow().combine_chunks()
    top_ids, top_v = top["id"].to_numpy(), matrix(top["v"].chunk(0), width)

    shape = "stratum long, chunk long, kind int, id long, v array<long>, norm double, bound double"
    queries = rows.where(is_query(F.col("id"))).distinct()
    asked = queries.mapInArrow(_first_bounds(k, width, top_ids, top_v, np.array(longest), chunks), shape)
    at = F.create_map(*[x for b, (s, n) in place.items() for x in (F.lit(b), F.struct(F.lit(s).alias("s"), F.lit(n).alias("n")))])[_bucket(F.col("norm"))]
    placed = rows.withColumn("at", at).withColumn("stratum", F.col("at.s") + F.pmod(F.xxhash64("id"), F.col("at.n")))
    placed = placed.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    placed = placed.select(F.col("stratum").cast("long"), F.col("chunk").cast("long"), F.lit(0).alias("kind"), "id", "v", "norm", F.lit(0.0).alias("bound"))
    dealt = placed.unionByName(asked).repartition("stratum", "chunk").sortWithinPartitions("stratum", "chunk", "kind")
    scored = dealt.mapInArrow(_scored(k, width, turn), found)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
