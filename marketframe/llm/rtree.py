"""Hard-negative mining with an STR-packed R-tree.

Rows (label and integer vector) are packed by sort-tile-recursive: Spark cuts
the table into tiles at quantiles of the label, then of the coordinates that
vary most; each tile is packed into leaves the same way by the task that holds
it. A node keeps the least and largest label and coordinates below it. For an
anchor q each coordinate of a box gives an interval of products, q·low or
q·high, and their sums bound every inner product inside from both sides.

A search has score windows for each anchor: one without ends for the positives
(rows of the anchor's label), one for each positive for the negatives (other
labels). A best-first queue takes the node with the highest upper bound next and
drops for an anchor what lies outside all its windows or strictly below the
k-th best score found in them; what is left in the leaves is scored exactly.

The same holds for whole tiles. Each anchor first visits the ``HOME`` tiles with
the highest bounds; the k-th scores found there say which other tiles it needs.
A tile's rows are held by one task, anchors stream past them, so no task and no
row grows with the number of anchors; the driver and every task hold one box a
tile, at most ``MOST_TILES`` and as many again for crowded ones. A tile crowded
by rows that no cut can part (equal vectors, one label) is dealt to several tiles.

Defined results: rows whose id, label or vector is null, or whose vector holds a
null or non-finite component, take no part; shorter vectors count as padded with
zeros; an anchor does not meet rows of its own id; equal scores go to the
smaller id; repeated rows are one as anchors and each count as positives and
negatives; an anchor without positives, or whose windows are empty (a negative
score of the positive), gives no row; scores must fit a long; an empty table or
one without anchors gives an empty result.
"""

from __future__ import annotations

import dataclasses
import heapq
import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import pick, stored
from marketframe.llm.topk import matrix

TILE_ROWS = 16_384         # rows a task holds, about
LEAST_TILES, MOST_TILES = 32, 1 << 16
LEAF, FANOUT = 64, 16
HOME = 2
TILE_AXES, LEAF_AXES = 2, 3
BATCH, CELLS = 256, 1 << 22
NONE, ALL = -(1 << 62), 1 << 62
EXACT = float(1 << 53)
FOUND = "id long, key long, w int, found long, score long"
ENTRIES = "tile long, place long, id long, label long, v array<long>"


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """Rows that take part: (id, label, v)."""
    rows = pick(vectors, id=id_col, x=vector_col, label=label_col).where("id IS NOT NULL AND x IS NOT NULL AND label IS NOT NULL")
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.where(finite).select(F.col("id").cast("long"), F.col("label").cast("long"), F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer matrices."""
    most = max(1, int(np.abs(q).max(initial=0))) * max(1, int(np.abs(c).max(initial=0))) * max(1, q.shape[1])
    return (q.astype(float) @ c.astype(float).T).astype(np.int64) if most < EXACT else q @ c.T


def intervals(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each vector with any point of each box."""
    up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    low, high = low.astype(float).T, high.astype(float).T
    most = np.abs(q).max(initial=0) * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0)) * max(1, q.shape[1])
    slack = 0.0 if most < EXACT else most * 1e-12
    return up @ low + down @ high - slack, up @ high + down @ low + slack


# packing


def _spread(rows: DataFrame, width: int) -> list[int]:
    """Coordinates in order of falling variance; the driver gets one number each."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, ss = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            x = matrix(batch.column(0), width).astype(float)
            n, s, ss = n + len(x), s + x.sum(axis=0), ss + (x * x).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(np.full(width, float(n))), pa.array(s), pa.array(ss)], names=["i", "n", "s", "ss"])

    got = rows.select("v").mapInArrow(sums, "i long, n double, s double, ss double").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss")).collect()
    return [r["i"] for r in sorted(got, key=lambda r: (-(r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2), r["i"]))]


@dataclasses.dataclass
class Cut:
    """Cuts of one axis (-1: the label) for each tile of the levels before."""
    axis: int
    parts: int
    at: dict[int, np.ndarray]


def _tile(cuts: list[Cut], label: np.ndarray, v: np.ndarray) -> np.ndarray:
    tile = np.zeros(len(label), np.int64)
    for cut in cuts:
        value, slab = label if cut.axis < 0 else v[:, cut.axis], np.zeros(len(label), np.int64)
        for t in np.unique(tile).tolist():
            of = tile == t
            slab[of] = np.searchsorted(cut.at[t], value[of], side="left") if t in cut.at else 0
        tile = tile * cut.parts + slab
    return tile


def _cuts(rows: DataFrame, width: int, tiles: int) -> list[Cut]:
    """Quantiles of the label, then of the widest coordinates within what was cut before: together about ``tiles`` tiles."""
    labels = rows.agg(F.approx_count_distinct("label")).first()[0]
    axes = _spread(rows, width)[:TILE_AXES]
    cuts: list[Cut] = []
    left = tiles
    for k, axis in enumerate([-1, *axes]):
        parts = math.ceil(left ** (1 / (1 + len(axes) - k)) - 1e-9)
        parts = max(parts, min(labels, left)) if axis < 0 else parts
        left = math.ceil(left / parts)
        if parts < 2:
            continue

        def values(batches: Iterator[pa.RecordBatch], before: list[Cut] = list(cuts), axis: int = axis) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                label, v = batch.column(0).to_numpy(), matrix(batch.column(1), width)
                yield pa.RecordBatch.from_arrays([pa.array(_tile(before, label, v)), pa.array(label if axis < 0 else v[:, axis])], names=["tile", "value"])

        at = [i / parts for i in range(1, parts)]
        got = rows.select("label", "v").mapInArrow(values, "tile long, value long").groupBy("tile").agg(F.percentile_approx("value", at).alias("at")).collect()
        cuts.append(Cut(axis, parts, {r["tile"]: np.array(r["at"], np.int64) for r in got}))
    return cuts


def str_order(keys: list[np.ndarray], leaf: int) -> np.ndarray:
    """Sort-tile-recursive order: consecutive runs of ``leaf`` rows are the leaves."""
    def order(at: np.ndarray, k: int) -> np.ndarray:
        at = at[np.argsort(keys[k][at], kind="stable")]
        pages = math.ceil(len(at) / leaf)
        if k + 1 == len(keys) or pages < 2:
            return at
        slab = math.ceil(pages / math.ceil(pages ** (1 / (len(keys) - k)) - 1e-9)) * leaf
        return np.concatenate([order(at[s: s + slab], k + 1) for s in range(0, len(at), slab)])
    return order(np.arange(len(keys[0])), 0)


def _packed(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Over rows sorted by tile: each tile's rows in STR order (place), and the corners of its box (place -1 and -2)."""
    def pack(tile: int, held: list) -> pa.RecordBatch:
        ids, label, v = (np.concatenate(x) for x in zip(*held))
        axes = np.argsort(-v.var(axis=0), kind="stable")[:LEAF_AXES]
        order = str_order([label, *(v[:, a] for a in axes)], LEAF)
        ids, label, v = ids[order], label[order], v[order]
        label = np.concatenate(([label.min(), label.max()], label))
        v = np.concatenate((v.min(axis=0)[None], v.max(axis=0)[None], v))
        lists = pa.ListArray.from_arrays(np.arange(0, v.size + 1, width, dtype=np.int32), v.ravel())
        place = np.concatenate(([-1, -2], np.arange(len(ids))))
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(place), tile)), pa.array(place), pa.array(np.concatenate(([0, 0], ids))), pa.array(label), lists],
                                          names=["tile", "place", "id", "label", "v"])

    def run(batches):
        at, held = None, []
        for batch in batches:
            tiles = batch.column(0).to_numpy()
            edges = np.flatnonzero(tiles[1:] != tiles[:-1]) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(tiles)]):
                if a == b:
                    continue
                if tiles[a] != at and held:
                    yield pack(at, held)
                    held = []
                at, part = tiles[a], batch.slice(a, b - a)
                held.append((part.column(1).to_numpy(), part.column(2).to_numpy(), matrix(part.column(3), width)))
        if held:
            yield pack(at, held)
    return run


def packed(rows: DataFrame, width: int, count: int, tile_rows: int, least: int) -> DataFrame:
    """The tree's entries and tile boxes (``ENTRIES``), written below the shared folder."""
    tiles = min(MOST_TILES, max(least, math.ceil(count / tile_rows)))
    cuts = _cuts(rows, width, min(tiles, count))

    def tiled(place: dict[int, tuple[int, int]] | None) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen = 0
            for batch in batches:
                tile = _tile(cuts, batch.column(1).to_numpy(), matrix(batch.column(2), width))
                if place is not None:
                    first, parts = (np.array([place[t][i] for t in tile.tolist()], np.int64) for i in (0, 1))
                    tile = first + np.arange(seen, seen + len(tile)) % parts  # dealt in turn
                seen += len(tile)
                yield pa.RecordBatch.from_arrays([pa.array(tile), *batch.columns], names=["tile", "id", "label", "v"])
        return run

    shape = "tile long, id long, label long, v array<long>"
    sizes = rows.mapInArrow(tiled(None), shape).groupBy("tile").agg(F.count(F.lit(1)).alias("n")).orderBy("tile").collect()  # a row per tile
    most, place, used = 2 * math.ceil(count / tiles), {}, 0
    for r in sizes:
        parts = 1 if r["n"] <= most else math.ceil(r["n"] / (most // 2))
        place[r["tile"]] = (used, parts)
        used += parts
    dealt = rows.mapInArrow(tiled(place), shape).repartition("tile").sortWithinPartitions("tile")
    return stored(dealt.mapInArrow(_packed(width), ENTRIES), "tree")


@dataclasses.dataclass
class Boxes:
    """Corners of boxes: a row per box."""
    label_low: np.ndarray
    label_high: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def __getitem__(self, at) -> Boxes:
        return Boxes(self.label_low[at], self.label_high[at], self.low[at], self.high[at])

    def above(self, starts: np.ndarray) -> Boxes:
        """Boxes around runs of these."""
        least, most = np.minimum.reduceat, np.maximum.reduceat
        return Boxes(least(self.label_low, starts), most(self.label_high, starts), least(self.low, starts), most(self.high, starts))


def tile_boxes(tree: DataFrame, width: int) -> tuple[np.ndarray, Boxes]:
    """Tile numbers and boxes."""
    corners = tree.where("place < 0").orderBy("tile", "place").select("tile", "label", "v").toArrow().combine_chunks()
    tile, label = corners["tile"].to_numpy(), corners["label"].to_numpy()
    v = matrix(corners["v"].chunk(0), width)
    return tile[0::2], Boxes(label[1::2], label[0::2], v[1::2], v[0::2])  # place -2 (high) stands before -1 (low)


# searching


@dataclasses.dataclass
class Queries:
    """Anchors with their windows: a score counts from ``floor`` to ``high``, a column per window."""
    id: np.ndarray
    label: np.ndarray
    v: np.ndarray
    floor: np.ndarray
    high: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, width: int, windows: int) -> Queries:
        col = lambda name: batch.column(batch.schema.get_field_index(name))
        low, high, kth = (matrix(col(c), windows) for c in ("low", "high", "kth"))
        return Queries(col("id").to_numpy(), col("label").to_numpy(), matrix(col("v"), width), np.maximum(low, kth), high)

    def need(self, live: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether scores of low to high can matter to any window: (anchors, boxes)."""
        return ((low[..., None] <= self.high[live][:, None, :]) & (high[..., None] >= self.floor[live][:, None, :])).any(axis=2)

    def may_hold(self, live: np.ndarray, boxes: Boxes, same: bool) -> np.ndarray:
        """Whether a box can hold rows of an anchor's label, or of another one."""
        label = self.label[live][:, None]
        return (boxes.label_low <= label) & (label <= boxes.label_high) if same else (boxes.label_low != label) | (boxes.label_high != label)


def _needed_tiles(tiles: np.ndarray, boxes: Boxes, width: int, windows: int, same: bool, home: bool) -> Callable:
    """Anchors, one row for each tile they visit: the ``HOME`` with the highest bounds, or the others that can matter."""
    columns = ["id", "key", "label", "v", "low", "high", "kth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, min(BATCH, CELLS // max(1, len(tiles) * windows)))
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                q = Queries.of(batch, width, windows)
                live = np.arange(len(q.id))
                low, high = intervals(q.v, boxes.low, boxes.high)
                holds = q.may_hold(live, boxes, same)
                first = np.argsort(np.where(holds, -high, np.inf), axis=1, kind="stable")[:, :HOME]
                at_home = np.zeros_like(holds)
                np.put_along_axis(at_home, first, True, axis=1)
                row, at = np.nonzero(holds & q.need(live, low, high) & (at_home if home else ~at_home))
                taken = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tiles[at]), pa.array(np.full(len(row), ALL)), *(taken.column(taken.schema.get_field_index(c)) for c in columns)],
                    names=["tile", "place", *columns])
    return run


class Tree:
    """The levels of one tile, leaves first, over rows in STR order."""

    def __init__(self, ids: np.ndarray, label: np.ndarray, v: np.ndarray):
        self.ids, self.label, self.v = ids, label, v
        self.starts = [np.arange(0, len(ids), LEAF)]
        self.levels = [Boxes(label, label, v, v).above(self.starts[0])]
        while len(self.starts[-1]) > FANOUT:
            self.starts.append(np.arange(0, len(self.starts[-1]), FANOUT))
            self.levels.append(self.levels[-1].above(self.starts[-1]))

    def best_first(self, q: Queries, k: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """The k best scores and ids of every anchor and window, as far as they can matter: (anchors, windows, k)."""
        shape = (*q.floor.shape, k)
        scores, ids = np.full(shape, NONE), np.full(shape, ALL)
        queue, turn = [], itertools.count()

        def push(level: int, first: int, last: int, live: np.ndarray) -> None:
            boxes = self.levels[level][first:last]
            low, high = intervals(q.v[live], boxes.low, boxes.high)
            need = q.need(live, low, high) & q.may_hold(live, boxes, same)
            for j in np.flatnonzero(need.any(axis=0)).tolist():
                of = need[:, j]
                heapq.heappush(queue, (-high[of, j].max(), next(turn), level, first + j, live[of], low[of, j], high[of, j]))

        push(len(self.levels) - 1, 0, len(self.starts[-1]), np.arange(len(q.id)))
        while queue:
            _, _, level, node, live, low, high = heapq.heappop(queue)
            live = live[q.need(live, low[:, None], high[:, None])[:, 0]]  # the k-th scores have risen since
            if not len(live):
                continue
            if level:
                push(level - 1, node * FANOUT, (node + 1) * FANOUT, live)
            else:
                self._score(slice(node * LEAF, (node + 1) * LEAF), q, live, same, scores, ids)
        return scores, ids

    def _score(self, leaf: slice, q: Queries, live: np.ndarray, same: bool, scores: np.ndarray, ids: np.ndarray) -> None:
        """Exact scores of a leaf; floors rise to the k-th best."""
        got, of = products(q.v[live], self.v[leaf]), self.ids[leaf]
        fits = ((self.label[leaf] == q.label[live][:, None]) == same) & (of != q.id[live][:, None])
        for w in range(q.floor.shape[1]):
            hit = fits & (got >= q.floor[live, w][:, None]) & (got <= q.high[live, w][:, None])
            rows = np.flatnonzero(hit.any(axis=1))
            if not len(rows):
                continue
            at, hit = live[rows], hit[rows]
            s = np.concatenate((scores[at, w], np.where(hit, got[rows], NONE)), axis=1)
            i = np.concatenate((ids[at, w], np.where(hit, of, ALL)), axis=1)
            best = np.lexsort((i, -s), axis=-1)[:, : scores.shape[2]]
            scores[at, w], ids[at, w] = np.take_along_axis(s, best, axis=1), np.take_along_axis(i, best, axis=1)
            q.floor[at, w] = np.maximum(q.floor[at, w], scores[at, w, -1])


def _visited(width: int, windows: int, k: int, same: bool) -> Callable:
    """Over rows sorted by (tile, place): hold a tile's rows, then answer the anchors that come."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, tree = None, [], None
        for whole in batches:
            tile, asks = whole.column(0).to_numpy(), whole.column(1).to_numpy() == ALL
            edges = np.flatnonzero((tile[1:] != tile[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(tile)]):
                if a == b:
                    continue
                if tile[a] != at:
                    at, held, tree = tile[a], [], None
                part = whole.slice(a, b - a)
                if not asks[a]:
                    held.append((part.column(2).to_numpy(), part.column(4).to_numpy(), matrix(part.column(5), width)))
                    continue
                if tree is None:
                    tree, held = Tree(*(np.concatenate(x) for x in zip(*held))), []
                for start in range(0, b - a, BATCH):
                    batch = part.slice(start, BATCH)
                    scores, ids = tree.best_first(Queries.of(batch, width, windows), k, same)
                    row, w, j = np.nonzero(scores != NONE)
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(pa.array(row)) for c in (2, 3)), pa.array(w.astype(np.int32)), pa.array(ids[row, w, j]), pa.array(scores[row, w, j])],
                        names=["id", "key", "w", "found", "score"])
    return run


def search(tree: DataFrame, tiles: np.ndarray, boxes: Boxes, width: int, asked: DataFrame, windows: int, k: int, same: bool) -> DataFrame:
    """The k best rows of each anchor's windows: (id, key, w, found, score, rank).

    ``asked`` has (id, key, label, v, low, high), low and high one entry per
    window; ``same`` searches rows of the anchor's label, else those of others.
    """
    none = F.lit(None).cast("long")
    entries = tree.where("place >= 0").select(
        "tile", "place", "id", none.alias("key"), "label", "v", *[F.lit(None).cast("array<long>").alias(c) for c in ("low", "high", "kth")])
    shape = "tile long, place long, id long, key long, label long, v array<long>, low array<long>, high array<long>, kth array<long>"
    lists = lambda c, fill: F.concat(c, F.array_repeat(F.lit(fill).cast("long"), F.lit(windows) - F.size(c))).alias(c)
    asked = asked.select("id", "key", "label", "v", lists("low", ALL), lists("high", NONE))  # windows that are not there hold nothing
    asked = stored(asked, "anchors")
    rank = F.row_number().over(Window.partitionBy("id", "key", "w").orderBy(F.desc("score"), "found"))
    best = lambda found: found.withColumn("rank", rank).where(F.col("rank") <= k)

    def visited(queries: DataFrame, home: bool) -> DataFrame:
        going = queries.mapInArrow(_needed_tiles(tiles, boxes, width, windows, same, home), shape)
        dealt = entries.unionByName(going).repartition("tile").sortWithinPartitions("tile", "place")
        return dealt.mapInArrow(_visited(width, windows, k, same), FOUND)

    nothing = F.array_repeat(F.lit(NONE).cast("long"), windows)
    near = stored(best(visited(asked.withColumn("kth", nothing), True)).drop("rank"), "home-scores")
    least = near.groupBy("id", "key", "w").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    bounds = least.groupBy("id", "key").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("of"))  # an entry per window
    bounds = bounds.select(F.col("id").alias("b_id"), F.col("key").alias("b_key"), "of")
    kth = F.transform(F.sequence(F.lit(0), F.lit(windows - 1)), lambda w: F.coalesce(F.try_element_at(F.col("of"), w), F.lit(NONE)))
    bounded = asked.join(bounds, (F.col("id") == F.col("b_id")) & (F.col("key") == F.col("b_key")), "left").select(*asked.columns, kth.alias("kth"))
    return best(near.unionByName(visited(bounded, False)))


def hard_negatives(vectors: DataFrame, is_anchor: Callable[[Column], Column], positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = 256,
                   tile_rows: int = TILE_ROWS, least_tiles: int = LEAST_TILES) -> DataFrame:
    """The first negatives of every anchor and positive: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Positives are the best rows of the anchor's label, negatives rows of other
    labels whose score lies between ``low`` and ``high`` hundredths of the
    positive's. ``is_anchor`` says which ids are anchors.
    """
    rows = stored(prepared(vectors, id_col, vector_col, label_col, scale), "labelled-vectors")
    size = rows.agg(F.max(F.size("v")).alias("width"), F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor(F.col("id")), 1)).alias("anchors")).first()
    if not size["anchors"]:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    width = max(1, size["width"])
    tree = packed(rows, width, size["n"], tile_rows, least_tiles)
    tiles, boxes = tile_boxes(tree, width)

    anchors = rows.where(is_anchor(F.col("id"))).distinct().withColumn("key", F.xxhash64("id", "label", "v"))
    whole = lambda x: F.array(F.lit(x).cast("long"))
    alike = search(tree, tiles, boxes, width, anchors.withColumns({"low": whole(NONE + 1), "high": whole(ALL)}), 1, positives, True)
    alike = stored(alike.select("id", "key", "rank", F.col("found").alias("positive"), F.col("score").alias("positive_score")), "positives")

    least = F.expr(f"-((-{low} * positive_score - pmod(-{low} * positive_score, 100L)) div 100)")  # rounded up
    most = F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100L)) div 100")  # rounded down
    ends = alike.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("rank", least.alias("low"), most.alias("high")))).alias("ends"))  # an entry per positive
    ends = ends.select(F.col("id").alias("e_id"), F.col("key").alias("e_key"), F.col("ends.low").alias("low"), F.col("ends.high").alias("high"))
    asked = anchors.join(ends, (F.col("id") == F.col("e_id")) & (F.col("key") == F.col("e_key"))).select(*anchors.columns, "low", "high")
    unlike = search(tree, tiles, boxes, width, asked, positives, negatives, False)
    of = alike.select(F.col("id").alias("p_id"), F.col("key").alias("p_key"), (F.col("rank") - 1).alias("p_w"), "positive", "positive_score")
    both = unlike.join(of, (F.col("id") == F.col("p_id")) & (F.col("key") == F.col("p_key")) & (F.col("w") == F.col("p_w")))
    return both.select(F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("found").alias("negative_id"),
                       "positive_score", F.col("score").alias("negative_score"))
