"""Whitening, packing and hard negatives against brute force: nulls, ties, repeated rows, hot vectors, clashing names, empty tables."""

import bisect
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketframe.llm import packing, queries, rtree, whitening

SMALL = "/root/testdata/sf0.001"
VOCABULARY = str(public_tokenizers.path("word_bpe_49k.json"))
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, more=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    return df.selectExpr("*", "1 AS id", "2 AS x", "3 AS tile", "4 AS h1", "5 AS key", "'a' AS Label_", "6 AS rank") if more else df


def usable(rows):
    return [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]


def f32(values):
    return [float(np.float32(v)) for v in values]


# whitening


def whitened_by_hand(rows, width, counted=True):
    rows = usable(rows)
    x = np.array([[math.floor(1024 * c) + 100_000 for c in (*v, *[0.0] * (width - len(v)))] for _, v, *_ in rows])
    fit = x if counted else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, turn = np.linalg.eigh(centred.T @ centred / n)
    values, turn = values[::-1], turn[:, ::-1]
    shown = min(8, width)
    z = (x - s / n) @ turn[:, :shown] / np.sqrt(np.maximum(values[:shown], 1e-300))
    deviation = [sum((n * int(e) - int(t)) ** 2 for e, t in zip(row, s)) for row in x]
    return rows, n, deviation, z, values[:shown] / values.sum(), values[:shown] > 1e-9 * values[0]


@pytest.mark.parametrize("counted", [True, False])
def test_whitening(spark, counted):
    r = np.random.default_rng(4)
    scales = np.linspace(0.05, 0.6, 12)
    rows = [(i, f32(r.normal(size=12) * scales), 0) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 0) for i in range(200)]  # a hot vector
    rows += [(5, rows[9][1], 1), (5, rows[9][1], 1), (None, rows[3][1], None), (6, None, 1), (7, [1.0, None], 1), (8, [NAN] * 12, 1), (9, [INF] * 12, 1), (10, f32([0.25, -0.5]), 1), (11, [], 1)]
    kept, n, deviation, z, explained, real = whitened_by_hand(rows, 12, counted)
    got = whitening.whitened(vectors(spark, rows), counted=counted).toPandas()
    assert real.all() and len(got) == 8 * len(kept) and set(got["n"]) == {n}
    assert sorted(got["component"].value_counts().to_dict().items()) == [(c, len(kept)) for c in range(1, 9)]
    for c in range(1, 9):
        part = got[got["component"] == c]
        assert np.allclose(part["explained"], explained[c - 1], rtol=1e-9)
        mine = lambda k: sorted((-1 if i is None else i, d, round(k * w, 6)) for (i, *_), d, w in zip(kept, deviation, z[:, c - 1]))  # noqa: B023, E731
        theirs = sorted((-1 if np.isnan(i) else int(i), int(d), round(w, 6)) for i, d, w in zip(part["id"], part["deviation"], part["whitened"]))
        assert any(all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-5 for a, b in zip(mine(k), theirs)) for k in (1, -1))
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_whitening_of_few_and_equal_vectors(spark):
    rows = [(1, [0.1, 0.2, 0.3], 0), (2, [0.3, 0.2, 0.1], 0)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert len(got) == 6 and {x["component"] for x in got if x["whitened"] is not None} == {1}
    assert all(abs(abs(x["whitened"]) - 1) < 1e-9 and x["explained"] > 0.999 for x in got if x["component"] == 1)
    same = whitening.whitened(vectors(spark, [(i, [0.5, 0.5], 0) for i in range(20)])).collect()
    assert len(same) == 40 and all(x["whitened"] is None and x["identity_error"] is None and x["explained"] is None and x["deviation"] == 0 for x in same)
    assert whitening.whitened(vectors(spark, [(1, None, 0), (2, [], 0)])).count() == 0
    assert whitening.whitened(vectors(spark, [])).count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [(i, [float(10.0 ** (10 + i)), float(i)], 0) for i in range(8)] + [(9, [3e38, -3e38], 0)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert len(got) == 18 and any(x["deviation"] is None for x in got)


def test_op11_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    kept, n, deviation, z, explained, real = whitened_by_hand(rows, 64)
    got = {(x["vec_id"], x["component"]): x for x in queries.QUERIES["op11_whitening"](spark, SMALL).collect()}
    assert real.all() and len(got) == 8 * len(kept) and len({x["identity_error"] for x in got.values()}) == 1
    mine = np.array([[got[i, c]["whitened"] for c in range(1, 9)] for i, *_ in kept])
    assert np.abs(np.abs(mine) - np.abs(z)).max() < 1e-7 and np.abs(mine.T @ mine / n - np.eye(8)).max() < 1e-9
    assert all(got[i, c]["deviation"] == d and got[i, c]["n"] == n and abs(got[i, c]["explained"] - e) < 1e-9
               for (i, *_), d in zip(kept, deviation) for c, e in enumerate(explained, 1))


# packing


def pieces_by_hand(rows, size):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    out = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out += [(i, k, at, len(ids[at: at + size]), zlib.crc32(np.array(ids[at: at + size], "<u4").tobytes())) for k, at in enumerate(range(0, len(ids), size))]
    return out


def best_fit(lengths, size):
    room, used = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(room, n)
        used += at == len(room)
        left = (room.pop(at) if at < len(room) else size) - n
        if left:
            bisect.insort(room, left)
    return used


def seated(got, size):
    """Sequences filled from 0 without gaps, none too long; their number."""
    of = {}
    for sequence, offset, length in got:
        of.setdefault(sequence, []).append((offset, length))
    for held in of.values():
        ends = [0] + list(np.cumsum([n for _, n in sorted(held)]))
        assert [o for o, _ in sorted(held)] == ends[:-1] and ends[-1] <= size
    return len(of)


def test_plan_is_best_fit_over_documents():
    for seed in range(150):
        r = random.Random(seed)
        size = r.choice([5, 16, 64])
        counts = Counter(r.randint(1, size) for _ in range(r.randint(1, 300)))
        runs, used = packing.plan(counts, size)
        slots = [(first + k // each, offset + k % each * n, n) for n, _, taken, first, each, offset in runs for k in range(taken)]
        assert seated(slots, size) == used == best_fit(counts.elements(), size)
        for n in counts:
            of = sorted((rank, taken) for length, rank, taken, *_ in runs if length == n)
            assert [rank for rank, _ in of] == [0, *np.cumsum([taken for _, taken in of])[:-1].tolist()] and sum(t for _, t in of) == counts[n]
    many = {n: 10**9 + n for n in range(1, 2049)}
    assert len(packing.plan(many)[0]) < 10_000  # does not grow with the documents


ODD_TEXTS = [None, "", " \n\t ", "a", "Straße café ñ 𝒳 ☃ 12 345", "it's we'll DON'T", "<|endoftext|> x <|startoftext|>", "x" * 5000, "a b c\x1cd\x85e", "é ́ ÅÅ İI ΑΣ Σ",
             "mixed\x0bwhite\x0cspace\rhere", "…—“quoted” 😀👍🏽 $$$%%% a.b.c"]


@pytest.mark.parametrize("bucket_rows", [1, 3, 1024])
def test_packing(spark, bucket_rows):
    r = random.Random(bucket_rows)
    rows = list(enumerate(ODD_TEXTS)) + [(100 + i, " ".join(r.choice(["word", "Two", "42", "naïve"]) for _ in range(r.randrange(30)))) for i in range(150)]
    rows += [(500 + i, "the same text") for i in range(60)] + [(7, "the same text")] * 5 + [(None, "no id"), (None, "no id"), (8, "shared one"), (8, "shared two"), (900, "long words " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).selectExpr("*", "1 AS id", "2 AS length", "3 AS lot", "'t' AS Text_", "0 AS rank")
    got = packing.packed(df, VOCABULARY, size=32, bucket_rows=bucket_rows).collect()
    want = pieces_by_hand(rows, 32)
    assert Counter((x["id"], x["piece"], x["start"], x["length"], x["crc"]) for x in got) == Counter(want)
    assert seated([(x["sequence"], x["offset"], x["length"]) for x in got], 32) == best_fit([n for *_, n, _ in want], 32)


def test_packing_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(df, VOCABULARY).collect() == []


def test_op12_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got, want = queries.QUERIES["op12_packing"](spark, SMALL).collect(), pieces_by_hand(rows, 2048)
    assert Counter((x["doc_id"], x["piece"], x["start"], x["length"], x["ids_crc32"]) for x in got) == Counter(want)
    assert seated([(x["sequence_id"], x["offset"], x["length"]) for x in got], 2048) == best_fit([n for *_, n, _ in want], 2048)


# hard negatives


def negatives_by_hand(rows, every, positives=5, negatives=10, scale=256):
    rows = [r for r in usable(rows) if r[0] is not None and r[2] is not None]
    width = max([len(v) for _, v, _ in rows], default=0)
    x = np.array([[math.floor(scale * c) for c in (*v, *[0.0] * (width - len(v)))] for _, v, _ in rows]).reshape(len(rows), width)
    ids, labels = np.array([i for i, *_ in rows]), np.array([k for *_, k in rows])
    out = []
    for a in {(i, k, tuple(v)): j for j, (i, v, k) in enumerate(rows) if i % every == 0}.values():
        scores = x @ x[a]
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[a]]
        for p in [j for j in order if labels[j] == labels[a]][:positives]:
            near = [j for j in order if labels[j] != labels[a] and 30 * scores[p] <= 100 * scores[j] <= 90 * scores[p]][:negatives]
            out += [(int(ids[a]), int(ids[p]), k, int(ids[j]), int(scores[p]), int(scores[j])) for k, j in enumerate(near, 1)]
    return Counter(out)


def found(df):
    return Counter((x["anchor_id"], x["positive_id"], x["rank"], x["negative_id"], x["positive_score"], x["negative_score"]) for x in df.collect())


@pytest.mark.parametrize(("tile_rows", "least"), [(16_384, 1), (20, 8), (150, 32)])
def test_hard_negatives(spark, tile_rows, least):
    r = np.random.default_rng(tile_rows)
    centres = r.normal(size=(5, 8))
    rows = [(i, f32(centres[i % 5] + centres[(i + 1) % 5] * (i % 3) + r.normal(size=8) * 0.3), i % 5) for i in range(600)]
    rows += [(1000 + i, rows[4][1], 0 if i % 2 else 3) for i in range(250)]  # a hot vector under two labels: ties
    rows += [(2000 + i, f32(centres[0] * 2), 4) for i in range(30)] + [(2001, f32(centres[0]), 1)] * 3  # repeated rows, a shared id
    rows += [(20, f32(centres[2]), 2), (20, f32(centres[2]), 2), (3000, f32([9.0]), 77), (3020, f32([-1.0, 0.5]), 2), (3040, [], 1), (3060, [0.0] * 8, 1)]
    rows += [(None, rows[0][1], 1), (40, None, 1), (60, rows[1][1], None), (80, [NAN] * 8, 1), (100, [1.0, None], 1), (120, [INF], 1)]
    got = found(rtree.hard_negatives(vectors(spark, rows), lambda i: i % 20 == 0, tile_rows=tile_rows, least_tiles=least))
    want = negatives_by_hand(rows, 20)
    assert sum(want.values()) > 500 and got == want


def test_hard_negatives_of_nothing(spark):
    assert rtree.hard_negatives(vectors(spark, []), lambda i: i % 2 == 0).count() == 0
    assert rtree.hard_negatives(vectors(spark, [(1, [1.0], 1)]), lambda i: i % 2 == 0).count() == 0
    assert rtree.hard_negatives(vectors(spark, [(2, [1.0], 1), (3, [1.0], 2)]), lambda i: i % 2 == 0).count() == 0


def test_boxes_bound_every_product_and_the_queue_prunes():
    r = np.random.default_rng(2)
    q, v = r.integers(-50, 50, (20, 6)), r.integers(-50, 50, (300, 6))
    order = rtree.str_order([v[:, 0], v[:, 1]], rtree.LEAF)
    assert sorted(order.tolist()) == list(range(300))
    tree = rtree.Tree(np.arange(300), np.zeros(300, np.int64), v[order])
    for level, boxes in enumerate(tree.levels):
        low, high = rtree.intervals(q, boxes.low, boxes.high)
        step = rtree.LEAF * rtree.FANOUT ** level
        for j in range(len(boxes.low)):
            s = q @ v[order][j * step: (j + 1) * step].T
            assert (low[:, j] <= s.min(axis=1)).all() and (s.max(axis=1) <= high[:, j]).all()
    # far apart clusters: an anchor scores its own leaf only
    v = np.repeat(np.eye(8, dtype=np.int64) * 1000, rtree.LEAF, axis=0) + r.integers(0, 3, (8 * rtree.LEAF, 8))
    tree, scored = rtree.Tree(np.arange(len(v)), np.zeros(len(v), np.int64), v), []
    plain = tree._score
    tree._score = lambda leaf, *rest: (scored.append(leaf), plain(leaf, *rest))
    tree.best_first(rtree.Queries(np.array([0]), np.array([0]), v[:1], np.full((1, 1), rtree.NONE + 1), np.full((1, 1), rtree.ALL)), 5, True)
    assert len(scored) == 1


def test_op13_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()
    moved = [(r["vec_id"], list(r["embedding"]), (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows]
    assert found(queries.QUERIES["op13_hard_negatives"](spark, sf)) == negatives_by_hand(moved, 100)
