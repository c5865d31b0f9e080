"""SimHash near-duplicates by one-wildcard segment variants.

Fingerprints of 64 bits are cut into two segments of 32. Of two fingerprints
that differ in at most three bits, one segment differs in at most one, so both
share the variant of that segment with the differing bit wiped out. Each
fingerprint therefore has 64 variants; equal variants meet in a run of a
sorted partition, and members of a run are compared on all 64 bits.

A run gives the edges of a spanning forest, never all its pairs. A run of more
than ``MAX_RUN`` members is never gathered: its members are dealt again by the
variants of the other segment, cut into two halves of 16 bits of which again
one differs in at most one bit. What still meets then agrees in all but 17
bits, so the second level is bounded by the width of a fingerprint.

Groups are the connected components of the links, found by star contraction
with every round written to the shared folder.

Defined results: null and empty texts have no words and fingerprint zero, and
link like any others; equal rows fall into one group; null ids count as one id
and never name a group that has another; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from pyspark.sql.functions import pandas_udf

from marketframe.llm.common import pick, stored

SEED, MAX_BITS, MAX_RUN = 42, 3, 4096
CHUNK = 1 << 16
# In short runs every pair is compared; in longer ones a spanning forest is grown.
SHORT_RUN = 8


def shingle_hashes(text: str | None, width: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle of a whole text, repeats included; of all words together where they are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    count = max(1, len(words) - width + 1)
    starts = np.concatenate(([0], ends[: count - 1])).tolist()
    stops = (ends[min(width, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops)), np.uint64, count)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half the hashes, as a signed 64-bit number."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = np.ascontiguousarray(hashes[i: i + CHUNK], dtype="<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_of(width: int, seed: int = SEED) -> Callable[[Column], Column]:
    """Arrow-batched function text -> fingerprint over word shingles."""
    @pandas_udf(LongType())
    def fingerprint(texts):
        import pandas as pd

        return pd.Series([majority(shingle_hashes(t, width, seed)) for t in texts], dtype="int64")
    return fingerprint


def hex_of(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def variants(points: DataFrame) -> DataFrame:
    """64 keyed rows for each fingerprint: (key, …columns of points)."""
    kept = points.columns
    at = points.withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(63))))
    half = F.expr("CASE WHEN _v < 32 THEN fp & 4294967295L ELSE shiftrightunsigned(fp, 32) END")
    key = half.bitwiseAND(F.expr("~shiftleft(1L, _v % 32)")).bitwiseOR(F.expr("shiftleft(CAST(_v AS BIGINT), 32)"))
    return at.select(key.alias("key"), *kept)


def second_variants(over: DataFrame) -> DataFrame:
    """32 keyed rows for each member of a long run, on the segment its key leaves free."""
    kept = [c for c in over.columns if c != "key"]
    at = over.withColumn("_w", F.explode(F.sequence(F.lit(0), F.lit(31))))
    free = F.expr("CASE WHEN shiftright(key, 32) < 32 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L END")
    at = at.withColumn("_free", free)
    half = F.expr("CASE WHEN _w < 16 THEN _free & 65535L ELSE shiftrightunsigned(_free, 16) END & ~shiftleft(1L, _w % 16)")
    return at.select(F.xxhash64("key", "_w", half).alias("key"), *kept)


def _forest(fp: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges (i, j) of a minimum spanning forest of the pairs within ``most`` bits."""
    best, parent = np.full(len(fp), 255, np.uint8), np.full(len(fp), -1, np.int64)
    left = np.ones(len(fp), bool)
    edges = []
    for _ in range(len(fp)):
        rest = np.flatnonzero(left)
        i = int(rest[best[rest].argmin()])
        if best[i] < 255:
            edges.append((int(parent[i]), i))
        left[i] = False
        rest = rest[rest != i]
        weight = np.bitwise_count(fp[rest] ^ fp[i])
        weight[weight > most] = 255
        closer = weight < best[rest]
        best[rest[closer]], parent[rest[closer]] = weight[closer], i
    return edges


def _run_links(key: np.ndarray, fp: np.ndarray, most: int) -> np.ndarray:
    """Links (larger, smaller) of whole runs of equal keys, given in key order."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(key)])))
    size_at = np.repeat(sizes, sizes)
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lag in range(1, SHORT_RUN):
        at = np.flatnonzero((key[lag:] == key[:-lag]) & (size_at[lag:] <= SHORT_RUN))
        at = at[np.bitwise_count(fp[at] ^ fp[at + lag]) <= most]
        a.append(at)
        b.append(at + lag)
    for s, n in zip(starts[sizes > SHORT_RUN].tolist(), sizes[sizes > SHORT_RUN].tolist()):
        if found := _forest(fp[s: s + n], most):
            i, j = np.array(found).T
            a.append(s + i)
            b.append(s + j)
    a, b = (fp.view(np.int64)[np.concatenate(x)] for x in (a, b))
    pairs = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b))), axis=1)
    return pairs[:, pairs[0] != pairs[1]]


def _links_of(most: int, max_run: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Streams over sorted runs; yields links (a, b, key null), and members of long runs as (a=fp, b null, key)."""
    def passed_on(fp, key):
        return pa.RecordBatch.from_arrays([pa.array(fp), pa.nulls(len(fp), pa.int64()), pa.array(key)], names=["a", "b", "key"])

    def finished(key, fp):
        """Links of whole runs; those over the limit are passed on."""
        if max_run is not None and len(key):
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.concatenate((starts, [len(key)])))
            over = np.repeat(sizes > max_run, sizes)
            if over.any():
                yield passed_on(fp[over], key[over])
                key, fp = key[~over], fp[~over]
        if len(key) and (pairs := _run_links(key, fp.view(np.uint64), most)).shape[1]:
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.nulls(pairs.shape[1], pa.int64())], names=["a", "b", "key"])

    def run(batches):
        held, passing = (np.zeros(0, np.int64), np.zeros(0, np.int64)), None
        for batch in batches:
            key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if passing is not None:  # members of a run that is already too long
                n = int(np.searchsorted(key != passing, True))
                if n:
                    yield passed_on(fp[:n], key[:n])
                    key, fp = key[n:], fp[n:]
                if len(key):
                    passing = None
            if not len(key):
                continue
            key, fp = np.concatenate((held[0], key)), np.concatenate((held[1], fp))
            last = int(np.searchsorted(key == key[-1], True))
            yield from finished(key[:last], fp[:last])
            held = key[last:], fp[last:]
            if max_run is not None and len(held[0]) > max_run:
                yield passed_on(held[1], held[0])
                passing, held = held[0][0], (np.zeros(0, np.int64), np.zeros(0, np.int64))
        yield from finished(*held)
    return run


def links(points: DataFrame, most: int = MAX_BITS, max_run: int = MAX_RUN) -> DataFrame:
    """Links (a, b), a > b, that connect all fingerprints (column fp) within ``most`` (at most 3) bits of each other."""
    if not 0 <= most <= 3:
        raise ValueError("two segments with one wildcard find up to 3 differing bits")

    def met(rows: DataFrame, limit: int | None) -> DataFrame:
        dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
        return dealt.mapInArrow(_links_of(most, limit), "a long, b long, key long")

    first = stored(met(variants(points.select("fp")), max_run), "simhash-runs")
    pairs = first.where(F.col("key").isNull()).select("a", "b")
    over = first.where(F.col("key").isNotNull())
    if not over.isEmpty():
        pairs = pairs.unionByName(met(second_variants(over.select("key", F.col("a").alias("fp"))), None).select("a", "b"))
    return pairs.distinct()


def components(pairs: DataFrame) -> DataFrame:
    """Smallest node of each node's component, (node, root), for all nodes of links (a, b).

    Alternating star contraction: first every larger neighbour, then every
    smaller one, is tied to the smallest neighbour. Rounds grow with the
    logarithm of the graph; each is written to the shared folder.
    """
    def large(edges: DataFrame) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        return both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()

    def small(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("w"), "m")
        tied = edges.join(least, F.col("a") == F.col("w")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return tied.unionByName(least.select(F.col("w").alias("a"), F.col("m").alias("b"))).distinct()

    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    edges = stored(pairs.where("a > b").distinct(), "links")
    seen = mark(edges)
    while seen[0]:
        edges = stored(small(large(edges)), "links")
        if (now := mark(edges)) == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = MAX_BITS,
           max_run: int = MAX_RUN) -> DataFrame:
    """Fingerprint and group of every document: (id, name, fp, root, group), one row for each of ``docs``.

    ``name`` is a hash of the text; ``root`` names the component, ``group`` is
    the smallest id in it.
    """
    rows = pick(docs, id=id_col, text=text_col)
    marked = stored(rows.select("id", F.xxhash64("text").alias("name"), fingerprint_of(width)(F.col("text")).alias("fp")), "fingerprints")
    points = stored(marked.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    roots = components(links(points, most, max_run))
    named = points.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    group = named.groupBy("root").agg(F.min("first").alias("group"))
    of_point = named.join(group.withColumnRenamed("root", "r"), F.col("root") == F.col("r")).select(F.col("fp").alias("p"), "root", "group")
    return marked.join(of_point, F.col("fp") == F.col("p")).select("id", "name", "fp", "root", "group")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group, the one with the smallest id; all columns kept.

    Of texts that share that id the one whose name is smallest stays, of rows
    that repeat both id and text one; a group whose ids are all null keeps one
    of its rows. Null and empty texts have names of their own but one
    fingerprint, so one of them stays.
    """
    names = docs.columns
    found = stored(groups(docs, id_col, text_col, **options).groupBy("root", "id", "name").agg(F.count(F.lit(1)).alias("n")), "simhash-groups")
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "name", "n")).alias("best"))
    stays = stored(best.select(F.col("best.id").alias("_id"), F.col("best.name").alias("_name"), F.col("best.n").alias("_n")), "simhash-first")

    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    own, text = (f"_c{names.index(c)}" for c in (id_col, text_col))
    flat = flat.withColumn("_at", F.xxhash64(text))
    on = F.col(own).eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_name"))
    once, often = stays.where("_n = 1"), stays.where("_n > 1")
    left = flat.join(once, on, "left_semi")
    if not often.isEmpty():  # rows that repeat both id and text: one of them
        left = left.unionByName(flat.join(often, on, "left_semi").dropDuplicates([own, "_at"]))
    return left.drop("_at").toDF(*names)
