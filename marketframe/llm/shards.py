"""Sharding by fixed virtual slots.

Records are hashed into thousands of slots whose number never changes. A
stored, versioned map says which shard holds a slot; rebalancing edits the map
and moves whole slots, never single records. All driver-side work is on the
slots, whose number is a constant.

Defined results: a null text counts no bytes (size 1, crc 0); a null id hashes
like any value; equal rows (same id and text) share a slot and get consecutive
positions; an empty table gives an empty result and the first map.
"""

from __future__ import annotations

import bisect
import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketframe.llm.common import pick, stored, text_or_empty

SLOTS = 4096


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """Size, checksum and virtual slot of each record: (id, size, crc, vslot)."""
    rows = pick(docs, id=id_col, text=text_col)
    text = text_or_empty("text")
    rows = rows.select("id", (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("crc"))
    return rows.withColumn("vslot", F.pmod(F.xxhash64("id", "size", "crc"), F.lit(slots)).cast("int"))


def slot_totals(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot. The answer has ``slots`` entries, however long the table."""
    got = rows.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).collect()
    sizes, counts = [0] * slots, [0] * slots
    for r in got:
        sizes[r["vslot"]], counts[r["vslot"]] = r["bytes"], r["n"]
    return sizes, counts


def first_map(shards: int, slots: int = SLOTS) -> list[int]:
    """Equal ranges of slots."""
    return [s * shards // slots for s in range(slots)]


def rebalance(assigned: list[int], sizes: list[int], shards: int, most_edits: int = 20_000) -> list[int]:
    """Edit a map until no single move or swap between the largest and the smallest shard evens them further.

    ``shards`` may exceed the number of shards in the map: new ones start empty
    and only receive.
    """
    assigned = list(assigned)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(assigned):
        held[shard].append((sizes[slot], slot))
    for rows in held:
        rows.sort()
    total = [sum(size for size, _ in rows) for rows in held]
    for _ in range(most_edits):
        high, low = max(range(shards), key=total.__getitem__), min(range(shards), key=total.__getitem__)
        gap = total[high] - total[low]
        move = _closest(held[high], gap / 2, gap)
        swap = _closest_swap(held[high], held[low], gap) if move is None or abs(2 * move[0] - gap) > 2 else None
        if move is None and swap is None:
            break
        if swap is None or (move is not None and abs(2 * move[0] - gap) <= abs(2 * (swap[0][0] - swap[1][0]) - gap)):
            out, back = move, None
        else:
            out, back = swap
        for item, source, target in ((out, high, low), (back, low, high)):
            if item is not None:
                held[source].remove(item)
                bisect.insort(held[target], item)
                assigned[item[1]] = target
                total[source] -= item[0]
                total[target] += item[0]
    return assigned


def _closest(rows: list[tuple[int, int]], goal: float, below: int) -> tuple[int, int] | None:
    """The slot whose size is nearest to ``goal``, above nothing and below ``below``."""
    at = bisect.bisect_left(rows, (goal, -1))
    found = [r for r in rows[max(0, at - 1): at + 1] if 0 < r[0] < below]
    return min(found, key=lambda r: abs(r[0] - goal), default=None)


def _closest_swap(high: list[tuple[int, int]], low: list[tuple[int, int]], gap: int):
    """A slot of each side whose exchange moves about half the gap."""
    best = None
    for small in low:
        if (large := _closest(high, small[0] + gap / 2, small[0] + gap)) is None or large[0] <= small[0]:
            continue
        off = abs(2 * (large[0] - small[0]) - gap)
        if off < gap and (best is None or off < best[0]):
            best = (off, large, small)
            if off <= 1:
                break
    return best and best[1:]


def grow(assigned: list[int], sizes: list[int], shards: int) -> list[int]:
    """Add one shard: the largest shards give slots to the new one until it holds its share; no other slot moves."""
    assigned = list(assigned)
    total = [0] * (shards + 1)
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, shard in enumerate(assigned):
        total[shard] += sizes[slot]
        held[shard].append((sizes[slot], slot))
    for rows in held:
        rows.sort()
    goal = sum(total) / (shards + 1)
    heap = [(-total[s], s) for s in range(shards)]
    heapq.heapify(heap)
    while heap and total[shards] < goal:
        _, shard = heapq.heappop(heap)
        if (slot := _closest(held[shard], goal - total[shards], int(2 * (goal - total[shards])) + 1)) is None:
            continue
        held[shard].remove(slot)
        assigned[slot[1]] = shards
        total[shard] -= slot[0]
        total[shards] += slot[0]
        heapq.heappush(heap, (-total[shard], shard))
    return assigned


def save_map(spark: SparkSession, path: str, version: int, assigned: list[int]) -> None:
    """Store a version of the map. A version is written once; a failed write leaves no partial version behind."""
    text = ",".join(map(str, assigned))
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "shard"))
    rows.select("slot", F.col("shard").cast("int").alias("shard")).coalesce(1).write.mode("error").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> list[int]:
    return [r["shard"] for r in spark.read.parquet(f"{path}/version={version}").orderBy("slot").collect()]


def looked_up(values: list[int], index: Column) -> Column:
    """``values[index]`` as an expression: a constant array, whose length is the number of slots."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ","), index).cast("long")


def assign(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", map_path: str | None = None,
           slots: int = SLOTS) -> DataFrame:
    """Shard, virtual slot and position within the shard of every record: (id, size, crc, vslot, shard, position).

    Version 1 of the map gives equal ranges of slots; version 2 evens the bytes
    that were measured. Both are stored below ``map_path`` when one is given.
    Positions count 0, 1, 2, … within a shard: slots have known row counts, so a
    slot's offset is a constant and rows are numbered within their slot only.
    """
    spark = docs.sparkSession
    rows = stored(records(docs, id_col, text_col, slots), "shard-records")
    sizes, counts = slot_totals(rows, slots)
    before = first_map(shards, slots)
    now = rebalance(before, sizes, shards)
    if map_path:
        save_map(spark, map_path, 1, before)
        save_map(spark, map_path, 2, now)
        now = load_map(spark, map_path, 2)
    offset, used = [0] * slots, [0] * shards
    for s, shard in enumerate(now):
        offset[s] = used[shard]
        used[shard] += counts[s]
    # equal records are counted first, so that any number of them is one row here
    same = rows.groupBy("vslot", "id", "size", "crc").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("vslot").orderBy("id", "size", "crc").rowsBetween(Window.unboundedPreceding, -1)
    numbered = same.withColumn("first", F.coalesce(F.sum("n").over(order), F.lit(0)) + looked_up(offset, F.col("vslot")))
    numbered = numbered.withColumn("position", F.explode(F.sequence("first", F.col("first") + F.col("n") - 1)))
    return numbered.select("id", "size", "crc", "vslot", looked_up(now, F.col("vslot")).cast("int").alias("shard"), "position")
