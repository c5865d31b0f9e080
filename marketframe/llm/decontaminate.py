"""Benchmark decontamination by spaced seeds.

Fixed masks select some token positions of a short span and ignore the others.
Equal masked hashes of test items and documents are hits; around each hit the
whole item is laid beside the document, and the item counts as leaked when some
window of it agrees in most positions. A substituted token falls into ignored
positions of some mask, so it does not hide a passage. Masks are added for
short items and bare windows until every placement of as many substitutions as
verification allows leaves some mask whole.

Only DataFrame functions; tokens travel as 64-bit hashes.

Defined results: null and empty texts have no tokens and no hits; items of
fewer than ``MIN_ITEM`` tokens are too common to prove anything and never
match; equal items each count; documents are told apart by id and text, so
that one which shares its id, or has none, is judged by its own text; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import pick, text_or_empty

# Seeds: 1 is compared, 0 is ignored. Six of eight to eleven positions count.
MASKS = ("11101011", "110110011", "10110100101")
# Items shorter than the longest mask need masks of their own length.
MIN_ITEM, WINDOW, AGREE = 5, 13, 0.8
# Positions an added mask compares at least where the tolerance lets it; most placements that are enumerated.
LEAST_COMPARED, PLACEMENTS = 6, 100_000
# Most seeds that are sent to every executor (24 bytes each); more are joined by a shuffle.
BROADCAST_SEEDS = 500_000


def tokens_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text_or_empty(text)), r"[^\p{L}\p{N}]+"), "")


def name_of(text: Column) -> Column:
    return F.xxhash64(text_or_empty(text))


def hashed(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _needed(size: int, agree: float) -> int:
    """Positions of a span that must agree."""
    return math.ceil(size * agree)


def missed(size: int, masks: Sequence[str], agree: float = AGREE) -> list[set[int]]:
    """Placements of all allowed substitutions in a span of ``size`` tokens that leave no mask whole anywhere in it."""
    spots = {frozenset(at + i for i, bit in enumerate(m) if bit == "1") for m in masks for at in range(size - len(m) + 1)}
    return [set(p) for p in itertools.combinations(range(size), size - _needed(size, agree)) if not any(s.isdisjoint(p) for s in spots)]


def more_masks(size: int, masks: Sequence[str], agree: float = AGREE) -> tuple[str, ...]:
    """Masks that, with ``masks``, miss no placement of the allowed substitutions."""
    wrong = size - _needed(size, agree)
    if math.comb(size, wrong) > PLACEMENTS:  # of wrong + 1 pieces one has no substitution
        return ("1" * (size // (wrong + 1)),)
    left, added = missed(size, masks, agree), []
    while left:
        ignored = set(left[0])
        while len(ignored) < size - LEAST_COMPARED:
            ignored.add(max(set(range(size)) - ignored, key=lambda i: sum(p <= ignored | {i} for p in left) + 0.01 * sum(i in p for p in left)))
        added.append("".join("0" if i in ignored else "1" for i in range(size)).strip("0"))  # its span only: a text may end before the item does
        left = [p for p in left if not p <= ignored]
    return tuple(added)


def _seed(mask: str, tokens: str, pos: Column) -> Column:
    """Hash of the compared positions, null where the span leaves the text."""
    compared = [F.get(F.col(tokens), pos + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.when(pos + len(mask) <= F.size(tokens), F.xxhash64(F.lit(mask), *compared))


def seeds(df: DataFrame, tokens: str, masks: tuple[str, ...], least: int) -> DataFrame:
    """Every masked hash of every position: the columns of ``df`` with pos and seed."""
    at = df.where(F.size(tokens) >= least).withColumn("pos", F.explode(F.sequence(F.lit(0), F.size(tokens) - least)))
    found = at.withColumn("seed", F.explode(F.array(*[_seed(m, tokens, F.col("pos")) for m in masks])))
    return found.where(F.col("seed").isNotNull())


def agreement(item: Column, doc: Column, shift: Column, window: int = WINDOW) -> Column:
    """Most equal positions in any window of the item (the whole item if shorter), laid on the document at ``shift``."""
    equal = F.transform(item, lambda t, j: (t == F.get(doc, F.when(shift + j >= 0, shift + j))).cast("int"))
    equal = F.transform(equal, lambda x: F.coalesce(x, F.lit(0)))
    width = F.least(F.size(item), F.lit(window))
    starts = F.sequence(F.lit(1), F.size(item) - width + 1)
    sums = F.transform(starts, lambda s: F.aggregate(F.slice(equal, s, width), F.lit(0), lambda a, x: a + x))
    return F.array_max(sums)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", masks: tuple[str, ...] = MASKS, window: int = WINDOW, agree: float = AGREE) -> DataFrame:
    """One row per document: (id, at, n_tokens, items), ``at`` the name of its text and items the sorted ids of the items whose passages it holds.

    Two passes over the documents. The first looks every masked hash up among
    the items' hashes (sent to all executors when few, by count; else joined by
    shuffle) and keeps distinct (document, item, shift). The second gives
    documents their few shifts and verifies in place.
    """
    test = pick(items, item=item_col, text=item_text).select("item", hashed(tokens_of(F.col("text"))).alias("words"))
    test = test.where(F.size("words") >= MIN_ITEM)
    longest = max(map(len, masks))
    sizes = sorted(r[0] for r in test.where(F.size("words") < window).select(F.size("words")).distinct().collect())  # few lengths below the window
    corpus = pick(docs, id=id_col, text=text_col).select("id", name_of(F.col("text")).alias("at"), hashed(tokens_of(F.col("text"))).alias("words"))

    spans = min(map(len, masks))
    wanted = seeds(test, "words", masks, spans)
    found = seeds(corpus, "words", masks, spans)
    for n in sizes:  # items below the longest mask: all their tokens, and all but one; and what else their tolerance needs
        own = tuple(("1" * i + "0" + "1" * (n - i - 1)).strip("0") for i in range(n)) + ("1" * n,) if n < longest else ()
        if own := own + more_masks(n, masks + own, agree):
            least = min(map(len, own))
            wanted = wanted.unionByName(seeds(test.where(F.size("words") == n), "words", own, least))
            found = found.unionByName(seeds(corpus, "words", own, least))
    if bare := more_masks(window, masks, agree):  # windows of longer items
        least = min(map(len, bare))
        wanted = wanted.unionByName(seeds(test.where(F.size("words") >= window), "words", bare, least))
        found = found.unionByName(seeds(corpus, "words", bare, least))
    wanted = wanted.select("seed", "item", F.col("pos").alias("item_pos")).distinct()
    if wanted.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS:
        wanted = F.broadcast(wanted)
    hits = found.select("id", "at", "pos", "seed").join(wanted, "seed").select("id", "at", "item", (F.col("pos") - F.col("item_pos")).alias("shift"))
    lain = hits.distinct().join(test.withColumnRenamed("item", "of"), F.col("item").eqNullSafe(F.col("of")))
    lain = lain.groupBy(F.col("id").alias("hit_id"), F.col("at").alias("hit_at")).agg(F.collect_list(F.struct("item", "shift", F.col("words").alias("item_words"))).alias("lain"))

    both = corpus.join(lain, F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("at") == F.col("hit_at")), "left")
    need = lambda item: F.ceil(F.least(F.size(item), F.lit(window)) * F.lit(agree))
    proven = F.filter("lain", lambda x: agreement(x["item_words"], F.col("words"), x["shift"], window) >= need(x["item_words"]))
    ids = F.array_sort(F.array_distinct(F.transform(F.coalesce(proven, F.array()), lambda x: x["item"])))
    return both.select("id", "at", F.size("words").cast("long").alias("n_tokens"), ids.alias("items"))


def remove_leaked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Documents that hold no item; all columns kept. Documents that share an id are judged each by its own text."""
    found = leaks(docs, items, id_col, text_col, **options)
    leaked = found.where(F.size("items") > 0).select("id", "at")
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    on = F.col(f"_c{names.index(id_col)}").eqNullSafe(F.col("_leaked")) & (name_of(F.col(f"_c{names.index(text_col)}")) == F.col("_leaked_at"))
    return flat.join(leaked.toDF("_leaked", "_leaked_at").distinct(), on, "left_anti").toDF(*names)
