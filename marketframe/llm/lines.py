"""Line dedup by a segment-partition edit join.

A line is dropped when the same line, or one within ``EDITS`` character edits,
stands earlier in the corpus (by document id, then text, then line number).
Lines are cut into EDITS + 1 segments; if two lines are that close, one segment
of the shorter stands unchanged in the longer, shifted by no more than the edits
before it allow. So every line is indexed by (length, number, text) of its
segments and probes with the few substrings that can match a segment of a line
as long or up to EDITS shorter. Equal keys meet in a join; candidates that
letter counts do not tell apart are verified by a bit-parallel automaton over
the band of diagonals that EDITS edits can reach.

A key that more than ``CROWD`` lines are indexed by (near copies, templates) is
told apart further, so that its pairs do not grow with the square of its lines.
All of them are compared with the earliest; lines now known to be near an
earlier one need no other. If more than ``CROWD`` are left, the edits of a pair
lie in the EDITS other segments, thus in EDITS of their halves: what lies outside
is the next key, halves after halves.

Only DataFrame functions. Keys are hashes worked out where a line is read, so
equal lines become one row of numbers before anything is joined; texts are
shuffled for lines in candidate pairs and crowds alone. Up to ``BROADCAST_ROWS``
names of such lines, counted, are sent to the tasks that read the lines; more are joined.

Defined results: lines are compared without blanks around them; blank lines
are neither counted nor dropped; lines shorter than ``LEAST`` characters are
compared for equality only; null and empty texts have no lines; rows that share
an id, or have none, are told apart by their texts, and rows that repeat both
are one document, so a line at the same place of each counts as first in each;
null ids come last; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import pick, stored, text_or_empty

EDITS, LEAST = 2, 20
BROADCAST_ROWS = 200_000
CROWD = 64
BLANKS = " \t\r\x0b\f"
# Counts of these letters, modulo 4, tell most candidates apart: an edit changes them by two together at most.
LETTERS = "enaitrsodluhcmpg"


def text_name(text: Column) -> Column:
    """60 bits of a checksum: tells documents that share an id apart; null and empty texts are one."""
    return F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")


def place_of(*columns: str) -> Column:
    """What lines are ordered by: document id (null ids last), name of the text, line number, and what follows."""
    return F.struct(F.col(columns[0]).isNull().alias("none"), *columns)


def trimmed(c: Column) -> Column:
    """Text without blanks around it; one that has none is not looked through."""
    ends = [end(c, F.lit(blank)) for end in (F.startswith, F.endswith) for blank in BLANKS]
    return F.when(reduce(Column.__or__, ends), F.btrim(c, F.lit(BLANKS))).otherwise(c)


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marked: bool = False) -> DataFrame:
    """Non-blank lines with two hashes: (id, name, line_no, line, h1, h2). Line numbers count from 0, blank lines too.

    ``marked`` adds a row with line number -1 and no line for each document.
    """
    rows = pick(docs, id=id_col, text=text_col)
    rows = rows.select("id", "text", text_name(F.col("text")).alias("name"))  # once a document, not once a line
    parts = F.split(text_or_empty("text"), "\n")
    parts = F.concat(parts, F.array(F.lit(None).cast("string"))) if marked else parts
    rows = rows.select("id", "name", F.posexplode(parts).alias("line_no", "raw"))
    rows = rows.select("id", "name", "line_no", trimmed(F.col("raw")).alias("line"))
    if not marked:
        rows = rows.where("line <> ''")
        return rows.withColumns({"h1": F.xxhash64("line"), "h2": F.hash("line")})
    mark = F.col("line").isNull()
    rows = rows.where(mark | (F.col("line") != "")).withColumn("line_no", F.when(mark, -1).otherwise(F.col("line_no")))
    # documents' own rows lie apart, not under the hash of a null
    return rows.withColumns({"h1": F.when(mark, F.xxhash64("id", "name")).otherwise(F.xxhash64("line")), "h2": F.hash("line")})


def with_cuts(rows: DataFrame, edits: int) -> DataFrame:
    """Columns ``_cut{shorter}_{i}``: where segment ``i`` of a line ``shorter`` characters shorter begins. Segments are even parts; the last cut is that line's end."""
    parts = edits + 1
    at = lambda shorter, i: F.call_function("div", (F.col("size") - shorter) * i, F.lit(parts)).cast("int")
    return rows.withColumns({f"_cut{shorter}_{i}": at(shorter, i) for shorter in range(parts) for i in range(1, parts + 1)})


def _key(shorter: int, i: int, shift: int, edits: int, least: int) -> Column:
    """Key of the substring that can be segment ``i`` of a line ``shorter`` characters shorter, ``shift`` further on; null where there is none.

    Reads line, size (at least ``least``) and the cuts. What holds for all such
    sizes is settled here, so that the expression stays small enough for the JVM to compile.
    """
    begin = F.lit(0) if i == 0 else F.col(f"_cut{shorter}_{i}")
    end, length = F.col(f"_cut{shorter}_{i + 1}"), F.col(f"_cut{shorter}_{edits + 1}")
    key = F.xxhash64(length, F.lit(i), F.substring(F.col("line"), begin + (shift + 1), end - begin))
    behind = (edits - i) * ((least - shorter) // (edits + 1))  # characters after the segment, at the least
    there = [length >= least] if shorter else []
    there += [begin + shift >= 0] if shift < 0 else []
    there += [end + shift <= F.col("size")] if shift > shorter + behind else []
    return F.when(reduce(Column.__and__, there), key) if there else key


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(shorter, segment, shift) of all substrings to look up. Lines of equal length probe each other, so of two opposite shifts one will do."""
    out = []
    for shorter in range(edits + 1):
        for i in range(edits + 1):
            # edits before the segment shift it by at most i, those after it by at most the rest
            for shift in range(max(-i if shorter else 0, shorter - (edits - i)), min(i, shorter + (edits - i)) + 1):
                out.append((shorter, i, shift))
    return out


def with_letter_counts(rows: DataFrame) -> DataFrame:
    """A column ``counts``: counts of ``LETTERS`` in ``line`` modulo 4, two bits each. A letter that is counted is taken out, so that the next one looks through less."""
    rest = [F.col("line"), *[F.col(f"_without{i}") for i in range(len(LETTERS))]]
    packed, columns = F.lit(0), rows.columns
    for i, letter in enumerate(LETTERS):
        rows = rows.withColumn(f"_without{i}", F.replace(rest[i], F.lit(letter), F.lit("")))
        packed = packed.bitwiseOR(F.shiftleft((F.octet_length(rest[i]) - F.octet_length(rest[i + 1])) % 4, 2 * i))
    return rows.select(*columns, packed.alias("counts"))


def may_be_close(a: Column, b: Column, edits: int) -> Column:
    """False only where letter counts prove more than ``edits`` edits."""
    apart = F.lit(0)
    for i in range(len(LETTERS)):
        nibble = lambda c: F.shiftright(c, 2 * i).bitwiseAND(F.lit(3))  # noqa: B023, E731
        gap = F.abs(nibble(a) - nibble(b))
        apart = apart + F.least(gap, F.lit(4) - gap)
    return apart <= 2 * edits


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def without_prefix(a: Column, b: Column) -> Column:
    """Both texts without what they begin with alike, as lists of characters: a struct (a, b)."""
    least = F.least(F.length(a), F.length(b))
    most = F.floor(F.log2(least + 1)).cast("int")
    steps = F.transform(F.sequence(F.lit(0), most), lambda k: F.pow(F.lit(2.0), most - k).cast("int"))
    equal = lambda at, step: F.substring(a, at + 1, step) == F.substring(b, at + 1, step)
    alike = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= least) & equal(at, step), at + step).otherwise(at))
    letters = lambda c, at: F.filter(F.split(F.substring(c, at + 1, F.length(c)), ""), lambda x: x != "")
    return bound(alike, lambda at: F.struct(letters(a, at).alias("a"), letters(b, at).alias("b")))


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two texts are within ``edits`` (0 to 3) edits: a banded bit-parallel automaton.

    After i characters of ``a``, bit d + edits of field e says that e edits can
    make them the first i + d characters of ``b``. All fields and diagonals of
    the band lie in one long and take a character in a few bit operations. What
    both texts begin with is passed over first, and a pair whose bits are all
    gone costs nothing more.
    """
    if not 0 <= edits <= 3:
        raise ValueError("the fields of 0 to 3 edits fit into 64 bits")
    width, field = 2 * edits + 1, 3 * edits + 2
    each = sum(1 << field * e for e in range(edits + 1))
    band = F.lit(each * ((1 << width) - 1)).cast("long")

    def added(state: Column) -> Column:
        """Characters of b put in: one diagonal and one edit further, up to the last field."""
        reached = state
        for t in range(1, edits + 1):
            reached = reached.bitwiseOR(F.shiftleft(state, t * (field + 1)).bitwiseAND(band))
        return reached

    def close(rest: Column) -> Column:
        def taken(state: Column, i: Column) -> Column:
            equal = F.lit(0)
            for p in range(width):
                equal = equal + F.when(F.get(rest["b"], i + (p - edits)) == F.get(rest["a"], i), F.lit(1 << p)).otherwise(F.lit(0))
            now = added(state)
            replaced = F.shiftleft(now, field)
            kept = now.bitwiseAND(equal * F.lit(each).cast("long"))
            return F.when(state == 0, state).otherwise(kept.bitwiseOR(replaced).bitwiseOR(F.shiftright(replaced, 1)).bitwiseAND(band))
        n, m = F.size(rest["a"]), F.size(rest["b"])
        start = F.lit(1 << edits).cast("long")
        state = F.when(n == 0, start).otherwise(F.aggregate(F.sequence(F.lit(0), n - 1), start, taken))
        return F.call_function("shiftright", added(state), m - n + edits).bitwiseAND(F.lit(each).cast("long")) != 0

    far = F.abs(F.length(a) - F.length(b)) > edits
    return F.coalesce(F.when(far, False).otherwise(bound(without_prefix(a, b), close)), F.lit(False))


def line_numbers(lines: DataFrame, edits: int, least: int) -> DataFrame:
    """One row (h1, size, counts, k0, k1, ...) for each different line that is long enough: its letter counts and keys."""
    rows = with_letter_counts(lines.select("h1", "line", F.length("line").alias("size")).where(F.col("size") >= least))
    keys = [_key(*place, edits, least).alias(f"k{n}") for n, place in enumerate(probes(edits))]
    numbers = with_cuts(rows, edits).select("h1", "size", "counts", *keys)
    # equal lines have equal numbers
    return numbers.groupBy("h1").agg(*[F.max(c).alias(c) for c in numbers.columns[1:]])


def keys_of(numbers: DataFrame, edits: int, cells: bool = False) -> DataFrame:
    """A row (key, own, h1, counts) for each key of a line; ``own``: of its own segments.

    ``cells`` adds the length of the indexed line and the blocks beside the segment, c0, c1, ...
    """
    each = []
    for n, (shorter, i, shift) in enumerate(probes(edits)):
        beside = [F.lit(x).cast("long").alias(f"c{m}") for m, x in enumerate(x for x in range(edits + 1) if x != i)]
        more = [(F.col("size") - shorter).alias("length"), *beside] if cells else []
        each.append(F.struct(F.lit(shorter == shift == 0).alias("own"), F.col(f"k{n}").alias("key"), *more))
    return numbers.select("h1", "counts", F.inline(F.array(*each))).where("key IS NOT NULL")


def small(table: DataFrame) -> DataFrame:
    """A stored table, broadcast if it has up to ``BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def crowds(keys: DataFrame) -> DataFrame:
    """Keys that more than ``CROWD`` rows have, whatever the rows."""
    return keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("key")


def met(hosts: DataFrame, keys: DataFrame, edits: int) -> DataFrame:
    """Pairs of names (a, b) of different lines that share a key, own to one of them, and whose letter counts may be close."""
    named = lambda rows, x: rows.select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("own", "h1", "counts")])
    pairs = named(hosts, "a").join(named(keys, "b"), "key").where((F.col("h1_a") != F.col("h1_b")) & (F.col("own_a") | F.col("own_b")))
    pairs = pairs.where(may_be_close(F.col("counts_a"), F.col("counts_b"), edits))
    return pairs.select(F.least("h1_a", "h1_b").alias("a"), F.greatest("h1_a", "h1_b").alias("b")).distinct()


def later_lines(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """Names (h1) of the lines that are within ``edits`` edits of the other one of a pair and come first later than it."""
    side = lambda x: texts.select(F.col("h1").alias(x), F.col("line").alias(f"line_{x}"), F.col("place").alias(f"place_{x}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b")
    # lines that come first at one place (rows that share an id and a text) both stay
    pairs = pairs.where((F.col("place_a") != F.col("place_b")) & within(F.col("line_a"), F.col("line_b"), edits))
    return pairs.select(F.when(F.col("place_a") > F.col("place_b"), F.col("a")).otherwise(F.col("b")).alias("h1")).distinct()


def paths(edits: int) -> list[tuple[int, ...]]:
    """By how much the text behind each of ``edits`` blocks that hold all edits can be shifted; the last is the difference in length.

    Lines of equal length probe each other, so only the side that sees an insertion first needs to be covered.
    """
    steps = lambda path: sum(abs(x - y) for x, y in zip(path, (0, *path[:-1])))  # noqa: E731, B905
    found = itertools.product(range(-edits, edits + 1), repeat=edits)
    return [p for p in found if p and p[-1] >= 0 and steps(p) <= edits and (p[-1] or min(p) >= 0)]


def finer_keys(cells: DataFrame, texts: DataFrame, parts: int, edits: int) -> DataFrame:
    """Keys, as ``keys_of`` gives them, of all that lies outside ``edits`` of ``parts`` blocks: of the cells of lines at half as many blocks.

    Edits that lie in ``edits`` blocks lie in as many of their halves.
    """
    names = [f"c{m}" for m in range(edits)]
    halves = lambda chosen: [(F.col(names[m // 2]) * 2 + m % 2).alias(name) for name, m in zip(names, chosen, strict=True)]
    split = F.inline(F.array(*[F.struct(*halves(chosen)) for chosen in itertools.combinations(range(2 * edits), edits)]))
    rows = cells.select("h1", split).distinct().join(texts.select("h1", "line", "counts", F.length("line").cast("long").alias("size")), "h1")
    each = []
    for path in paths(edits):
        length = F.col("size") - path[-1]
        at = lambda block, length=length: F.call_function("div", length * block, F.lit(parts))
        begins = [F.lit(0), *[at(F.col(c) + 1) for c in names]]
        ends = [*[at(F.col(c)) for c in names], length]
        runs = [F.substring(F.col("line"), (b + (s + 1)).cast("int"), (e - b).cast("int")) for b, e, s in zip(begins, ends, (0, *path), strict=True)]
        # where nothing lies between two blocks, one shift of it is enough
        needed = [(begins[m] < ends[m]) | F.lit(path[m - 1] == (0, *path)[m - 1]) for m in range(1, edits)]
        key = F.when(reduce(Column.__and__, needed, F.lit(True)), F.xxhash64(length, *names, *runs))
        each.append(F.struct(F.lit(not any(path)).alias("own"), key.alias("key"), length.alias("length")))
    return rows.select("h1", "counts", *names, F.inline(F.array(*each))).where("key IS NOT NULL")


def near_lines(lines: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """Names (h1) of the lines that are within ``edits`` edits of a different line that comes first earlier.

    A key that more than ``CROWD`` indexed lines share is not joined: its lines are
    compared with the earliest of them, and what that leaves is told apart by
    keys of ever smaller blocks (``finer_keys``). So no line meets more than
    ``CROWD`` others under a key, until blocks are single characters.
    """
    numbers = stored(line_numbers(lines, edits, least), "line-numbers")
    keys, own = keys_of(numbers, edits), keys_of(numbers, edits).where("own")
    crowded = small(stored(crowds(own), "line-crowds"))
    pairs = stored(met(own.join(crowded, "key", "left_anti"), keys, edits), "line-pairs")
    rows = stored(keys_of(numbers, edits, cells=True).join(crowded, "key", "left_semi"), "line-keys")
    named = stored(pairs.select(F.explode(F.array("a", "b")).alias("h1")).union(rows.select("h1")).distinct(), "line-names")
    texts = lines.join(small(named), "h1", "left_semi").groupBy("h1").agg(F.first("line").alias("line"), F.min(place_of("id", "name", "line_no")).alias("place"))
    texts = stored(with_letter_counts(texts), "line-texts")
    near, parts = None, edits + 1
    while not rows.isEmpty():
        # the lines of a crowd and the earliest of those indexed
        places = texts.select("h1", "place")
        heads = rows.where("own").join(places, "h1").groupBy("key").agg(F.min(F.struct("place", "h1", "counts")).alias("head"))
        heads = heads.select("key", F.lit(True).alias("own"), "head.h1", "head.counts")
        new = stored(later_lines(stored(met(heads, rows, edits), "line-pairs"), texts, edits), "line-near")
        near = near.union(new) if near else new
        # a pair of lines that are both known to come later than a near one has no more to tell
        unknown = rows.join(near, "h1", "left_anti")
        crowded = small(stored(crowds(unknown.where(F.col("length") > parts)), "line-crowds"))
        pairs = pairs.union(stored(met(unknown.join(crowded, "key", "left_anti"), rows, edits), "line-pairs"))
        # smaller blocks
        parts *= 2
        cells = rows.join(crowded, "key", "left_semi").select("h1", *[f"c{m}" for m in range(edits)])
        keys = stored(finer_keys(cells, texts, parts, edits), "line-keys")
        crowded = small(stored(crowds(keys.where("own")), "line-crowds"))
        pairs = pairs.union(stored(met(keys.where("own").join(crowded, "key", "left_anti"), keys, edits), "line-pairs"))
        rows = stored(keys.join(crowded, "key", "left_semi"), "line-keys")
    found = later_lines(pairs, texts, edits)
    return found.union(near).distinct() if near else found


def judged_lines(docs: DataFrame, id_col: str, text_col: str, edits: int, least: int) -> DataFrame:
    """Every non-blank line and whether an earlier one is equal (repeated) or close (near), and a row with line number -1 for each document.

    Lines meet by a 64-bit name; a second hash keeps lines apart that share it.
    """
    rows = stored(lines_of(docs, id_col, text_col, marked=True).select("id", "name", "line_no", "h1", "h2"), "line-rows")
    place = ["id", "name", "line_no"]
    first = rows.where("line_no >= 0").groupBy("h1").agg(F.min(place_of(*place, "h2")).alias("first"))
    first = first.select("h1", F.struct("first.none", "first.id", "first.name", "first.line_no").alias("first"), F.col("first.h2").alias("first_h2"))
    known = first.join(near_lines(lines_of(docs, id_col, text_col), edits, least).withColumn("near", F.lit(True)), "h1", "left")
    joined = rows.join(known, "h1", "left")
    same = (F.col("h2") == F.col("first_h2")) & (F.col("line_no") >= 0)
    repeated = same & (place_of(*place) != F.col("first"))
    return joined.select("id", "name", "line_no", repeated.alias("repeated"), (same & F.coalesce("near", F.lit(False))).alias("near"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """Every non-blank line and whether an earlier one is equal (repeated) or close (near): (id, name, line_no, repeated, near)."""
    return judged_lines(docs, id_col, text_col, edits, least).where("line_no >= 0")


def per_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """One row per document: (id, name, n_lines, n_repeated, n_near, dropped), dropped the sorted numbers of its dropped lines.

    ``name`` tells documents that share an id apart.
    """
    gone = F.col("repeated") | F.col("near")
    return judged_lines(docs, id_col, text_col, edits, least).groupBy("id", "name").agg(
        F.count_if(F.col("line_no") >= 0).alias("n_lines"), F.count_if("repeated").alias("n_repeated"),
        F.count_if(F.col("near") & ~F.col("repeated")).alias("n_near"), F.array_sort(F.collect_set(F.when(gone, F.col("line_no")))).alias("dropped"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without their dropped lines; all columns kept, null texts stay null."""
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    i, t = (f"_c{names.index(c)}" for c in (id_col, text_col))
    cut = per_document(docs, id_col, text_col, **options).where(F.size("dropped") > 0).select("id", "name", "dropped")
    flat = flat.withColumn("_name", text_name(F.col(t))).join(cut, F.col(i).eqNullSafe(F.col("id")) & (F.col("_name") == F.col("name")), "left")
    kept = F.filter(F.split(F.col(t), "\n"), lambda line, n: ~F.array_contains("dropped", n))
    text = F.when(F.col("dropped").isNull(), F.col(t)).otherwise(F.array_join(kept, "\n"))
    return flat.withColumn(t, text).drop("id", "name", "_name", "dropped").toDF(*names)
