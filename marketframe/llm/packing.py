"""Best-fit packing planned on a histogram of lengths.

Documents become token ids, an end mark (id 0) behind each; only documents
longer than a sequence are cut. Best fit in falling order of length needs the
lengths alone, so it runs over the histogram: sequences that were filled alike
are one entry (a range of numbers and the room left), and all pieces of one
length take the entries with the least room that still fits, whole ranges at a
time. The plan is a list of runs (length, first rank, pieces, first sequence,
pieces a sequence, offset); its length depends on the sequence length, not on
the number of documents. Every piece then takes the slot that the plan holds
for its rank within its length.

Ranks need no ordered pass over a length: pieces of a length are dealt to
buckets of about ``BUCKET_ROWS`` rows by a hash, numbered within their bucket,
and a bucket's offset is the sum of the counts of those before it. A length that
holds a third of all rows is therefore many small groups.

Tokens of a text are those of its blank-separated parts one after the other, as
the tokenizer drops white space and nothing in it reaches across; parts recur,
so each worker remembers the ids of those it met lately (up to ``CACHE_BYTES``
twice, more only while one document needs it).

Defined results: a null text counts as empty and is the end mark alone; a null
id is kept; repeated rows are documents of their own and get slots of their
own; strings of special tokens in a text are ordinary text; a very long text is
cut into full pieces, the last one shorter; an empty table gives an empty
result.
"""

from __future__ import annotations

import array
import bisect
import functools
import re
import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketframe.llm.common import pick, stored
from marketframe.llm.shards import looked_up

SIZE, END = 2048, 0
CACHE_BYTES = 1 << 26
PLAIN, WORDS = re.compile(rb"[a-z]+[!-&(-/:-@\\[-`{-~]*"), re.compile(r"[a-z]+|[^a-z]+")
BUCKET_ROWS, MOST_BUCKETS = 512, 1 << 16
PIECES = "id {id}, piece int, start long, length long, crc long, lot long"


class _Ids(dict):
    """Ids of text parts, worked out when first asked for; those of an older table move on when met again."""

    def __init__(self, ids_of: Callable[[bytes], bytes], older: dict[bytes, bytes]):
        super().__init__()
        self.ids_of, self.older, self.held = ids_of, older, 0

    def __missing__(self, part: bytes) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = self.ids_of(part)
        self[part] = ids
        self.held += len(part) + len(ids) + 150
        return ids


@functools.cache
def encoder(path: str) -> Callable[[bytes], bytes]:
    """Function text -> its ids, 4 bytes each, the lowest first; a worker keeps it from task to task."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True

    bpe = tokenizer.model

    def ids_of(part: bytes) -> bytes:
        if PLAIN.fullmatch(part):  # a word and what stands behind it: both known to the vocabulary as they are
            found = [token.id for word in WORDS.findall(part.decode()) for token in bpe.tokenize(word)]
        else:
            found = tokenizer.encode(part.decode("utf-8", "replace"), add_special_tokens=False).ids
        ids = array.array("I", found)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    known = _Ids(ids_of, {})

    def encode(text: bytes) -> bytes:
        nonlocal known
        if known.held > CACHE_BYTES:  # what is met again moves on, the rest is forgotten
            known.older = {}
            known = _Ids(ids_of, known)
        return b"".join(map(known.__getitem__, text.lower().split()))
    return encode


def pieces_of(docs: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: (id, piece, start, length, crc, lot). ``lot`` tells rows that are equal otherwise apart."""
    rows = pick(docs, id=id_col, text=text_col)
    schema = PIECES.format(id=rows.schema["id"].dataType.simpleString())
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, lot = encoder(tokenizer), 0
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = memoryview(encode(text or b"") + end)
                n = len(ids) // 4
                for k, at in enumerate(range(0, n, size)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(min(size, n - at))
                    crc.append(zlib.crc32(ids[4 * at: 4 * (at + size)]))
            lots = np.arange(lot, lot + len(row))
            lot += len(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc, lots))],
                names=["id", "piece", "start", "length", "crc", "lot"])
    return rows.select("id", F.col("text").cast("binary").alias("text")).mapInArrow(cut, schema)


def plan(counts: dict[int, int], size: int = SIZE) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best fit in falling order of length: runs (length, first rank, pieces, first sequence, pieces a sequence, offset), and the sequences used."""
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges (first sequence, sequences)
    rooms: list[int] = []
    runs, used = [], 0

    def put(left: int, first: int, n: int) -> None:
        if n and left:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            room[left].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, rest = 0, counts[length]
        while rest:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, n = room[left].pop()
                if not room[left]:
                    del room[left], rooms[at]
            else:
                left, first, n = size, used, -(-rest // (size // length))
                used += n
            each = left // length
            full = min(n, rest // each)
            shares = [(full, full * each)] if full else []
            if full < n and rest > full * each:
                shares.append((1, rest - full * each))
            for sequences, taken in shares:
                runs.append((length, rank, taken, first, each, size - left))
                put(left - length * (taken // sequences), first, sequences)
                rank, rest, first, n = rank + taken, rest - taken, first + sequences, n - sequences
            put(left, first, n)
    return runs, used


def ranked(pieces: DataFrame, counts: dict[int, int], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """A column ``rank``: every piece's number among those of its length, from 0 without gaps."""
    most = max(counts, default=0)
    buckets = [min(MOST_BUCKETS, -(-counts.get(n, 0) // bucket_rows)) or 1 for n in range(most + 1)]
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "lot"), looked_up(buckets, F.col("length"))))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offset = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    offset = offset.select(F.col("length").alias("of"), F.col("bucket").alias("in"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "piece", "lot", "start", "crc"))
    placed = dealt.withColumn("inside", inside).join(offset, (F.col("length") == F.col("of")) & (F.col("bucket") == F.col("in")))
    return placed.select(*pieces.columns, (F.col("offset") + F.col("inside") - 1).alias("rank"))


def _seated(runs: list[tuple[int, int, int, int, int, int]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Looks up each piece's run, the last of its length that begins at its rank or before."""
    length, first, _, sequence, each, offset = (np.array(x, np.int64) for x in zip(*sorted(runs)))

    def seat(batches):
        lengths, starts = np.unique(length, return_index=True)
        ends = np.append(starts[1:], len(length))
        for batch in batches:
            n, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            run = np.zeros(len(n), np.int64)
            for x in np.unique(n):
                a, b = (side[np.searchsorted(lengths, x)] for side in (starts, ends))
                of = n == x
                run[of] = a + np.searchsorted(first[a:b], rank[of], side="right") - 1
            at = rank - first[run]
            slots = [pa.array(sequence[run] + at // each[run]), pa.array(offset[run] + at % each[run] * n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *slots], names=[*batch.schema.names[:5], "sequence", "offset"])
    return seat


def packed(docs: DataFrame, tokenizer: str, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Place of every piece: (id, piece, start, length, crc, sequence, offset). ``tokenizer`` is the path of a file of ``tokenizers``."""
    pieces = stored(pieces_of(docs, tokenizer, size, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per length, at most ``size``
    schema = f"id {pieces.schema['id'].dataType.simpleString()}, piece int, start long, length long, crc long, sequence long, offset long"
    if not counts:
        return docs.sparkSession.createDataFrame([], schema)
    runs, _ = plan(counts, size)
    return ranked(pieces, counts, bucket_rows).select("id", "piece", "start", "length", "crc", "rank").mapInArrow(_seated(runs), schema)
