"""Tables that streams keep below a folder: batches, compacted versions, counters and columns that come later.

Every batch has a folder of its own, replaced as a whole if the batch is
repeated; a folder counts once its write is committed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.operators.joins import latest_by

# Batches between two compactions of an update table.
COMPACT_EVERY = 16


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def committed(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers n of the folders ``name=n`` whose write is complete, in order."""
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith(f"{name}=")]
    done = [p for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().partition("=")[2]) for p in done)


def remove(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _path(spark, path)
    fs.delete(jvm_path, True)


def write_batch(rows: DataFrame, folder: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/rows/batch={batch_id}")


def _since(spark: SparkSession, folder: str, schema: T.StructType, after: int | None, upto: int | None = None) -> list[DataFrame]:
    """The compacted version ``after`` and the batches that follow it, each with its number as ``_batch``."""
    read = lambda path, n: spark.read.schema(schema).parquet(path).withColumn("_batch", F.lit(n).cast("long"))
    parts = [] if after is None else [read(f"{folder}/base/version={after}", after)]
    later = [b for b in committed(spark, f"{folder}/rows", "batch") if (after is None or b > after) and (upto is None or b <= upto)]
    if later:
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())]))
        rows = rows.option("basePath", f"{folder}/rows").parquet(*[f"{folder}/rows/batch={b}" for b in later])
        parts.append(rows.withColumnRenamed("batch", "_batch"))
    return parts


def compact(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str], upto: int) -> None:
    """Write the newest row of every key up to a batch as a version, and remove what no reader needs any more.

    A repeated compaction starts from the version before and writes the same
    rows: that version and the batches after it stay until the next one.
    """
    before = [v for v in committed(spark, f"{folder}/base", "version") if v < upto]
    last = before[-1] if before else None
    merged = latest_by(reduce(DataFrame.unionByName, _since(spark, folder, schema, last, upto)), keys, [F.col("_batch")])
    merged.select(*schema.fieldNames()).write.mode("overwrite").parquet(f"{folder}/base/version={upto}")
    for v in before[:-1]:
        remove(spark, f"{folder}/base/version={v}")
    for b in committed(spark, f"{folder}/rows", "batch"):
        if last is not None and b <= last:
            remove(spark, f"{folder}/rows/batch={b}")


def upserting(folder: str, schema: T.StructType, keys: Sequence[str], every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function of an update-mode table."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, folder, batch_id)
        if (batch_id + 1) % every == 0:
            compact(batch.sparkSession, folder, schema, keys, batch_id)
    return sink


def read_updates(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Newest row of every key: the last compacted version and the few batches after it."""
    versions = committed(spark, f"{folder}/base", "version")
    parts = _since(spark, folder, schema, versions[-1] if versions else None)
    if not parts:
        return spark.createDataFrame([], schema)
    return latest_by(reduce(DataFrame.unionByName, parts), keys, [F.col("_batch")]).select(*schema.fieldNames())


def counting(folder: str, time: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes rows and, beside them, their number and last time."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, folder, batch_id)
        written = batch.sparkSession.read.schema(batch.schema).parquet(f"{folder}/rows/batch={batch_id}")
        counts = written.agg(F.count(F.lit(1)).alias("messages"), F.max(time).alias("last_message"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{folder}/counts/batch={batch_id}")
    return sink


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Messages and last message of all batches: one row per batch is read, however long the stream ran."""
    rows = spark.read.schema("messages long, last_message timestamp").parquet(f"{folder}/counts")
    return rows.agg(F.coalesce(F.sum("messages"), F.lit(0)).alias("messages"), F.max("last_message").alias("last_message"))


def with_field_columns(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """A column for each key of a map column; names that differ in case only are one, a name that is taken gets ``_field`` behind it.

    The driver gets the names, as many as the vendor has fields.
    """
    kept = [c for c in rows.columns if c != fields]
    names = rows.select(F.explode(F.map_keys(fields)).alias("n")).distinct().orderBy("n").collect()
    of: dict[str, list[str]] = {}
    for r in names:
        of.setdefault(r["n"].upper(), []).append(r["n"])
    taken = {c.upper() for c in kept}
    value = lambda spelled: F.coalesce(*[F.try_element_at(fields, F.lit(n)) for n in spelled])
    return rows.select(*kept, *[value(spelled).alias(f"{name}_field" if name in taken else name) for name, spelled in of.items()])


def widening(folder: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch with a column for every field it has."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        write_batch(with_field_columns(held), folder, batch_id)
        held.unpersist()
    return sink


def read_widened(spark: SparkSession, folder: str) -> DataFrame:
    """All batches under the columns of all: a field that came later is null before."""
    return spark.read.option("mergeSchema", "true").parquet(f"{folder}/rows").drop("batch")
