"""Stored tables: the bar cache and chunked reads."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketframe.functions import contracts
from marketframe.operators.scan import date_range, only_tickers
from marketframe.session import work_dir

BAR_COLUMNS = ["ticker", "time", "open", "high", "low", "close", "volume", "numEvents"]
BAR_DDL = (
    "ticker string, time timestamp, open double, high double, low double, close double, volume double, numEvents int"
)
CACHE_KEYS = ["asset", "event", "interval", "date"]


def bar_cache_write(
    bars: DataFrame, path: str, event: str, interval: str, as_of: str, session_end: DataFrame | None = None,
    reload: bool = False,
) -> None:
    """Store bars by asset class, event type, interval and date; tickers are sorted within files.

    Only days whose session ended before ``as_of`` are stored. ``session_end``
    gives (ticker, date, session_end_utc); without it a day ends at midnight.
    Days already stored stay as they are unless ``reload``.
    """
    spark = bars.sparkSession
    asset = F.element_at(contracts.tokens(F.col("ticker")), -1)
    rows = bars.withColumn("asset", asset).withColumn("event", F.lit(event)).withColumn(
        "interval", F.lit(interval)).withColumn("date", F.to_date("time"))
    now = F.lit(as_of).cast("timestamp")
    if session_end is None:
        rows = rows.where(F.date_add("date", 1).cast("timestamp") <= now)
    else:
        ended = session_end.where(F.col("session_end_utc") < now).select("ticker", "date")
        rows = rows.join(ended, ["ticker", "date"], "left_semi")
    stored = _stored(spark, path)
    if stored is not None:
        # only folders of the assets and days at hand are read
        span = rows.agg(F.min("date").alias("first"), F.max("date").alias("last"), F.collect_set("asset").alias("assets")).first()
        kept = stored.where((F.col("event") == event) & (F.col("interval") == interval) & F.col("asset").isin(span["assets"]))
        kept = date_range(kept, span["first"], span["last"]) if span["first"] else kept.limit(0)
        if reload:
            # rewrite the touched days: other tickers' rows of those days stay
            touched = rows.select(*CACHE_KEYS).distinct()
            fresh = rows.select(*CACHE_KEYS, "ticker").distinct()
            kept = kept.join(touched, CACHE_KEYS, "left_semi").join(fresh, [*CACHE_KEYS, "ticker"], "left_anti")
            rows = rows.unionByName(kept.select(*rows.columns))
        else:
            have = kept.select(*CACHE_KEYS, "ticker").distinct()
            rows = rows.join(have, [*CACHE_KEYS, "ticker"], "left_anti")
    # a day's bars spread over tasks by ticker, so one busy day is no hot partition
    spread = rows.repartition(*CACHE_KEYS, F.pmod(F.xxhash64("ticker"), F.lit(16)))
    out = spread.sortWithinPartitions(*CACHE_KEYS, "ticker", "time")
    if reload and stored is not None:
        # the rows read the partitions they replace, so they are written aside first
        aside = work_dir(spark, "bars")
        out.write.parquet(aside)
        out = spark.read.schema(out.schema).parquet(aside)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*CACHE_KEYS).parquet(path)
    else:
        out.write.mode("append").partitionBy(*CACHE_KEYS).parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored bars, or None before the first write."""
    try:
        return spark.read.schema(f"{BAR_DDL}, asset string, event string, interval string, date date").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def bar_cache_read(
    spark: SparkSession, path: str, event: str, interval: str, tickers=None, start=None, end=None
) -> DataFrame:
    """Stored bars; event, interval and dates prune folders, tickers are pushed to the files."""
    stored = _stored(spark, path)
    if stored is None:
        return spark.createDataFrame([], BAR_DDL)
    rows = stored.where((F.col("event") == event) & (F.col("interval") == interval))
    return only_tickers(date_range(rows, start, end), tickers).select(*BAR_COLUMNS)


STREAMABLE = ("hist", "bars", "ticks")


def batches(df: DataFrame, kind: str, rows: int = 10_000) -> Iterator[list[Row]]:
    """Hand a large result to a client in batches, one partition in memory at a time."""
    if kind not in STREAMABLE:
        raise ValueError(f"{kind!r} cannot be read in batches; only {', '.join(STREAMABLE)}")
    batch: list[Row] = []
    for row in df.toLocalIterator(prefetchPartitions=True):
        batch.append(row)
        if len(batch) == rows:
            yield batch
            batch = []
    if batch:
        yield batch


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType | str, files_per_trigger: int = 1000, glob: str | None = None
) -> DataFrame:
    """Table folder as a stream that takes a bounded number of files per trigger."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(folder)
