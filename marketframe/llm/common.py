"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.session import work_dir

# Rows of a text column sent to a Python worker at once: whole texts, few of them.
BATCH_ROWS = 512
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Send few texts at once to Python workers, unless the session chose a number itself."""
    if spark.conf.get(BATCH_SETTING, "10000") == "10000":
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under new names: ``pick(df, id="doc_id")``.

    Columns are taken by position, so that others whose names are equal, or
    differ in case only, cannot make a reference ambiguous.
    """
    flat = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"_c{df.columns.index(old)}").alias(new) for new, old in columns.items()])


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it back: later work no longer depends on executors."""
    spark = df.sparkSession
    path = work_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_ids(df: DataFrame, kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose id is in the first column of ``kept``; all columns of ``df``, whatever their names."""
    names = df.columns
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    ids = kept.toDF("_kept_id").distinct()
    on = F.col(f"_c{names.index(id_col)}").eqNullSafe(F.col("_kept_id"))
    return flat.join(ids, on, "left_semi").toDF(*names)


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
