"""Output formats, pivots, renames and column order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe import refdata
from marketframe.functions import values

NUMERIC_TYPES = {"float64", "int64", "int32"}


def format_long(df: DataFrame, types: dict[str, str], default: str = "string") -> DataFrame:
    """Value as double when every requested field is numeric, else as text."""
    numeric = bool(types) and all(types.get(f, default) in NUMERIC_TYPES for f in types)
    return df.withColumn("value", F.col("value").try_cast("double") if numeric else F.col("value").cast("string"))


# Typed output column and Spark type per engine type name.
_ROUTES = {
    "float64": ("value_f64", "double"),
    "int64": ("value_i64", "bigint"),
    "int32": ("value_i64", "bigint"),
    "string": ("value_str", "string"),
    "bool": ("value_bool", "boolean"),
    "date32": ("value_date", "date"),
    "timestamp": ("value_ts", "timestamp"),
}
_TYPED = [("value_f64", "double"), ("value_i64", "bigint"), ("value_str", "string"),
          ("value_bool", "boolean"), ("value_date", "date"), ("value_ts", "timestamp")]


def format_long_typed(df: DataFrame, dtype: Column | None = None) -> DataFrame:
    """Value routed to the one typed column its type names; the others are null."""
    kind = values.dtype_of(F.col("value").cast("string")) if dtype is None else dtype
    base = df.withColumn("_dtype", kind).withColumn("_text", F.col("value").cast("string"))
    routed = []
    for name, spark_type in _TYPED:
        kinds = [k for k, (col, _) in _ROUTES.items() if col == name]
        text = F.trim("_text") if name != "value_str" else F.col("_text")
        if name == "value_bool":
            low = F.lower(text)
            value = F.when(low.isin("true", "y"), True).when(low.isin("false", "n"), False)
        else:
            value = text.try_cast(spark_type)
        routed.append(F.when(F.col("_dtype").isin(kinds), value).alias(name))
    keep = [c for c in df.columns if c != "value"]
    return base.select(*keep, *routed)


def format_long_metadata(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Value as text with the name of its type; null has type ``null``."""
    text = F.col("value").cast("string")
    kind = values.dtype_of(text)
    if types:
        pairs = [F.lit(x) for pair in types.items() for x in pair]
        kind = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("field")), kind)
    return df.withColumn("value", text).withColumn("dtype", F.when(text.isNull(), "null").otherwise(kind))


def format_semi_long(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], types: dict[str, str] | None = None
) -> DataFrame:
    """One row per key, requested fields as typed columns in request order.

    One conditional aggregate: a single shuffle on the keys, combined on the
    map side, and no job to find the pivot values.
    """
    types = types or {}
    ordered = "pos" in df.columns and "pos" not in keys  # then the last row of a cell wins
    cols = []
    for f in fields:
        cell = F.when(F.col("field") == f, F.col("value"))
        value = F.max_by(cell, F.when(F.col("field") == f, F.col("pos"))) if ordered else F.max(cell)
        kind = types.get(f)
        cols.append((value.try_cast(values.SPARK_TYPES[kind]) if kind else value).alias(f))
    return df.groupBy(*keys).agg(*cols)


def is_long(df: DataFrame) -> bool:
    return set(df.columns) - {"pos"} == {"ticker", "field", "value"}


def pivot_to_wide(df: DataFrame, fields: Sequence[str] | None = None, pos: str = "pos") -> DataFrame:
    """Long (ticker, field, value) to one text column per field; the last row of a cell wins.

    Any other shape returns unchanged. Without ``fields`` the names are read in
    order of first appearance, a list as long as the field catalog.
    """
    if not is_long(df):
        return df
    if fields is None:
        seen = df.groupBy("field").agg(F.min(pos).alias("_first")).orderBy("_first")
        fields = [r["field"] for r in seen.toLocalIterator()]
        if not fields:
            return df
    at = lambda f: F.when(F.col("field") == f, F.col(pos))
    return df.groupBy("ticker").agg(*[
        F.max_by(F.col("value").cast("string"), at(f)).alias(f) for f in fields
    ])


def melt_snapshot(df: DataFrame, fields: str = "fields") -> DataFrame:
    """(ticker, map field -> value) to long rows with text values."""
    return df.select("ticker", F.explode(fields).alias("field", "value")).withColumn(
        "value", F.col("value").cast("string")
    )


def melt_history(df: DataFrame, days: str = "days") -> DataFrame:
    """(ticker, map date -> map field -> value) to long rows with text values."""
    by_day = df.select("ticker", F.explode(days).alias("date", "_fields"))
    return by_day.select("ticker", "date", F.explode("_fields").alias("field", "value")).withColumn(
        "value", F.col("value").cast("string")
    )


RESERVED = {"date", "time", "field", "value", "ticker"}


def panel_columns(columns: Sequence[str]) -> list[str]:
    """Columns of a wide panel that hold a ticker's data: ``TICKER|FIELD`` or a ticker with a space."""
    return [c for c in columns if c.lower() not in RESERVED and ("|" in c or " " in c)]


def melt_wide_panel(df: DataFrame) -> DataFrame:
    """Wide panel to (date, ticker, field, value); reserved names are no tickers."""
    rows = F.array(*[
        F.struct(
            F.lit(c.split("|", 1)[0]).alias("ticker"),
            F.lit(c.split("|", 1)[1] if "|" in c else None).cast("string").alias("field"),
            F.col(f"`{c}`").cast("double").alias("value"),
        )
        for c in panel_columns(df.columns)
    ])
    return df.select("date", F.inline(rows))


def apply_column_renames(df: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Rename columns, types kept; two columns may not end up with one name."""
    present = {a: b for a, b in pairs.items() if a in df.columns}
    after = [present.get(c, c) for c in df.columns]
    doubled = {c for c in after if after.count(c) > 1}
    if doubled:
        raise ValueError(f"several columns would be named {sorted(doubled)}")
    return df.withColumnsRenamed(present)


def rename_dividend_columns(df: DataFrame) -> DataFrame:
    return apply_column_renames(df, refdata.DIVIDEND_COLUMNS)


def rename_etf_columns(df: DataFrame) -> DataFrame:
    return apply_column_renames(df, refdata.ETF_COLUMNS)


def header_name(text: Column) -> Column:
    """Column name of a period header: ``FY 2023`` becomes ``fy2023``."""
    joined = F.regexp_replace(F.lower(F.trim(text)), r"[ \-/._]+", "_")
    return F.btrim(F.replace(joined, F.lit("_20"), F.lit("20")), F.lit("_"))


def earning_header_rename(data: DataFrame, header: DataFrame) -> DataFrame:
    """Rename ``X Value`` (or ``X``) by the text under ``X Header`` in the header table.

    The header becomes a relation (column, name), one row per column; of equal
    names the leftmost column keeps it, and no name of the data is taken twice.
    """
    own = [c for c in data.columns if c not in ("ticker", "field")]
    sources = {c: c.removesuffix(" Value") + " Header" for c in own}
    cells = [F.struct(F.lit(i).alias("at"), F.lit(c).alias("column"), F.col(f"`{h}`").cast("string").alias("text"))
             for i, (c, h) in enumerate(sources.items()) if h in header.columns]
    if not cells:
        return data
    melted = header.select(F.inline(F.array(*cells))).where(F.trim("text") != "")
    texts = melted.groupBy("at", "column").agg(F.first("text").alias("text"))
    named = texts.select("at", "column", header_name(F.col("text")).alias("name")).where(
        (F.col("name") != "") & ~F.col("name").isin([c.lower() for c in data.columns]))
    kept = named.groupBy("name").agg(F.min_by("column", "at").alias("column"))
    return data.withColumnsRenamed({r["column"]: r["name"] for r in kept.collect()})  # at most one row per column


QUOTE_ORDER = ["ticker", "time", "type", "value", "size"]


def order_columns(df: DataFrame, order: Sequence[str] = tuple(QUOTE_ORDER)) -> DataFrame:
    """Listed columns first, the rest after them in their own order."""
    first = [c for c in order if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def insert_after(df: DataFrame, col: str, name: str, value: Column) -> DataFrame:
    """Add a column directly behind another."""
    cols = []
    for c in df.columns:
        cols.append(F.col(f"`{c}`"))
        if c == col:
            cols.append(value.alias(name))
    return df.select(*cols)


def explode_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Explode list columns one after the other; an empty list keeps its row with null.

    A missing column gives an empty frame.
    """
    if any(c not in df.columns for c in cols):
        return df.limit(0)
    for c in cols:
        df = df.withColumn(c, F.explode_outer(c))
    return df


def reshape_flat_quotes(flat: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Leaf rows ``tickData[i].name`` to one row per quote, text first, else the number."""
    pattern = r"tickData\[(\d+)\]\.(\w+)"
    text = F.when(F.col("value_str") != "", F.col("value_str"))
    leaf = flat.where(F.col("path").rlike(pattern)).select(
        *keys,
        F.regexp_extract("path", pattern, 1).cast("bigint").alias("idx"),
        F.regexp_extract("path", pattern, 2).alias("field"),
        F.coalesce(text, F.col("value_num").cast("string")).alias("value"),
    )
    return format_semi_long(leaf, [*keys, "idx"], fields)


def resolve_field_types(
    fields: DataFrame, overrides: dict[str, str], catalog: DataFrame, default: str = "string"
) -> DataFrame:
    """Type per field: override, else catalog, else default; names compare without case.

    Of a field the catalog has twice the last row by ``pos`` counts, without
    positions the type that comes first in order.
    """
    kind = values.engine_type(F.col("type"))
    one = F.max_by(kind, "pos") if "pos" in catalog.columns else F.min(kind)
    known = catalog.groupBy(F.upper("field").alias("_key")).agg(one.alias("_type"))
    out = fields.join(known, F.upper(fields["field"]) == F.col("_key"), "left")
    kind = F.coalesce(F.col("_type"), F.lit(default))
    if overrides:
        pairs = [F.lit(x) for name, t in overrides.items() for x in (name.upper(), t)]
        kind = F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper("field")), kind)
    return out.withColumn("type", kind).drop("_key", "_type")


def raw_json(df: DataFrame) -> DataFrame:
    """Every row as one JSON text."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


MAX_SAFE_INTEGER = 2**53 - 1


def preview_json(df: DataFrame, max_rows: int, max_chars: int, order: Sequence[Column]) -> DataFrame:
    """The first rows as JSON: long text is cut with an ellipsis.

    Whole numbers beyond 2**53 - 1 and numbers that are not finite appear as
    text under ``<name>__text``, since JSON readers would not keep them. A
    top-k report: ``order`` decides which rows are first.
    """
    cols = []
    cut = F.lit(False)
    for item in df.schema.fields:
        c, kind = F.col(f"`{item.name}`"), item.dataType.simpleString()
        if kind == "string":
            long = F.length(c) > max_chars
            cut = cut | F.coalesce(long, F.lit(False))
            c = F.when(long, F.concat(F.substring(c, 1, max_chars), F.lit("…"))).otherwise(c)
        elif kind in ("bigint", "double", "float"):
            safe = F.abs(c) <= MAX_SAFE_INTEGER if kind == "bigint" else ~F.isnan(c) & (F.abs(c) < float("inf"))
            cols.append(F.when(~safe, c.cast("string")).alias(f"{item.name}__text"))
            c = F.when(safe, c)
        cols.append(c.alias(item.name))
    top = df.orderBy(*order).limit(max_rows)
    return top.select(F.to_json(F.struct(*cols)).alias("json"), cut.alias("truncated"))


def extract_field_value(df: DataFrame, field: str, keys: Sequence[str] = ("ticker",)) -> DataFrame:
    """One field per key, from a long table (names without case) or a wide one (exact name, then lower case)."""
    if {"field", "value"} <= set(df.columns):
        return df.where(F.lower("field") == field.lower()).select(*keys, "value")
    name = field if field in df.columns else next((c for c in df.columns if c.lower() == field.lower()), None)
    if name is None:
        return df.select(*keys, F.lit(None).cast("string").alias("value"))
    return df.select(*keys, F.col(f"`{name}`").alias("value"))
