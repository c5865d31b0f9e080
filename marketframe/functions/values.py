"""Text values: cleaning, parsing, typing and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketframe import refdata

_INT = r"^[+-]?\d+$"
_FLOAT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_STAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"


def clean_value(text: Column) -> Column:
    """Trimmed text; blank and ``nan`` become null."""
    t = F.trim(text)
    return F.when(~F.lower(t).isin("", "nan"), t)


def parse_amount(text: Column) -> Column:
    """Number from text with thousands separators."""
    return F.regexp_replace(F.trim(text), ",", "").try_cast("double")


def parse_level(text: Column) -> Column:
    """Whole number from integer or integral float text."""
    n = F.trim(text).try_cast("double")
    return F.when(n == F.rint(n), n.try_cast("int"))


def dtype_of(text: Column) -> Column:
    """Type a text value reads as: bool, int64, float64, date32, timestamp, string or null."""
    t = clean_value(text)
    return (
        F.when(t.isNull(), F.lit("null"))
        .when(F.lower(t).isin("true", "false", "y", "n"), F.lit("bool"))
        .when(t.rlike(_INT) & t.try_cast("bigint").isNotNull(), F.lit("int64"))
        .when(t.rlike(_FLOAT), F.lit("float64"))
        .when(t.rlike(_DATE) & t.try_cast("date").isNotNull(), F.lit("date32"))
        .when(t.rlike(_STAMP) & t.try_cast("timestamp").isNotNull(), F.lit("timestamp"))
        .otherwise(F.lit("string"))
    )


def engine_type(vendor_type: Column) -> Column:
    """Engine type of a vendor type name; unknown names are strings."""
    kind = F.try_element_at(refdata.literal_map(refdata.VENDOR_TYPES), F.lower(F.trim(vendor_type)))
    return F.coalesce(kind, F.lit("string"))


# Spark type behind each engine type name.
SPARK_TYPES = {
    "bool": "boolean", "int32": "int", "int64": "bigint", "float64": "double",
    "date32": "date", "timestamp": "timestamp", "time64": "string", "string": "string",
}


def coerce(col: Column, source: str, target: str) -> Column:
    """Value of engine type ``source`` put into a column of engine type ``target``.

    Text never parses into a number; booleans count 1 and 0; wide integers
    wrap into narrow ones; dates and timestamps convert at midnight UTC.
    """
    if source == target:
        return col
    if target == "string":
        return render(col, source)
    number = ("int32", "int64", "float64")
    if source == "bool" and target in number:
        return col.cast("int").cast(SPARK_TYPES[target])
    if source == "int64" and target == "int32":
        wrapped = F.pmod(col + F.lit(2**31), F.lit(2**32)) - F.lit(2**31)
        return wrapped.cast("int")
    if source in number and target in number and source != "float64":
        return col.cast(SPARK_TYPES[target])
    if source == "timestamp" and target == "date32":
        return F.to_date(col)
    if source == "date32" and target == "timestamp":
        return col.cast("timestamp")
    if source == "timestamp" and target == "time64":
        return F.date_format(col, "HH:mm:ss.SSSSSS")
    return F.lit(None).cast(SPARK_TYPES[target])


def render(col: Column, source: str) -> Column:
    """Fixed text form of a typed value; null renders as empty text."""
    if source == "date32":
        text = F.date_format(col, "yyyy-MM-dd")
    elif source == "timestamp":
        text = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit(""))


def yield_flag(text: Column) -> Column:
    """Yield-type flag 1..9 of a code, a long name or the number itself."""
    t = F.upper(F.trim(text))
    number = t.try_cast("int")
    named = F.try_element_at(refdata.literal_map(refdata.YIELD_TYPES), t)
    return F.coalesce(named, F.when(number.between(1, 9), number))


def dividend_field(kind: Column) -> Column:
    """Field name of a dividend type alias; an unknown name passes through."""
    return F.coalesce(F.try_element_at(refdata.literal_map(refdata.DIVIDEND_TYPES), F.lower(kind)), kind)
