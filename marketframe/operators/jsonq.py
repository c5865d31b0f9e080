"""JSON documents as tables: query results, errors, search grids, flat leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_RESULTS = (
    "struct<results: map<string, struct<idColumn: struct<values: array<string>>,"
    " valuesColumn: struct<values: array<variant>>>>>"
)


def _is_number(v):
    return F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL|INT|SMALLINT|TINYINT)")


def _as_text(values: Column) -> Column:
    return F.transform(values, lambda v: F.try_variant_get(v, "$", "string"))


def _as_numbers(values: Column) -> Column:
    return F.transform(_as_text(values), lambda s: s.try_cast("double"))


def _typed(values: Column) -> Column:
    """Values of one result of one document as VARIANT: numbers if any is one (text in it parses or is null), else text."""
    as_variant = lambda list_: F.transform(list_, lambda v: v.cast("variant"))
    return F.when(F.exists(values, _is_number), as_variant(_as_numbers(values))).otherwise(as_variant(_as_text(values)))


_AS = {"double": _as_numbers, "string": _as_text, "variant": _typed}


def _results(df: DataFrame, json_col: str, keys: Sequence[str]) -> DataFrame:
    """(…keys, _ids, _columns): ids of each document and its results as (name, values) in their order; ids come from the first result that has some."""
    doc = df.select(*keys, F.map_entries(F.from_json(json_col, _RESULTS)["results"]).alias("_r"))
    with_ids = F.filter("_r", lambda e: F.size(e["value"]["idColumn"]["values"]) > 0)
    none = lambda kind: F.array().cast(f"array<{kind}>")
    columns = F.transform("_r", lambda e: F.struct(e["key"].alias("name"), F.coalesce(e["value"]["valuesColumn"]["values"], none("variant")).alias("values")))
    return doc.select(*keys, F.coalesce(F.get(with_ids, 0)["value"]["idColumn"]["values"], none("string")).alias("_ids"), columns.alias("_columns"))


def result_columns(df: DataFrame, json_col: str) -> dict[str, str]:
    """Names of all results, by first place, and the type of each: double, string, or variant where documents differ.

    One aggregate over the documents; the driver gets one row per name.
    """
    cells = _results(df, json_col, []).select(F.posexplode("_columns").alias("at", "c"))
    numbers = F.exists("c.values", _is_number)
    text = ~numbers & F.exists("c.values", lambda v: v.isNotNull() & ~F.is_variant_null(v))
    found = cells.groupBy("c.name").agg(F.min("at").alias("at"), F.max(numbers).alias("numbers"), F.max(text).alias("text")).orderBy("at", "name").collect()
    return {r["name"]: "variant" if r["numbers"] and r["text"] else "double" if r["numbers"] else "string" for r in found}


def json_query_values(df: DataFrame, json_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Results of query documents as rows (…keys, pos, ticker, name, value): names and types as each document has them, value a VARIANT.

    Nothing is read beforehand. Ids and values pair by position, short value
    lists end in null, a null id is empty text.
    """
    doc = _results(df, json_col, keys)
    longest = F.array_max(F.concat(F.array(F.size("_ids")), F.transform("_columns", lambda c: F.size(c["values"]))))
    places = F.when(longest > 0, F.sequence(F.lit(0), longest - 1))
    rows = doc.select(*keys, "_ids", F.inline("_columns").alias("_name", "_values"), places.alias("_p"))
    rows = rows.select(*keys, "_ids", "_name", _typed(F.col("_values")).alias("_values"), "_p").select("*", F.explode("_p").alias("pos"))
    return rows.select(*keys, "pos", F.coalesce(F.get("_ids", F.col("pos")), F.lit("")).alias("ticker"),
                       F.col("_name").alias("name"), F.get("_values", F.col("pos")).alias("value"))


def json_query_result(
    df: DataFrame, json_col: str, names: Sequence[str] | None = None, keys: Sequence[str] = (), types: dict[str, str] | None = None
) -> DataFrame:
    """Result sets of query documents as rows: ticker plus one column per result.

    Ids and values pair by position; short value lists end in null; ids come
    from the first result of the document that has them, a null id is empty
    text. Values are typed document by document; a column is double or text
    where all documents agree and a VARIANT otherwise, so that a text survives
    a number elsewhere. Without ``types`` (name -> double, string or variant)
    the documents are read once before; ``names`` picks and orders columns.
    Each document unfolds on its own: no shuffle, no pivot.
    """
    kinds = types if types is not None else result_columns(df, json_col)
    wanted = list(names) if names is not None else list(kinds)
    doc = _results(df, json_col, keys)
    of = lambda n: F.get(F.filter("_columns", lambda c: c["name"] == n), 0)["values"]
    lists = [F.col("_ids").alias("ticker")]
    for i, n in enumerate(wanted):
        kind = kinds.get(n, "string")
        lists.append(F.coalesce(_AS[kind](of(n)), F.array().cast(f"array<{kind}>")).alias(f"_v{i}"))
    rows = doc.select(*keys, F.posexplode(F.arrays_zip(*lists)).alias("pos", "_z"))
    return rows.select(
        *keys, "pos", F.coalesce("_z.ticker", F.lit("")).alias("ticker"),
        *[F.col(f"_z._v{i}").alias(n) for i, n in enumerate(wanted)],
    )


_ERRORS = (
    "struct<results: map<string, string>,"
    " responseExceptions: array<struct<message: string, internalMessage: string, node: string>>>"
)


def json_query_errors(df: DataFrame, json_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per exception: message (with its node) and whether it is fatal.

    Exceptions are fatal when the document has no results, else warnings.
    """
    doc = df.select(*keys, F.from_json(json_col, _ERRORS).alias("d"))
    empty = F.coalesce(F.size("d.results") <= 0, F.lit(True))
    rows = doc.select(*keys, empty.alias("fatal"), F.inline("d.responseExceptions"))
    node = F.when(F.col("node").isNotNull(), F.concat(F.lit(" (in "), F.col("node"), F.lit(")")))
    return rows.select(*keys, F.concat(F.col("message"), F.coalesce(node, F.lit(""))).alias("message"), "fatal")


_GRID = (
    "struct<fieldDisplayUnits: array<struct<field: string, fieldId: string>>,"
    " results: array<variant>>"
)


def search_grid_header(df: DataFrame, json_col: str) -> list[str]:
    """Column names of all documents: display units, else the names of a document's first row; ``ticker`` if there is nothing.

    Documents may have different headers; names keep the order of their first place.
    """
    doc = F.from_json(json_col, _GRID)
    units = F.transform(
        doc["fieldDisplayUnits"],
        lambda u, i: F.coalesce(u["field"], u["fieldId"], F.concat(F.lit("col"), i.cast("string"))),
    )
    first_row = F.to_json(F.get(doc["results"], 0))
    inner = F.get_json_object(first_row, "$.resultsRow")
    names = F.json_object_keys(F.coalesce(inner, first_row))
    header = F.when(F.size(units) > 0, units).otherwise(names)
    places = df.select(F.posexplode(header).alias("at", "name")).groupBy("name").agg(F.min("at").alias("at"))
    return [r["name"] for r in places.orderBy("at", "name").collect()] or ["ticker"]  # as many as there are fields


def search_grid(df: DataFrame, json_col: str, keys: Sequence[str] = (), header: Sequence[str] | None = None) -> DataFrame:
    """Rows of search documents under their header; values stay text."""
    names = list(header) if header is not None else search_grid_header(df, json_col)
    rows = df.select(*keys, F.posexplode(F.from_json(json_col, _GRID)["results"]).alias("pos", "_row"))
    text = F.to_json("_row")
    cells = F.from_json(F.coalesce(F.get_json_object(text, "$.resultsRow"), text), "map<string,string>")
    return rows.withColumn("_cells", cells).select(
        *keys, "pos", *[F.try_element_at("_cells", F.lit(n)).alias(n) for n in names]
    )


# An optional key and a value, an opening or a closing bracket; strings are matched without backtracking.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TOKEN = rf'(?:({_STRING})\s*+:\s*+)?({_STRING}|[{{}}\[\]]|[^\s{{}}\[\],:"]++)'
_OPEN, _LEAVES = "array<struct<path: string, item: int>>", "array<struct<path: string, token: string>>"
# Leaves are gathered in pages of so many, so that adding one does not copy all before it.
_PAGE = 256
# Levels that are unfolded by lateral joins, which is faster; what lies below is walked.
_JOINED_LEVELS = 6


def _walk(text: Column, root: Column) -> Column:
    """Leaves (path, token) of a document whose path is ``root``: one pass over its tokens with the containers that are open, of any depth.

    An object has item -1, an array the number of the item that comes next.
    """
    keys, values = (F.regexp_extract_all(text, F.lit(_TOKEN), group) for group in (1, 2))

    def step(s: Column, t: Column) -> Column:
        key, value, top = t["key"], t["value"], F.element_at(s["open"], -1)
        nested = F.size(s["open"]) > 0
        opens, closes = value.isin("{", "["), value.isin("}", "]")
        name = F.when(F.contains(key, F.lit("\\")), F.variant_get(F.parse_json(key), "$", "string")).otherwise(F.substring(key, 2, F.length(key) - 2))
        path = (
            F.when(~nested, root).when(top["item"] >= 0, F.concat(top["path"], F.lit("["), top["item"].cast("string"), F.lit("]")))
            .when(top["path"] == "", name).otherwise(F.concat(top["path"], F.lit("."), name))
        )
        below = F.slice(s["open"], 1, F.size(s["open"]) - 1)
        counted = F.when(nested & (top["item"] >= 0), F.concat(below, F.array(F.struct(top["path"].alias("path"), (top["item"] + 1).alias("item"))))).otherwise(s["open"])
        pushed = F.concat(counted, F.array(F.struct(path.alias("path"), F.when(value == "{", -1).otherwise(0).alias("item"))))
        full, found = F.size(s["page"]) >= _PAGE, F.array(F.struct(path.alias("path"), value.alias("token")))
        leaf = ~opens & ~closes
        return F.struct(
            F.when(closes, below).when(opens, pushed).otherwise(counted).alias("open"),
            F.when(leaf & full, found).when(leaf, F.concat(s["page"], found)).otherwise(s["page"]).alias("page"),
            F.when(leaf & full, F.concat(s["pages"], F.array(s["page"]))).otherwise(s["pages"]).alias("pages"),
        )

    empty = lambda name, kind: F.array().cast(kind).alias(name)
    start = F.struct(empty("open", _OPEN), empty("page", _LEAVES), empty("pages", f"array<{_LEAVES}>"))
    tokens = F.arrays_zip(keys.alias("key"), values.alias("value"))
    return F.aggregate(tokens, start, step, lambda s: F.flatten(F.concat(s["pages"], F.array(s["page"]))))


def flatten_tree(df: DataFrame, json_col: str, keys: Sequence[str], joined_levels: int = _JOINED_LEVELS) -> DataFrame:
    """Leaves of JSON documents as (path, type, value_str, value_num), at any depth.

    Paths read ``a.b[0].c``; an empty container has no leaves, nor has a null
    document. Lateral joins unfold the first levels; what is still a container
    then is walked by one expression, however deep it is. No shuffle.
    """
    view = df.select(*keys, F.lit("").alias("path"), F.parse_json(json_col).alias("v"))
    for _ in range(joined_levels):
        view = _unfold(view, keys)
    container = F.schema_of_variant("v").rlike("^(OBJECT|ARRAY)")
    deep = view.withColumn("_deep", container).withColumn("_text", F.when(F.col("_deep"), F.to_json("v")))
    deep = deep.where(~F.col("_deep") | ~F.col("_text").isin("{}", "[]"))
    leaves = deep.select(*keys, "path", "v", "_deep", F.inline_outer(F.when(F.col("_deep"), _walk(F.col("_text"), F.col("path")))).alias("_path", "_token"))
    leaves = leaves.where(~F.col("_deep") | F.col("_token").isNotNull()).select(
        *keys, F.coalesce("_path", "path").alias("path"), F.when(F.col("_deep"), F.parse_json("_token")).otherwise(F.col("v")).alias("v"))
    is_null = F.is_variant_null("v")
    kind = F.schema_of_variant("v")
    numeric = _is_number(F.col("v"))
    return leaves.select(
        *keys, "path",
        F.when(is_null, "null").when(kind == "BOOLEAN", "boolean").when(numeric, "number").otherwise("string").alias("type"),
        F.when(~is_null, F.try_variant_get("v", "$", "string")).alias("value_str"),
        F.when(numeric, F.try_variant_get("v", "$", "double")).alias("value_num"),
    )


def _unfold(view: DataFrame, keys: Sequence[str]) -> DataFrame:
    exploded = view.lateralJoin(
        view.sparkSession.tvf.variant_explode_outer(F.col("v").outer()).select(
            F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_child")
        )
    )
    named = F.when(F.col("path") == "", F.col("_key")).otherwise(F.concat_ws(".", "path", "_key"))
    indexed = F.concat(F.col("path"), F.lit("["), F.col("_pos").cast("string"), F.lit("]"))
    path = (
        F.when(F.col("_key").isNotNull(), named).when(F.col("_pos").isNotNull(), indexed).otherwise(F.col("path"))
    )
    inside = F.col("_key").isNotNull() | F.col("_pos").isNotNull()
    return exploded.select(
        *keys, path.alias("path"), F.when(inside, F.col("_child")).otherwise(F.col("v")).alias("v")
    )
