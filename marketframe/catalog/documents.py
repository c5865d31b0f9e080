"""Queries of JSON documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe.catalog.registry import query
from marketframe.operators import jsonq
from marketframe.sources import adapters as A


@query("json_query_result", """
SELECT o_orderkey AS doc_id, 0::INTEGER AS pos, concat('A', CAST(o_orderkey AS VARCHAR)) AS ticker, CAST(o_custkey AS DOUBLE) AS px, o_orderpriority AS nm FROM orders
UNION ALL SELECT o_orderkey, 1, '', CAST(o_orderkey AS DOUBLE), NULL FROM orders
UNION ALL SELECT o_orderkey, 2, concat('C', CAST(o_orderkey AS VARCHAR)), NULL, NULL FROM orders""")
def json_query_result(spark, path):
    return jsonq.json_query_result(A.json_results(spark, path), "json", keys=["doc_id"])


@query("json_query_values", """
SELECT o_orderkey AS doc_id, i::INTEGER AS pos, CASE i WHEN 0 THEN concat('A', o_orderkey) WHEN 1 THEN '' ELSE concat('C', o_orderkey) END AS ticker, n.name,
  CASE WHEN n.name = 'nm' THEN CASE i WHEN 0 THEN o_orderpriority END ELSE CASE i WHEN 0 THEN CAST(o_custkey::DOUBLE AS VARCHAR) WHEN 1 THEN CAST(o_orderkey::DOUBLE AS VARCHAR) END END AS value
FROM orders, generate_series(0, 2) g(i), (VALUES ('px'), ('nm')) n(name)""")
def json_query_values(spark, path):
    rows = jsonq.json_query_values(A.json_results(spark, path), "json", ["doc_id"])
    return rows.withColumn("value", F.try_variant_get("value", "$", "string"))


@query("json_query_errors", """
SELECT o_orderkey AS doc_id, 'late (in px)' AS message, false AS fatal FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, 'odd', false FROM orders WHERE o_orderkey % 5 = 0""")
def json_query_errors(spark, path):
    return jsonq.json_query_errors(A.json_results(spark, path), "json", ["doc_id"])


@query("search_grid", """
SELECT o_orderkey AS doc_id, 0::INTEGER AS pos, concat('N', CAST(o_orderkey AS VARCHAR)) AS name, CAST(o_custkey AS VARCHAR) AS qty, NULL::VARCHAR AS col2 FROM orders
UNION ALL SELECT o_orderkey, 1, concat('M', CAST(o_custkey AS VARCHAR)), NULL, 'z' FROM orders""")
def search_grid(spark, path):
    return jsonq.search_grid(A.search_documents(spark, path), "json", ["doc_id"])


TREE = """(SELECT event_id AS doc_id, concat('{"tickData":[{"type":"', event_type, '","size":', regexp_extract(props, '[0-9]+', 0),
  '},{"type":"BID","brokerBuyCode":"B', CAST(event_id AS VARCHAR), '"}],"meta":{"id":', CAST(event_id AS VARCHAR),
  ',"live":true,"none":null,"deep":{"list":[[', CAST(event_id AS VARCHAR), ',2],[]],"empty":{}}}}') AS json FROM events)"""


@query("flatten_tree", f"""
SELECT doc_id, substr(t.fullkey, 3) AS path, CASE t.type WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'VARCHAR' THEN 'string' ELSE 'number' END AS type,
  CASE WHEN t.type = 'NULL' THEN NULL WHEN t.type = 'VARCHAR' THEN trim(CAST(t.atom AS VARCHAR), '"') ELSE CAST(t.atom AS VARCHAR) END AS value_str,
  CASE WHEN t.type IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN CAST(CAST(t.atom AS VARCHAR) AS DOUBLE) END AS value_num
FROM {TREE} d, json_tree(d.json) t WHERE t.type NOT IN ('OBJECT', 'ARRAY')""")
def flatten_tree(spark, path):
    return jsonq.flatten_tree(A.tree_documents(spark, path), "json", ["doc_id"])
