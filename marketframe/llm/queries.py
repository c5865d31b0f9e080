"""Registered queries of this subpackage, with the SQL that checks them where SQL can express it."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketframe.llm import chat, decontaminate, langid, licenses, lines, mixing, packing, pii, rtree, shards, simhash, topk, whitening
from marketframe.llm.common import small_batches, table
from marketframe.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of equal bytes. No SQL: DuckDB has no crc32."""
    placed = shards.assign(table(spark, sf_dir, "documents"), 8, map_path=work_dir(spark, "slot-map"))
    return placed.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        F.col("position").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("vslot").alias("virtual_slot"),
        F.lit(2).alias("map_version"),
    )


def _leaks_sql() -> str:
    """All windows compared plainly: of k + 1 pieces of a window one has none of its k differing words, so runs of words give every shift that can matter."""
    run = lambda g: "concat_ws(' ', " + ", ".join(f"w[p + {i + 1}]" for i in range(g)) + ")"
    grams = lambda rel, key, sizes: " UNION ALL ".join(
        f"SELECT {key}, p, {g} AS g, {run(g)} AS seed FROM (SELECT {key}, w, unnest(range(len(w) - {g - 1})) AS p FROM {rel} WHERE len(w) >= {g} AND len(w) BETWEEN {lo} AND {hi})"
        for g, lo, hi in sizes)
    allowed = lambda n: n - math.ceil(n * decontaminate.AGREE)
    pieces: dict[int, list[int]] = {}
    for n in range(decontaminate.MIN_ITEM, decontaminate.WINDOW + 1):
        pieces.setdefault(n // (allowed(n) + 1), []).append(n)
    top = 1 << 30
    of_items = [(g, min(ns), top if decontaminate.WINDOW in ns else max(ns)) for g, ns in pieces.items()]
    of_docs = [(g, 0, top) for g in pieces]
    words = "[x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+') IF x <> '']"
    return f"""
WITH d AS MATERIALIZED (SELECT doc_id, {words} AS w FROM documents),
b AS MATERIALIZED (SELECT item_id, w FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) >= {decontaminate.MIN_ITEM}),
bs AS MATERIALIZED ({grams('b', 'item_id', of_items)}),
ds AS MATERIALIZED ({grams('d', 'doc_id', of_docs)}),
hits AS MATERIALIZED (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS shift FROM ds JOIN bs USING (g, seed)),
laid AS MATERIALIZED (SELECT doc_id, item_id, least(len(b.w), {decontaminate.WINDOW}) AS width,
    [CASE WHEN shift + j >= 0 AND b.w[j + 1] = d.w[shift + j + 1] THEN 1 ELSE 0 END FOR j IN range(len(b.w))] AS equal
    FROM hits JOIN b USING (item_id) JOIN d USING (doc_id)),
best AS (SELECT doc_id, item_id, width, list_max([list_sum(list_slice(equal, s + 1, s + width)) FOR s IN range(len(equal) - width + 1)]) AS agreed FROM laid),
proven AS (SELECT doc_id, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items, count(*) AS n_items
    FROM (SELECT DISTINCT doc_id, item_id FROM best WHERE agreed >= ceil(width * {decontaminate.AGREE})) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_tokens, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items, '') AS items
FROM d LEFT JOIN proven USING (doc_id)"""


@query("op4_decontamination", _leaks_sql())
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each document holds."""
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n = F.size("items").cast("long")
    return found.select(F.col("id").alias("doc_id"), "n_tokens", (n > 0).alias("contaminated"), n.alias("n_items"),
                        F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"))


@query("op6_simhash")
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document. No SQL: DuckDB has no XXH64."""
    small_batches(spark)
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_of(F.col("fp")).alias("fingerprint"), F.col("group").alias("component_id"))


@query("op7_langid")
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document. No SQL: a trained model."""
    small_batches(spark)
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "held_out", F.col("lang").alias("lang_pred"), "score")


# Share of the tokens a mixture keeps.
MIX_KEEP = 0.5


@query("op2_mixing")
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell, inclusion probability and draw of every document, targets from the table. No SQL: bounded raking looks for its factors."""
    found = mixing.mix(table(spark, sf_dir, "documents"), None, MIX_KEEP)
    return found.select(F.col("id").alias("doc_id"), *mixing.DIMENSIONS, "tokens", (F.floor(F.col("p") * 1e6 + 0.5) / 1e6).alias("p"), "drawn")


@query("op5_licenses")
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence findings of every document. No SQL: expressions are parsed."""
    small_batches(spark)
    return licenses.license_scan(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op9_chat", """
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
prefixes AS MATERIALIZED (SELECT conv_id, row_number() OVER w AS n, string_agg(md5(role) || md5(text), '') OVER w AS prefix
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text ROWS UNBOUNDED PRECEDING)),
whole AS MATERIALIZED (SELECT conv_id, max(n) AS n_turns, arg_max(prefix, n) AS prefix FROM prefixes GROUP BY conv_id),
kept AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies FROM whole
    WHERE prefix NOT IN (SELECT p.prefix FROM prefixes p JOIN whole w ON p.conv_id IS NOT DISTINCT FROM w.conv_id WHERE p.n < w.n_turns) GROUP BY prefix)
SELECT k.conv_id, w.n_turns::BIGINT AS n_turns, n_copies::BIGINT AS n_copies,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', chr(10) ORDER BY turn NULLS LAST, role, text) AS text
FROM kept k JOIN whole w ON k.conv_id IS NOT DISTINCT FROM w.conv_id JOIN turns t ON k.conv_id IS NOT DISTINCT FROM t.conv_id GROUP BY ALL""")
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.chat_texts(table(spark, sf_dir, "conversations")).withColumnRenamed("id", "conv_id")


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document. No SQL: matches are checked digit by digit."""
    small_batches(spark)
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_email", "n_ip", "n_card", "n_phone", "base_sha256", pii.spans_text(F.col("spans")).alias("spans"))


@query("op3_topk", """
WITH v AS MATERIALIZED (SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""")
def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest inner products of every twentieth vector with all others."""
    found = topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)
    return found.withColumnRenamed("id", "vec_id")


@query("op8_line_dedup", f"""
WITH t AS MATERIALIZED (SELECT DISTINCT doc_id, text, ('0x' || substr(md5(coalesce(text, '')), 1, 15))::BIGINT AS name FROM documents),
l AS MATERIALIZED (SELECT row(doc_id IS NULL, coalesce(doc_id, 0), name) AS doc, n AS line_no, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
    FROM (SELECT doc_id, name, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS n FROM t)),
w AS MATERIALIZED (SELECT * FROM l WHERE line <> ''),
first AS MATERIALIZED (SELECT line, length(line) AS size, min(row(doc, line_no)) AS place FROM w GROUP BY line),
near AS MATERIALIZED (SELECT DISTINCT b.line FROM first a JOIN (SELECT *, unnest(range(size - {lines.EDITS}, size + {lines.EDITS} + 1)) AS other FROM first) b
    ON a.size = b.other AND a.place < b.place
    WHERE a.size >= {lines.LEAST} AND b.size >= {lines.LEAST} AND levenshtein(a.line, b.line) <= {lines.EDITS}),
marked AS (SELECT doc, line_no, place <> row(doc, line_no) AS repeated, line IN (SELECT line FROM near) AS near FROM w JOIN first USING (line)),
found AS (SELECT doc, count(*) AS n_lines, count_if(repeated) AS n_repeated, count_if(near AND NOT repeated) AS n_near,
    string_agg(line_no::VARCHAR, ',' ORDER BY line_no) FILTER (repeated OR near) AS dropped FROM marked GROUP BY doc)
SELECT doc_id, coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_repeated, 0)::BIGINT AS n_repeated, coalesce(n_near, 0)::BIGINT AS n_near, coalesce(dropped, '') AS dropped
FROM (SELECT DISTINCT doc_id, name FROM t) t LEFT JOIN found ON found.doc = row(t.doc_id IS NULL, coalesce(t.doc_id, 0), t.name)""")
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated and nearly repeated lines of every document; texts that share an id have rows of their own."""
    found = lines.per_document(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("name")
    return found.withColumn("dropped", F.array_join(F.transform("dropped", lambda n: n.cast("string")), ","))


@query("op11_whitening")
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened components of every vector. No SQL: eigenvectors."""
    return whitening.whitened(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op12_packing")
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in sequences of 2,048 tokens. No SQL: a tokenizer."""
    import public_tokenizers

    small_batches(spark)
    found = packing.packed(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), F.col("sequence").alias("sequence_id"), "offset")


@query("op13_hard_negatives", """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS MATERIALIZED (SELECT q.vec_id AS anchor_id, c.vec_id, q.label = c.label AS alike, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM (SELECT DISTINCT * FROM v WHERE vec_id % 100 = 0) q JOIN v c ON q.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of five positives of every hundredth vector; the label of every seventh is moved on by one first."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")), lambda i: i % 100 == 0)


def load() -> tuple[dict, dict]:
    return dict(QUERIES), dict(ORACLES)
