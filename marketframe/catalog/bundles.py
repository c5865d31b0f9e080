"""Queries of the field bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketframe import refdata
from marketframe.catalog.registry import query
from marketframe.plans import bundles
from marketframe.sources import adapters as A


def _column(i: int, field: str) -> str:
    if field in refdata.TEXT_FIELDS:
        value = f"concat('T{i}-', p_brand)"
    elif field in refdata.DATE_FIELDS:
        value = f"DATE '2000-01-01' + CAST(p_partkey % 3000 + {i} AS INT)"
    else:
        value = f"CAST((p_partkey * {i + 1}) % 1000 AS DOUBLE)"
    return f"CASE WHEN (p_partkey + {i}) % 7 <> 0 THEN {value} END AS \"{field}\""


def _sql(bundle: str) -> str:
    cols = ", ".join(_column(i, f) for i, f in enumerate(refdata.BUNDLES[bundle]))
    return f"SELECT concat('P', CAST(p_partkey AS VARCHAR), ' US Equity') AS ticker, {cols} FROM part"


def _add(bundle: str) -> None:
    @query(bundle, _sql(bundle))
    def run(spark, path):
        return bundles.field_bundle(A.bundle_ref(spark, path, bundle), bundle)


for _name in refdata.BUNDLES:
    if _name != "cdx_curve":
        _add(_name)


@query("cdx_curve", """
SELECT concat('CDX C', CAST(c_custkey AS VARCHAR), ' CDSI GEN 5Y Corp') AS gen_ticker, concat('CDX C', CAST(c_custkey AS VARCHAR), ' CDSI GEN ', t, ' Corp') AS ticker,
  CAST(c_custkey * n AS DOUBLE) AS "PX_LAST", CAST(NULL AS DOUBLE) AS "UPFRONT_LAST", CAST(NULL AS DOUBLE) AS "CDS_FLAT_SPREAD", CAST(NULL AS DOUBLE) AS "SW_CNV_BPV",
  t AS "CURRENT_TENOR" FROM customer, (VALUES ('3Y', 3), ('5Y', 5), ('7Y', 7), ('10Y', 10)) x(t, n)""")
def cdx_curve(spark, path):
    c = A.table(spark, path, "customer")
    stem = F.concat(F.lit("CDX C"), F.col("c_custkey").cast("string"), F.lit(" CDSI GEN "))
    tenors = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(int(t[:-1])).alias("n")) for t in ("3Y", "5Y", "7Y", "10Y", "20Y")])
    rows = c.select("c_custkey", F.inline(tenors)).select(
        F.concat(F.lit("CDX C"), F.col("c_custkey").cast("string"), F.lit(" CDSI GEN "), "t", F.lit(" Corp")).alias("ticker"),
        F.inline(F.array(
            F.struct(F.lit("PX_LAST").alias("field"), (F.col("c_custkey") * F.col("n")).cast("string").alias("value")),
            F.struct(F.lit("CURRENT_TENOR").alias("field"), F.col("t").alias("value")))))
    return bundles.cdx_curve(rows, c.select(F.concat(stem, F.lit("5Y Corp")).alias("ticker")))


def _add_bulk(name: str, field: str) -> None:
    @query(name, f"SELECT ticker, field, payment_date, coupon, principal FROM cashflows WHERE field = '{field}'")
    def run(spark, path):
        return bundles.bulk_bundle(A.cashflows(spark, path), name)


for _name, _field in bundles.BULK_FIELDS.items():
    _add_bulk(_name, _field)
