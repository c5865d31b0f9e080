"""Field bundles: fixed projections of a snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketframe import refdata
from marketframe.functions import contracts
from marketframe.operators import scan, shape


def field_types(fields: list[str]) -> dict[str, str]:
    return {
        f: "string" if f in refdata.TEXT_FIELDS else "date32" if f in refdata.DATE_FIELDS else "float64"
        for f in fields
    }


def field_bundle(ref: DataFrame, bundle: str, tickers: scan.Tickers = None, **params: str) -> DataFrame:
    """One row per ticker with the bundle's fields as typed columns.

    ``params`` pick precomputed rows by parameter columns of the snapshot, such
    as a settlement date, a benchmark or a recovery rate.
    """
    if bundle not in refdata.BUNDLES:
        raise ValueError(f"unknown bundle {bundle!r}; available: {', '.join(refdata.BUNDLES)}")
    fields = refdata.BUNDLES[bundle]
    rows = scan.only_tickers(ref, tickers).where(F.col("field").isin(fields))
    for col, value in params.items():
        rows = rows.where(F.col(col) == value)
    return shape.format_semi_long(rows, ["ticker"], fields, field_types(fields))


def cdx_curve(ref: DataFrame, generics: DataFrame, tenors: list[str] | None = None) -> DataFrame:
    """Curve fields of every generic credit index at each tenor."""
    wanted = generics.select(
        F.col("ticker").alias("gen_ticker"),
        F.explode(contracts.tenor_tickers(F.col("ticker"), tenors or refdata.CDX_CURVE_TENORS)).alias("ticker"),
    )
    wide = field_bundle(ref, "cdx_curve")
    return wanted.join(wide, "ticker")


# Nested fields offered as their own calls.
BULK_FIELDS = {
    "bond_cashflows": "DES_CASH_FLOW",
    "cdx_cashflows": "CASHFLOW_SCHEDULE",
    "cdx_defaults": "CDS_INDEX_DEFAULT_INFORMATION",
    "cdx_default_prob": "CDS_DEFAULT_PROB",
}


def bulk_bundle(bulk: DataFrame, name: str, tickers: scan.Tickers = None) -> DataFrame:
    """Rows of a nested field by the name of its call."""
    return scan.bulk_scan(bulk, tickers, BULK_FIELDS[name])
