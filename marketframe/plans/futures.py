"""Generic-to-specific resolution of futures and credit indices, for many dates at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketframe.functions import contracts, dates, values
from marketframe.operators import aggregate, asof, series

LOOKBACK_DAYS = 10


def _counted(points: DataFrame, chain: DataFrame, root: str) -> DataFrame:
    """Points and contracts of each root as one series: ``_run`` counts the contracts that have expired by a row's date, its own included.

    ``_own`` is 1 for contracts. The count is an order statistic: totals of the
    date buckets before, plus the order within the bucket; no root is gathered.
    """
    distinct = chain.groupBy("gen_ticker", "contract").agg(F.max("last_trade_date").alias("expiry"))
    live = distinct.where("expiry IS NOT NULL AND gen_ticker IS NOT NULL").select(
        F.col("gen_ticker").alias("_root"), F.col("contract").alias("_contract"), F.col("expiry").alias("_day"), F.lit(1).alias("_own"))
    rows = points.withColumns({"_root": F.col(root), "_day": F.col("dt"), "_own": F.lit(0)}).unionByName(live, allowMissingColumns=True)
    # a contract that expires on a date is gone on it
    order = [F.col("_day"), F.col("_own").desc(), F.col("_contract")]
    return series.with_running(rows, ["_root"], order, asof.day_bucket(F.col("_day")), {"_run": F.col("_own")})


def _numbered(counted: DataFrame, n: int | Column, ranks: int = 1) -> DataFrame:
    """Points with ``_c0``, ``_c1``, …: contract and expiry of the n-th contract after their date and of those after it.

    A contract meets its points by root and number.
    """
    places = F.explode(F.sequence(F.lit(0), F.lit(ranks - 1)))
    contracts_ = counted.where("_own = 1").withColumn("_rank", places).withColumn("_number", F.col("_run") - F.col("_rank"))
    points = counted.where("_own = 0").withColumn("_number", F.when(F.col("_day").isNotNull() & (n >= 1), F.col("_run") + n))
    both = points.unionByName(contracts_, allowMissingColumns=True)
    of = Window.partitionBy("_root", "_number")
    named = {f"_c{k}": F.max(F.when(F.col("_rank") == k, F.struct(F.col("_contract").alias("contract"), F.col("_day").alias("expiry")))).over(of) for k in range(ranks)}
    known = F.col("_root").isNotNull() & F.col("_number").isNotNull()
    found = both.withColumns(named).where("_own = 0")
    return found.withColumns({c: F.when(known, F.col(c)) for c in named})


def nth_contract(points: DataFrame, chain: DataFrame, n: int | Column = 1) -> DataFrame:
    """The n-th contract by expiry after each point's date; null where the chain is too short.

    ``points``: gen_ticker, dt.
    """
    rank = (F.lit(n) if isinstance(n, int) else n).cast("int")
    found = _numbered(_counted(points.withColumn("n", rank), chain, "gen_ticker"), F.col("n"))
    return found.select(*points.columns, "n", F.col("_c0.contract").alias("contract"), F.col("_c0.expiry").alias("expiry"))


def _roots(points: DataFrame) -> DataFrame:
    """Generic points with the name of their root and the number of the contract they ask for."""
    generic = points.where(~contracts.is_specific_contract(F.col("gen_ticker")))
    return generic.withColumns({"_n": contracts.contract_index(F.col("gen_ticker")) + 1, "_of": contracts.with_generic_index(F.col("gen_ticker"), 1)})


def fut_ticker(points: DataFrame, chain: DataFrame) -> DataFrame:
    """Contract of a generic ticker on a date, from its chain: the index digit picks the n-th."""
    found = _numbered(_counted(_roots(points), chain, "_of"), F.col("_n"))
    return found.select(*points.columns, F.col("_c0.contract").alias("contract"), F.col("_c0.expiry").alias("expiry"))


def futures_candidates(points: DataFrame, freq: str = "monthly", as_of=None, count: Column | None = None) -> DataFrame:
    """Candidate contracts per (generic, date): the next contract months and their tickers.

    The year has one digit when the date lies in the month of ``as_of``.
    """
    n = contracts.candidate_count(F.col("gen_ticker")) if count is None else count
    same = F.lit(False) if as_of is None else F.trunc("dt", "month") == F.trunc(F.lit(as_of).cast("date"), "month")
    generic = points.where(~contracts.is_specific_contract(F.col("gen_ticker")))
    valid = generic.withColumn("_parts", contracts.parse_ticker(F.col("gen_ticker"))).where("_parts is not null")
    rows = valid.select(
        *points.columns, "_parts", F.posexplode(contracts.contract_months(F.col("dt"), freq, n)).alias("rank", "month")
    )
    return rows.withColumn("candidate", contracts.build_futures_ticker(F.col("_parts"), F.col("month"), same)).drop("_parts")


def fut_ticker_candidates(
    points: DataFrame, maturities: DataFrame, freq: str = "monthly", as_of=None
) -> DataFrame:
    """Contract of a generic ticker on a date, from candidate tickers.

    ``maturities``: ticker, maturity (text or date). Candidates whose last
    trading day parses and lies strictly after the date count in order of it.
    """
    due = maturities.select(
        F.col("ticker").alias("candidate"), dates.parse_any_date(F.col("maturity").cast("string")).alias("expiry")
    )
    live = futures_candidates(points, freq, as_of).join(due, "candidate").where(F.col("expiry") > F.col("dt"))
    # a handful of candidates per point: at most the candidate count
    w = Window.partitionBy("gen_ticker", "dt").orderBy("expiry", "candidate")
    ranked = live.withColumn("_rank", F.row_number().over(w))
    wanted = contracts.contract_index(F.col("gen_ticker")) + 1
    return ranked.where(F.col("_rank") == wanted).select("gen_ticker", "dt", F.col("candidate").alias("contract"), "expiry")


def latest_of_two(points: DataFrame, hist: DataFrame, field: str, lookback: int) -> DataFrame:
    """Points with the latest numeric value of the contracts ``first`` and ``second`` in the days up to ``dt``, null without ``_open``.

    An open point looks up two rows as of its date, any other passes through as
    one. Of a doubled cell the last row by ``pos`` counts, or the largest value
    without positions.
    """
    number = values.clean_value(F.col("value").cast("string")).try_cast("double")
    rows = hist.where(F.upper("field") == field.upper()).withColumn("_v", number).where(F.col("_v").isNotNull())
    cell = F.max_by("_v", "pos") if "pos" in hist.columns else F.max("_v")
    cells = rows.groupBy(F.col("ticker").alias("_contract"), F.col("date").alias("_seen")).agg(cell.alias("_v"))
    keys = points.columns
    # a point without a contract has a key of its own, so that null is no hot key
    pair = F.when(F.col("_open"), F.array("first", "second")).otherwise(F.array(F.coalesce("first", "gen_ticker")))
    both = points.select(*keys, F.posexplode(pair).alias("_rank", "_contract"))
    found = asof.as_of(both, cells, "_contract", "dt", ["_v"], lookback, value_day="_seen", at="_seen")
    of = lambda c, rank: F.max(F.when(F.col("_open") & (F.col("_rank") == rank), F.col(c)))
    return found.groupBy(*keys).agg(
        of("_seen", 0).alias("first_date"), of("_v", 0).alias("first_value"), of("_seen", 1).alias("second_date"), of("_v", 1).alias("second_value"))


def active_futures(points: DataFrame, chain: DataFrame, hist: DataFrame, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """The more active of the first two contracts on each date.

    Before the month in which the front contract expires it is the front one;
    from then on the one with the larger latest volume of the look-back, the
    front one on a tie or without volumes. One row per distinct point.
    """
    base = _roots(points.select("gen_ticker", "dt").distinct())
    two = _numbered(_counted(base, chain, "_of"), F.lit(1), ranks=2)
    early = F.trunc("dt", "month") < F.trunc("_c0.expiry", "month")
    compare = ~F.coalesce(early, F.lit(True)) & F.col("_c1").isNotNull()
    two = two.select("gen_ticker", "dt", F.col("_c0.contract").alias("first"), F.col("_c1.contract").alias("second"), compare.alias("_open"))
    compared = latest_of_two(two, hist, "VOLUME", lookback)
    chosen = aggregate.argmax_volume(F.col("first"), F.col("second"), F.col("first_value"), F.col("second_value"))
    return compared.select("gen_ticker", "dt", F.when(F.col("_open"), chosen).otherwise(F.col("first")).alias("contract"))


def _cdx_facts(ref: DataFrame) -> DataFrame:
    """Per generic: series, version and accrual start, with the names of the current and the two earlier series."""
    pick = lambda f: F.max(F.when(F.upper("field") == f, F.col("value")))
    raw = ref.where(F.upper("field").isin("ROLLING_SERIES", "VERSION", "CDS_FIRST_ACCRUAL_START_DATE"))
    wide = raw.groupBy("ticker").agg(
        pick("ROLLING_SERIES").alias("s"), pick("VERSION").alias("v"), pick("CDS_FIRST_ACCRUAL_START_DATE").alias("a")
    )
    parsed = wide.select(
        F.col("ticker").alias("gen_ticker"), contracts.parse_cdx(F.col("ticker")).alias("_p"),
        contracts.parse_series_number(F.col("s")).alias("series"),
        contracts.parse_series_number(F.col("v")).alias("version"), dates.parse_any_date(F.col("a")).alias("accrual"),
    )
    name = lambda back: F.when(F.col("series") > back, contracts.build_cdx(F.col("_p"), F.col("series") - back))
    named = parsed.withColumns({"_now": name(0), "_before": name(1), "_before2": name(2)})
    return named.withColumn("_versioned", contracts.with_version(F.col("_now"), F.col("version"))).drop("_p", "version")


def _cdx_points(points: DataFrame, ref: DataFrame) -> DataFrame:
    """Points of generic credit indices with the names of their series."""
    generic = points.where(contracts.parse_cdx(F.col("gen_ticker"))["is_generic"])
    rows = generic.join(_cdx_facts(ref), "gen_ticker", "left")
    early = F.coalesce(F.col("dt") < F.col("accrual"), F.lit(False)) & (F.col("series") > 1)
    return rows.withColumn("_early", F.coalesce(early, F.lit(False)))


def cdx_ticker(points: DataFrame, ref: DataFrame, with_version: bool = False) -> DataFrame:
    """On-the-run series of a generic credit index on a date.

    Before the accrual start of a series above 1 it is the series before,
    without a version. A generic without a readable series gives null.
    """
    current = F.col("_versioned") if with_version else F.col("_now")
    contract = F.when(F.col("_early"), F.col("_before")).otherwise(current)
    return _cdx_points(points, ref).select("gen_ticker", "dt", contract.alias("contract"), "accrual")


def active_cdx(points: DataFrame, ref: DataFrame, hist: DataFrame, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """The series with the more recent price in the look-back; the current one on a tie or without prices.

    ``ref`` may also hold the accrual start of specific series: before it the
    previous series is the active one.
    """
    rows = _cdx_points(points, ref)
    now = rows.select(
        "gen_ticker", "dt", F.when(F.col("_early"), F.col("_before")).otherwise(F.col("_now")).alias("first"),
        F.when(F.col("_early"), F.col("_before2")).otherwise(F.col("_before")).alias("second"),
    )
    start = _cdx_facts(ref).select(F.col("gen_ticker").alias("first"), F.col("accrual").alias("_start"))
    now = now.join(start, "first", "left")
    early = F.coalesce(F.col("dt") < F.col("_start"), F.lit(False))
    two = now.select("gen_ticker", "dt", "first", "second", early.alias("_early"), (F.col("second").isNotNull() & ~early).alias("_open"))
    last = latest_of_two(two.distinct(), hist, "PX_LAST", lookback)
    older = F.when(F.col("first_date").isNull(), F.col("second_date").isNotNull()).otherwise(
        F.coalesce(F.col("second_date") > F.col("first_date"), F.lit(False))
    )
    settled = F.when(F.col("_early"), F.coalesce("second", "first")).otherwise(F.col("first"))
    chosen = F.when(F.col("_open"), F.when(older, F.col("second")).otherwise(F.col("first"))).otherwise(settled)
    return last.select("gen_ticker", "dt", chosen.alias("contract"))
