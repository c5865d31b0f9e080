"""As-of lookups and contract numbers against brute force; one key holds most rows."""

import datetime
import random

import pytest

from marketframe.operators import asof
from marketframe.plans import futures

D0 = datetime.date(2020, 1, 1)


def day(n):
    return None if n is None else D0 + datetime.timedelta(days=n)


@pytest.mark.parametrize("lookback", [0, 1, 10, 32, 100])
def test_as_of(spark, lookback):
    r = random.Random(lookback)
    values = {("hot", n): float(r.randrange(100)) for n in r.sample(range(2000), 700)} | {(k, r.randrange(400)): float(k == "b") for k in "abc" for _ in range(5)}
    points = [("hot", r.randrange(-50, 2100), i) for i in range(5000)] + [(r.choice("abcd"), r.randrange(500), i) for i in range(200)] + [(None, 5, -1), ("a", None, -2), (None, None, -3)]
    v = spark.createDataFrame([(k, day(n), x) for (k, n), x in values.items()] + [(None, day(4), 9.0), ("a", None, 9.0)], "who string, seen date, x double").repartition(4)
    p = spark.createDataFrame([(k, day(n), i) for k, n, i in points], "k string, dt date, i int").repartition(4)
    got = {x["i"] + (10_000 if x["k"] == "hot" else 0): (x["as_of"], x["x"]) for x in asof.as_of(p, v, "k", "dt", ["x"], lookback, value_key="who", value_day="seen").collect()}
    assert len(got) == len(points)
    for k, n, i in points:
        near = next(((day(m), values[k, m]) for m in range(n, n - lookback - 1, -1) if (k, m) in values), (None, None)) if k and n is not None else (None, None)
        assert got[i + (10_000 if k == "hot" else 0)] == near


def chains(seed):
    r = random.Random(seed)
    chain = [("R1 Index", f"C{i:04}", day(r.randrange(0, 4000, 5))) for i in range(600)]  # ties on one day
    chain += [("S1 Index", f"S{i}", day(40 * i)) for i in range(5)] + [("S1 Index", "S2", day(1)), ("S1 Index", "none", None), (None, "x", day(9))]
    points = [(f"{r.choice('RST')}{r.randrange(1, 10)} Index", day(r.randrange(-10, 4050))) for _ in range(3000)] + [("R1 Index", None), ("S2 Index", day(0)), ("S2 Index", day(0))]
    return chain, points


def live(chain, root, date):
    last = {}
    for k, c, e in chain:
        if k == root and k is not None and e is not None:
            last[c] = max(last.get(c, e), e)
    return sorted((e, c) for c, e in last.items() if date is not None and e > date)


def frames(spark, chain, points):
    return (spark.createDataFrame(chain, "gen_ticker string, contract string, last_trade_date date").repartition(3),
            spark.createDataFrame(points, "gen_ticker string, dt date").repartition(3))


@pytest.mark.parametrize("n", [1, 2, 7, 0])
def test_nth_contract_of_a_long_chain(spark, n):
    chain, points = chains(n)
    points = [("R1 Index" if k[0] == "R" else "S1 Index", d) for k, d in points]
    c, p = frames(spark, chain, points)
    key = lambda x: tuple(map(str, x))
    got = sorted(((x["gen_ticker"], x["dt"], x["contract"], x["expiry"]) for x in futures.nth_contract(p, c, n).collect()), key=key)
    want = []
    for k, d in points:
        rest = live(chain, k, d)
        e, name = rest[n - 1] if 1 <= n <= len(rest) else (None, None)
        want.append((k, d, name, e))
    assert got == sorted(want, key=key)


def test_fut_ticker_of_every_index(spark):
    chain, points = chains(11)
    c, p = frames(spark, chain, points)
    got = sorted(str((x["gen_ticker"], x["dt"], x["contract"])) for x in futures.fut_ticker(p, c).collect())
    want = []
    for k, d in points:
        rest = live(chain, f"{k[0]}1 Index", d)
        want.append(str((k, d, rest[int(k[1]) - 1][1] if len(rest) >= int(k[1]) else None)))
    assert got == sorted(want)


def test_active_futures_of_one_contract_with_many_points(spark):
    """Two contracts, thousands of points: at most two rows a point, whatever the look-back."""
    r = random.Random(5)
    chain = [("R1 Index", "FRONT", day(3000)), ("R1 Index", "NEXT", day(3050))]
    points = [(f"R{k} Index", day(n)) for n in range(0, 3100) for k in (1, 2)]
    volume = {(c, n): r.randrange(50) for c in ("FRONT", "NEXT") for n in r.sample(range(2900, 3060), 60)}
    hist = spark.createDataFrame([(c, day(n), "volume", str(v)) for (c, n), v in volume.items()] + [("FRONT", day(2990), "VOLUME", "n/a")], "ticker string, date date, field string, value string")
    c, p = frames(spark, chain, points)
    latest = lambda name, n: next((volume[name, m] for m in range(n, n - 11, -1) if (name, m) in volume), None)
    got = {(x["gen_ticker"], x["dt"]): x["contract"] for x in futures.active_futures(p, c, hist).collect()}
    assert len(got) == len(points)
    for k, d in points:
        n, rest = (d - D0).days, live(chain, "R1 Index", d)
        want = rest[0][1] if rest else None
        if len(rest) == 2 and (d.year, d.month) >= (rest[0][0].year, rest[0][0].month):
            front, second = latest("FRONT", n), latest("NEXT", n)
            want = "NEXT" if second is not None and (front is None or second > front) else "FRONT"
        assert got[k, d] == want


def test_last_row_of_a_doubled_cell_counts(spark):
    chain = [("R1 Index", "A", day(40)), ("R1 Index", "B", day(70))]
    c, p = frames(spark, chain, [("R1 Index", day(39))])
    rows = [("A", day(38), "VOLUME", "9", 0), ("A", day(38), "VOLUME", "1", 1), ("B", day(38), "VOLUME", "5", 2)]
    hist = spark.createDataFrame(rows, "ticker string, date date, field string, value string, pos int")
    assert futures.active_futures(p, c, hist).first()["contract"] == "B"
    assert futures.active_futures(p, c, hist.drop("pos")).first()["contract"] == "A"


def test_lookups_neither_list_nor_multiply(spark):
    chain, points = chains(3)
    c, p = frames(spark, chain, points)
    hist = spark.createDataFrame([("C0001", day(3), "VOLUME", "1")], "ticker string, date date, field string, value string")
    plan = futures.active_futures(p, c, hist)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan
    assert "Join" not in plan
