"""Each operator against brute force or SQL on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import glob
import hashlib
import itertools
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import check
import corpus_pipeline
from marketframe.llm import chat, decontaminate, langid, licenses, lines, mixing, pii, queries, shards, simhash, topk

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river stone cloud window garden paper silver winter market bridge candle forest engine letter mirror orange pocket signal timber velvet".split()


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))


LONG = prose(20_000, 1)
ODD = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, "  \n ", "en", "a", 3), (4, LONG, "en", "a", len(LONG)), (5, prose(80, 2), "de", "b", 1),
       (5, prose(80, 2), "de", "b", 1), (6, prose(80, 2), None, "b", 1), (None, prose(60, 3), "de", None, 1), (7, "été ☃ 𝒳 ñandú", "fr", "c", 9),
       (8, prose(79, 2) + " changed", "de", "b", 1)]


def frame(spark, rows, schema=SCHEMA):
    """Rows with extra columns whose names clash with those of the operators."""
    df = spark.createDataFrame(rows, schema).repartition(3)
    return df.selectExpr("*", "1 AS id", "'x' AS shard", "0 AS size", "'y' AS Text_", "2 AS node", "3 AS seed", "4 AS drawn")


@pytest.fixture()
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture()
def none(spark):
    return frame(spark, [])


def text(t):
    return t or ""


# sharding


def test_shards(spark, odd, tmp_path):
    got = shards.assign(odd, 8, map_path=str(tmp_path / "map")).collect()
    assert sorted((str(r["id"]), r["size"], r["crc"]) for r in got) == sorted((str(i), len(text(t).encode()) + 1, zlib.crc32(text(t).encode())) for i, t, *_ in ODD)
    for _, rows in itertools.groupby(sorted(got, key=lambda r: r["shard"]), key=lambda r: r["shard"]):
        rows = list(rows)
        assert sorted(r["position"] for r in rows) == list(range(len(rows)))
    assert shards.load_map(spark, str(tmp_path / "map"), 1) == shards.first_map(8)


def test_shards_are_even_and_grow_into_the_new_one():
    r = random.Random(5)
    sizes = [r.randrange(1, 4000) for _ in range(shards.SLOTS)]
    even = shards.rebalance(shards.first_map(8), sizes, 8)
    total = [sum(s for s, x in zip(sizes, even) if x == k) for k in range(8)]
    assert max(total) - min(total) <= 50
    grown = shards.grow(even, sizes, 8)
    assert all(b in (a, 8) for a, b in zip(even, grown))
    new = sum(s for s, x in zip(sizes, grown) if x == 8)
    assert abs(new - sum(sizes) / 9) < 2000


# decontamination


def test_leaks(spark):
    items = [(1, prose(30, 10)), (2, prose(12, 11)), (3, prose(6, 12)), (4, "too short"), (5, None), (6, prose(30, 10))]
    words = lambda s: s.split()
    swapped = words(items[0][1])
    for i in (4, 9, 14, 19, 24):
        swapped[i] = "other"
    tested = [(1, f"before {items[0][1].upper()}, after"), (2, "x " + " ".join(swapped) + " y"), (3, items[1][1]), (4, "a " + items[2][1]), (5, prose(300, 13)),
              (6, None), (7, ""), (None, items[1][1]), (8, LONG + " " + items[0][1]), (9, items[3][1]), (9, prose(40, 14))]
    docs = frame(spark, [(i, t, "en", "a", 0) for i, t in tested])
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((str(r["id"]), r["n_tokens"], tuple(r["items"])) for r in decontaminate.leaks(docs, bench).collect()))
    want = {1: (1, 6), 2: (1, 6), 3: (2,), 4: (3,), None: (2,), 8: (1, 6)}
    assert got == sorted((str(i), len(re.findall(r"[^\W_]+", text(t))), want.get(i, ())) for i, t in tested)
    kept = decontaminate.remove_leaked(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [5, 6, 7, 9, 9]


def test_leaks_of_empty_tables(spark, odd, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(none, bench).count() == 0
    assert decontaminate.remove_leaked(odd, bench).count() == len(ODD)


def test_leaks_are_told_apart_by_id_and_text(spark):
    item = prose(30, 10)
    tested = [(None, "a " + item), (None, prose(40, 1)), (None, None), (5, "b " + item), (5, prose(40, 2))]
    docs = frame(spark, [(i, t, "en", "a", 0) for i, t in tested])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((str(r["id"]), r["n_tokens"], r["items"]) for r in decontaminate.leaks(docs, bench).collect()) == [
        ("5", 31, [1]), ("5", 40, []), ("None", 0, []), ("None", 31, [1]), ("None", 40, [])]
    kept = decontaminate.remove_leaked(docs, bench).collect()
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept) == sorted((str(i), str(t)) for i, t in tested if item not in text(t))


def test_seeds_miss_no_tolerated_placement(spark):
    """All placements of two substitutions in items of 10 to 13 tokens and in a bare window of a longer one."""
    spans = {n: prose(n, 400 + n).split() for n in (10, 11, 12, 13)} | {40: prose(40, 440).split()}
    rows, want = [], []
    for n, words in spans.items():
        part = words[20: 33] if n == 40 else words
        for k in (2, 3):
            for p in itertools.combinations(range(len(part)), k):
                rows.append((len(rows), " ".join("other" if i in p else w for i, w in enumerate(part)), "en", "a", 0))
                want.append([n] if k == 2 else [])
        for front, end, i in itertools.product(range(3), range(3), range(-1, len(part))):  # the text begins or ends within the passage
            cut = ["other" if k == i else w for k, w in enumerate(part)][front: len(part) - end]
            if front + end and front + end + ("other" in cut) <= 2:
                rows.append((len(rows), " ".join(cut), "en", "a", 0))
                want.append([n])
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in spans.items()], "item_id long, text string")
    got = {r["id"]: r["items"] for r in decontaminate.leaks(frame(spark, rows), bench).collect()}
    assert [got[i] for i in range(len(rows))] == want
    for n in range(5, 21):
        own = tuple("1" * i + "0" + "1" * (n - i - 1) for i in range(n)) if n < 11 else ()
        assert not decontaminate.missed(n, decontaminate.MASKS + own + decontaminate.more_masks(n, decontaminate.MASKS + own))


def test_sampling_decides_each_document(spark):
    """Documents without an id are drawn one by one, and those that share an id by their own cells."""
    rows = [(None, prose(20, i), "en", "a", 0) for i in range(300)] + [(i, prose(20, i), "en", s, 0) for i in range(100) for s in ("b", "c")]
    goals = mixing.Targets({"a": 0.6, "b": 0.1, "c": 0.3}, {"en": 1.0}, {"general": 1.0})
    docs = frame(spark, rows)
    got = mixing.sampled(docs, goals, 0.3)
    assert got.columns == docs.columns
    kept = [r["source"] for r in got.collect()]
    assert 60 <= kept.count("a") <= 120 and kept.count("b") <= 30 and 25 <= kept.count("c") <= 65


# simhash


def fingerprint(t, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", text(t).translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(words[i: i + width]) for i in range(len(words) - width + 1)] if len(words) >= width else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {n: find(n) for n in nodes}


def test_simhash_groups(spark, odd):
    got = {(r["id"], r["fp"] % 2**64): r["group"] for r in simhash.groups(odd).collect()}
    prints = {i: fingerprint(t) for i, t, *_ in ODD}
    assert {k for k in got} == {(i, f) for i, f in prints.items()}
    root = roots_of(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    for (i, f), group in got.items():
        assert group == min(j for j in prints if j is not None and root[prints[j]] == root[f]) if any(j is not None and root[prints[j]] == root[f] for j in prints) else group is None


@pytest.mark.parametrize("max_run", [4096, 3])
def test_simhash_links_lose_nothing(spark, max_run):
    r = np.random.default_rng(7)
    bases = r.integers(0, 2**63, 5)
    points = {int(b) for b in bases}
    for b in bases.tolist():  # a dense ball and a chain around each
        for _ in range(60):
            points.add(b ^ sum(1 << int(x) for x in r.choice(63, r.integers(1, 7), replace=False)))
    points = sorted(points)
    df = spark.createDataFrame([(p,) for p in points], "fp long").repartition(4)
    links = [(x["a"], x["b"]) for x in simhash.links(df, 3, max_run).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    want = roots_of(points, lambda a, b: (a ^ b).bit_count() <= 3)
    pairs = spark.createDataFrame(links, "a long, b long")
    found = {x["node"]: x["root"] for x in simhash.components(pairs).collect()}
    assert {p: found.get(p, p) for p in points} == want


def test_components_of_a_long_chain(spark):
    nodes = list(range(200))
    random.Random(3).shuffle(nodes)
    chain = [(max(a, b), min(a, b)) for a, b in itertools.pairwise(nodes)]
    got = simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {n: 0 for n in range(1, 200)}


def test_one_of_each(spark, odd, none):
    got = simhash.one_of_each(odd)
    assert got.columns == odd.columns
    # empty texts are one group, the equal texts and the nearly equal one another
    assert sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "4", "5", "7", "None"]
    assert simhash.one_of_each(none).count() == 0


def test_one_of_each_is_the_first_of_each_component(spark):
    """Copies with a few words edited; the whole answer against all pairs of fingerprints."""
    r, rows = random.Random(11), []
    for g in range(30):
        words = prose(400, 100 + g).split()
        for _ in range(6):
            copy = list(words)
            for _ in range(r.choice([0, 1, 1, 8])):
                copy[r.randrange(len(copy))] = "edit" + str(r.randrange(1000))
            rows.append((len(rows), " ".join(copy), "en", "a", 0))
    rows += [(None, rows[0][1], "en", "a", 0), (None, None, None, None, None), (None, "", None, None, None), (3, "", None, None, None), (3, rows[3][1], "xx", "a", 0)]
    prints = [fingerprint(t) for _, t, *_ in rows]
    root = roots_of(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    assert 30 < len(set(root.values())) < len(root)
    got = [(x["doc_id"], x["text"]) for x in simhash.one_of_each(frame(spark, rows)).collect()]
    best = {}
    for (i, *_), f in zip(rows, prints):
        best[root[f]] = min(best.get(root[f], (True, 0)), (i is None, i or 0))
    assert sorted((i is None, i or 0) for i, _ in got) == sorted(best.values())
    assert sorted(root[fingerprint(t)] for _, t in got) == sorted(best)


# personal data


BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(t):
    out = []
    for k, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, t):
            digits = re.sub(r"\D", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),  # noqa: B023
                    "card": lambda: 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]  # noqa: B023
            if good():
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r = random.Random(2)
    pieces = ["a@b.c", "x.y@z-1.org", "@", ".", "..", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+", "-", " ", "_d@e.f",
              "é", "12", "%", "b@c", "00010.1.2.255", "+12 345 678 9012 345 67", "378282246310005"]
    for _ in range(3000):
        t = "".join(r.choice(pieces) for _ in range(r.randrange(1, 9)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_personal_data(spark, none):
    name = "zorblax"
    rows = [(i, f"{prose(20, i)} {name} me@x.org {prose(20, i + 500)}", "en", "a", 0) for i in range(3)]
    rows += [(10 + i, prose(60, 700 + i), "en", "a", 0) for i in range(40)] + [(99, None, "en", "a", 0), (100, "", "en", "a", 0), (100, "", "en", "a", 0), (None, "call +1 555 123 4567", "en", "a", 0)]
    docs = frame(spark, rows)
    got = pii.personal_data(docs).withColumn("text", pii.spans_text(F.col("spans"))).collect()
    assert len(got) == len(rows)
    by = {(r["id"], r["at"]): r for r in got}
    for i, t, *_ in rows:
        r = next(x for (j, _), x in by.items() if j == i)
        base = ",".join(f"{BASE[k][0]}:{a}:{b}" for a, k, b in plain_spans(text(t)))
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r["text"].split(","))
    first = next(r for r in got if r["id"] == 0)
    at = rows[0][1].index(name)
    assert f"remove:{at}:{at + len(name)}" in first["text"].split(",")
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert "[email]" in texts[0] and name not in texts[0] and texts[10] == rows[3][1] and texts[99] is None and "[phone]" in texts[None]
    assert pii.personal_data(none).count() == 0


def test_terms_far_from_a_value_are_found_everywhere(spark):
    name = "zorblax"
    rows = [(i, f"{name} {prose(30, i)} me@x.org {prose(30, i + 500)} {name.upper()} end", "en", "a", 0) for i in range(3)]
    rows += [(9, f"{prose(30, 8)} me@x.org and you@y.org", "en", "a", 0), (None, f"you@y.org {prose(20, 9)}", "en", "a", 0)]
    rows += [(10 + i, prose(400, 700 + i), "en", "a", 0) for i in range(40)]
    got = {r["id"]: [tuple(s) for s in r["spans"]] for r in pii.personal_data(frame(spark, rows)).collect()}
    total = len(rows)
    for i, t, *_ in rows:
        base = plain_spans(t)
        values = {t[a:b] for a, _, b in base}
        want = [tuple(x) for x in base]
        outside = lambda m: not any(a < m.end() and m.start() < b for a, _, b in base)  # noqa: B023, E731
        for m in re.finditer(r"[^\W_]+", t):
            if not outside(m):
                continue
            best = 0
            for v in values:
                with_v = [x for _, x, *_ in rows if v in x]
                n_t = sum(m[0].lower() in re.findall(r"[^\W_]+", x.lower()) for _, x, *_ in rows)
                n_te = sum(m[0].lower() in re.findall(r"[^\W_]+", x.lower()) for x in with_v)
                best = max(best, 1 - np.log(n_t / n_te) / np.log(total / len(with_v)))
            if best >= 0.7 and len(m[0]) > 1:
                want.append((m.start(), 4 if best >= 0.9 else 5, m.end()))
        assert got[i] == sorted(want)
    first = rows[0][1]
    assert {(0, 4, 7), (first.index("ZORBLAX"), 4, first.index("ZORBLAX") + 7)} <= set(got[0])


# mixing


def test_mixing(spark, none):
    r = random.Random(9)
    rows = [(i, prose(r.randrange(1, 80), i), r.choice(["en", "de", None]), r.choice(["a", "a", "a", "b", "z"]), 0) for i in range(600)] + [(1000, None, "en", "a", 0), (1001, "", None, None, 0)]
    goals = mixing.Targets({"a": 0.3, "b": 0.5, mixing.OTHER: 0.2}, {"en": 0.5, "de": 0.3, mixing.OTHER: 0.2}, {"general": 1.0})
    got = mixing.mix(frame(spark, rows), goals, 0.3).collect()
    assert len(got) == len(rows)
    cells = {}
    for x in got:
        cells.setdefault((x["source"], x["lang"], x["topic"]), [0, x["p"]])[0] += x["tokens"]
    total = sum(n for n, _ in cells.values())
    fitted = mixing.rake_bounded({c: n for c, (n, _) in cells.items()}, goals, 0.3 * total)
    for i, dim in enumerate(mixing.DIMENSIONS[:2]):
        for k, share in getattr(goals, dim).items():
            assert abs(sum(n for c, n in fitted.items() if c[i] == k) - share * 0.3 * total) < 1e-4 * total
    assert all(abs(p - min(1, fitted.get(c, n) / n if n else 1)) < 1e-9 for c, (n, p) in cells.items())
    for x in got:
        assert x["drawn"] == (int(hashlib.md5(f"mix:{x['id']}".encode()).hexdigest()[:8], 16) < x["p"] * 2**32)
    assert mixing.mix(none, goals, 0.3).count() == 0 and mixing.sampled(none, goals, 0.3).count() == 0


def test_capped_probabilities_meet_the_targets(spark):
    """Small cells are asked for more than they hold: others of their categories make up for it."""
    r = random.Random(19)
    rows = [(i, prose(r.randrange(20, 60), i), "en" if i % 4 < 2 else "de", "a" if i % 2 else "b", 0) for i in range(800)]
    goals = mixing.Targets({"a": 0.6, "b": 0.4}, {"en": 0.4, "de": 0.6}, {"general": 1.0})
    for keep, least in ((0.74, 0.74), (0.95, 0.8)):  # the second is infeasible: half of all tokens are not enough for 60 % of 95 %
        kept = {}
        for x in mixing.mix(frame(spark, rows), goals, keep).collect():
            assert 0 <= x["p"] <= 1
            for c in (x["source"], x["lang"], "all", "had"):
                kept[c] = kept.get(c, 0.0) + x["tokens"] * (1 if c == "had" else x["p"])
        assert kept["all"] >= (least - 0.01) * kept["had"]
        for k, share in (goals.source | goals.lang).items():
            assert abs(kept[k] / kept["all"] - share) < 1e-3
    cells = {("a", "en", "g"): 900, ("a", "de", "g"): 10, ("b", "en", "g"): 500, ("b", "de", "g"): 500}
    fitted = mixing.rake_bounded(cells, mixing.Targets({"a": 0.5, "b": 0.5}, {"en": 0.5, "de": 0.5}, {}), 1000)
    assert all(fitted[c] <= n + 1e-6 for c, n in cells.items()) and sum(fitted.values()) == pytest.approx(1000, rel=1e-3)
    assert all(abs(want - got) < 1e-3 for _, _, want, got in mixing.shares(fitted, mixing.Targets({"a": 0.5, "b": 0.5}, {"en": 0.5, "de": 0.5}, {})))


def test_targets_from_the_table_are_met_in_full(spark):
    """The whole answer of the query against a plain computation of its cells; total and shares within one percent."""
    for sf, keep in (("sf0.001", 0.5), ("sf0.01", 0.5), ("sf0.01", 0.8)):
        docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
        got = queries.QUERIES["op2_mixing"](spark, f"/root/testdata/{sf}").collect() if keep == queries.MIX_KEEP else mixing.mix(docs, None, keep).withColumnRenamed("id", "doc_id").collect()
        by = {r["doc_id"]: r for r in docs.collect()}
        assert len(got) == len(by)
        had, kept, cells = {}, {}, {}
        for x in got:
            d = by[x["doc_id"]]
            topic = next((name for name, marks in mixing.TOPICS if any(m in text(d["text"]) for m in marks)), "general")
            assert (x["source"], x["lang"], x["topic"], x["tokens"]) == (d["source"], d["lang"], topic, len(re.findall(r"[^ \t\n\x0b\f\r]+", text(d["text"]))))
            assert x["drawn"] == (int(hashlib.md5(f"mix:{x['doc_id']}".encode()).hexdigest()[:8], 16) < x["p"] * 2**32) and 0 <= x["p"] <= 1
            cells.setdefault((x["source"], x["lang"], x["topic"]), set()).add(x["p"])
            for k in (("all",), *zip(mixing.DIMENSIONS, (x["source"], x["lang"], x["topic"]))):
                had[k], kept[k] = had.get(k, 0) + x["tokens"], kept.get(k, 0.0) + x["tokens"] * x["p"]
        assert all(len(p) == 1 for p in cells.values())
        assert kept["all",] == pytest.approx(keep * had["all",], rel=0.01)
        for dim in mixing.DIMENSIONS:
            goals = mixing.flattened({k[1]: n for k, n in had.items() if k[0] == dim}, keep)
            for k, goal in goals.items():
                assert kept[dim, k] / kept["all",] == pytest.approx(goal, rel=0.01, abs=2e-4)


def test_flattened_shares():
    goals = mixing.flattened({"big": 900, "small": 90, "tiny": 10, "none": 0}, 0.25)
    assert sum(goals.values()) == pytest.approx(1) and goals["big"] < 0.9 and 0.09 < goals["small"] <= 0.18 + 1e-9 and 0.01 < goals["tiny"] <= 0.02 + 1e-9 and "none" not in goals
    assert mixing.flattened({"a": 3, "b": 1}, 1.0) == pytest.approx({"a": 0.75, "b": 0.25}) and mixing.flattened({}, 0.5) == {}


# search


@pytest.mark.parametrize("scale, least", [(64, 4), (1 << 24, 32)])
def test_topk(spark, scale, least):
    r = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in r.normal(0, r.choice([0.2, 1, 3]), 12)]) for i in range(400)]
    vectors += [(400 + i, vectors[3][1]) for i in range(60)] + [(500, None), (520, [1.0, None]), (540, [float("nan")] * 12), (560, [float("inf")] * 12), (580, []), (600, [0.5] * 5), (None, [1.0] * 12), (600, [0.5] * 5)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS v", "3 AS norm").repartition(3)
    got = sorted((x["query_id"], x["rank"], x["id"], x["score"]) for x in topk.top_k(df, lambda i: i % 20 == 0, 20, scale=scale, strata_rows=50, least_strata=least).collect())
    whole = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {(q, tuple(v)) for q, v in whole if q % 20 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in whole if c != q)[:20]
        want += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scores)]
    assert got == sorted(want)


def test_topk_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(none, lambda i: i % 20 == 0).count() == 0


# licences


def test_expressions():
    assert licenses.postfix("MIT OR Apache-2.0 AND GPL-2.0 WITH Classpath-exception") == ["mit", "apache-2.0", "gpl-2.0", "classpath-exception", "with", "and", "or"]
    assert licenses.evaluate("(MIT OR GPL-3.0)")[1] == pytest.approx(0.1) and licenses.evaluate("MIT AND GPL-3.0")[1] == pytest.approx(0.7)
    assert licenses.evaluate("GPL-2.0 WITH x AND MIT")[1] == pytest.approx(0.5)
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception OR MIT")[0] == ["gpl-2.0", "mit"]
    tagged = lambda t: licenses.scan(t)[5:]
    assert tagged("x\nSPDX-License-Identifier   \t         : MIT OR GPL-2.0 WITH e-1.0 \r\nmore") == ("gpl-2.0,mit", 0.1, "MIT OR GPL-2.0 WITH e-1.0")
    assert tagged("é spdx-license-identifier:Apache-2.0\n// SPDX-LICENSE-IDENTIFIER: (MIT")[0:3:2] == ("apache-2.0,unreadable", "Apache-2.0 | (MIT")
    assert tagged("spdx license identifier: MIT, notspdx-license-identifier: MIT, spdx-license-identifier MIT") == ("", 0.0, "")
    for bad in ("", "AND", "MIT OR", "(MIT", "MIT)", "MIT GPL", "()", "MIT ! GPL", "(MIT OR BSD) WITH x"):
        assert licenses.evaluate(bad)[0] == ["unreadable"], bad


def test_license_scan(spark, odd, none):
    places = ["cc", "by", "CC BY", "cc-by", "General Public License", "general public", "license", "All rights\nreserved", "all", "rights", "reserved", "é", "x", "mit license", "SPDX-License-Identifier: MIT OR GPL-2.0"]
    r = random.Random(4)
    rows = [(1000 + i, " ".join(r.choice(places) for _ in range(r.randrange(12))), "en", "a", 0) for i in range(200)] + ODD
    got = licenses.license_scan(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {x["id"]: x for x in got}
    for i, t, *_ in rows[:200]:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)}))
        hits = [(k, label) for phrase, label in licenses.BASE for k in range(len(words)) if words[k: k + len(phrase.split())] == phrase.split()]
        x = by[i]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"]) == (len(words), len(hits), min((k for k, _ in hits), default=None), max((k for k, _ in hits), default=None))
        assert x["base_labels"] == ",".join(sorted({label for _, label in hits})) and 0 <= x["score"] <= 1
    assert licenses.license_scan(none).count() == 0


# language


def test_language(spark, none):
    r = random.Random(8)
    stock = {"aa": "the and with from this".split(), "bb": "der und mit von das".split(), "cc": "que para como los una".split()}
    rows = [(i, " ".join(r.choice(stock[lang]) + r.choice(["", "s"]) for _ in range(r.randrange(4, 60))), lang, "s", 0) for i, lang in enumerate(r.choice(sorted(stock)) for _ in range(400))]
    rows += [(1000, None, "aa", "s", 0), (1001, "", "aa", "s", 0), (1002, "12 34 !?", "bb", "s", 0), (1003, rows[0][1], None, "s", 0), (None, "und das", "bb", "s", 0), (1004, "the with " * 100_000, "aa", "s", 0)]
    got = langid.identify(frame(spark, rows)).collect()
    truth = {i: lang for i, _, lang, *_ in rows}
    assert len(got) == len(rows) and all(0 <= x["score"] <= 1 for x in got)
    assert all(x["held_out"] == (x["id"] is not None and zlib.crc32(str(x["id"]).encode()) % 4 == 2) for x in got)
    assert all(x["lang"] == "und" for x in got if x["id"] in (1000, 1001, 1002))
    tested = [x for x in got if x["held_out"] and x["id"] < 1000]
    assert sum(x["lang"] == truth[x["id"]] for x in tested) >= 0.97 * len(tested)
    kept = langid.known_language(frame(spark, rows), 0.4)
    assert 1000 not in {x["doc_id"] for x in kept.collect()} and kept.columns == frame(spark, rows).columns
    assert langid.identify(none).count() == 0
    unlabelled = langid.identify(frame(spark, [(1, "words here", None, "s", 0)])).collect()
    assert [(x["lang"], x["score"]) for x in unlabelled] == [("und", 0.0)]


def test_regularisation_and_temperature():
    f = langid.Ftrl(2, 50, l1=0.5)
    for i in range(200):
        f.learn(np.array([i % 2, 2 + i % 40]), np.array([1.0, 0.1]), i % 2)
    w = f.weights()
    assert (w[:, 2:] == 0).mean() > 0.9 and w[0, 0] > 0 > w[0, 1]
    scores = [np.array([4.0, 0.0])] * 3 + [np.array([4.0, 0.0])]
    assert langid.fit_temperature(scores, [0, 0, 0, 1]) > 2  # three right of four: less sure than the scores say


# lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_within(spark):
    r = random.Random(12)
    pairs = [(*("".join(r.choice("abé") for _ in range(r.randrange(7))) for _ in range(2)),) for _ in range(600)] + [(LONG, LONG[3:]), (LONG, "x" + LONG[:-1]), (LONG, LONG)]
    for edits in (0, 1, 2, 3):
        got = spark.createDataFrame(pairs, "a string, b string").repartition(2).where(lines.within(F.col("a"), F.col("b"), edits)).collect()
        want = [(a, b) for a, b in pairs if (len(a) < 99 and distance(a, b) <= edits) or a == b or (len(a) > 99 and edits >= (3 if a[3:] == b else 2))]
        assert sorted((x["a"], x["b"]) for x in got) == sorted(want)


def test_lines(spark, odd, none, monkeypatch):
    r = random.Random(6)
    stock = [prose(r.randrange(3, 9), 300 + i) for i in range(30)] + ["short", "é" * 25]
    rows = []
    for i in range(80):
        got = []
        for _ in range(r.randrange(6)):
            line = list(r.choice(stock))
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                k = r.randrange(len(line) + 1)
                line[k: k + r.randrange(2)] = r.choice(["", "q", "é"])
            got.append("".join(line) + r.choice(["", " ", "\r"]))
        rows.append((r.choice([i, i, 5, None]) if i else None, "\n".join(got), "en", "a", 0))
    rows += rows[10:14]
    rows += [(900, None, "en", "a", 0), (901, "", "en", "a", 0), (902, "\n\n", "en", "a", 0), (903, LONG, "en", "a", 0), (904, LONG[:-1], "en", "a", 0)]
    docs = frame(spark, rows)

    named = lambda t: int(hashlib.md5(text(t).encode()).hexdigest()[:15], 16)
    place = lambda i, t, n: (i is None, i or 0, named(t), n)
    first, all_lines = {}, []
    for i, t, *_ in rows:
        for n, line in enumerate(text(t).split("\n")):
            if line := line.strip(lines.BLANKS):
                all_lines.append((i, t, n, line))
                first[line] = min(first.get(line, place(i, t, n)), place(i, t, n))
    close = lambda a, b: (a[:-1] == b or b[:-1] == a) if max(len(a), len(b)) > 1000 else distance(a, b) <= 2
    near = {b for a, b in itertools.permutations(first, 2) if min(len(a), len(b)) >= lines.LEAST and abs(len(a) - len(b)) <= 2 and first[a] < first[b] and close(a, b)}
    want = sorted((str(i), named(t), n, first[x] != place(i, t, n), x in near) for i, t, n, x in all_lines)
    assert sorted((str(x["id"]), x["name"], x["line_no"], x["repeated"], x["near"]) for x in lines.dropped_lines(docs).collect()) == want
    assert sum(w[4] for w in want) > 5
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 0)
    assert sorted((str(x["id"]), x["name"], x["line_no"], x["repeated"], x["near"]) for x in lines.dropped_lines(docs).collect()) == want
    assert lines.per_document(docs).count() == len({(r[0], text(r[1])) for r in rows})
    kept = lines.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(rows)
    assert {r["text"] for r in kept.where("doc_id = 904").collect()} == {""}
    assert lines.per_document(none).count() == 0 and lines.deduplicated(odd).count() == len(ODD)


def test_lines_of_documents_that_share_an_id_or_have_none(spark):
    """No line that stands nowhere else is lost."""
    rows = [(None, "only here in the first one\nand this line too, first", "en", "a", 0), (None, "something else altogether\nsecond text without id", "en", "a", 0),
            (5, "one text under the id five", "en", "a", 0), (5, "another text of the same id", "en", "a", 0), (9, "said once\nsaid twice by number nine\nsaid twice by number nine", "en", "a", 0)]
    kept = sorted(r["text"] for r in lines.deduplicated(frame(spark, rows)).collect())
    assert kept == sorted([t for _, t, *_ in rows[:4]] + ["said once\nsaid twice by number nine"])


def changed(line, times, r, letters="q9é"):
    """A line after that many insertions, deletions and substitutions."""
    line = list(line)
    for _ in range(times):
        k = r.randrange(len(line))
        line[k: k + r.randrange(2)] = r.choice(["", *letters])
    return "".join(line)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_of_crowds(spark, monkeypatch, edits):
    """Keys of crowds are told apart by ever smaller blocks; no near line is lost, whatever the edits and wherever they are."""
    monkeypatch.setattr(lines, "CROWD", 1)
    r = random.Random(edits)
    stock = ["a line that many others are like", "page 000 of 000 in this book", "ababababababababababab", "é" * 24]
    all_lines = [changed(r.choice(stock), r.randrange(6), r) for _ in range(110)] + [f"page {a}{b}0 of 000 in this book" for a in range(4) for b in range(4)]
    r.shuffle(all_lines)
    first = {line: n for n, line in reversed([*enumerate(all_lines)])}
    want = sorted({b for a, b in itertools.permutations(first, 2) if first[a] < first[b] and min(len(a), len(b)) >= lines.LEAST and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits})
    got = lines.dropped_lines(frame(spark, [(n, line, "en", "a", 0) for n, line in enumerate(all_lines)]), edits=edits).where("near").collect()
    assert {x["id"] for x in got} == {n for n, line in enumerate(all_lines) if line in want} and len(want) > 30


def test_pairs_of_crowds_grow_with_their_lines(spark, monkeypatch):
    """Neither near copies that differ in words, few of them near lines, nor lines that are all near each other are joined in pairs."""
    pairs = []

    def counted(df, purpose, stored=lines.stored):
        out = stored(df, purpose)
        pairs.append(out.count() if purpose == "line-pairs" else 0)
        return out

    monkeypatch.setattr(lines, "stored", counted)
    r = random.Random(3)
    base, many = prose(60, 1).split(), 400
    words = [" ".join("other" if k in cut else w for k, w in enumerate(base)) for cut in (r.sample(range(len(base)), 2) for _ in range(many))]
    close = [prose(20, 2)[:k % 150] + chr(0x4E00 + k) + prose(20, 2)[k % 150 + 1:] for k in range(many)]
    for family, near in ((words, 0), (close, many - 1)):
        pairs.clear()
        rows = lines.dropped_lines(frame(spark, [(n, line, "en", "a", 0) for n, line in enumerate(dict.fromkeys(family))])).collect()
        assert sum(x["near"] for x in rows) >= near
        assert sum(pairs) < 10 * many, sum(pairs)


# chat


def test_chat(spark):
    turns = []
    for c in range(40):
        r = random.Random(c // 4)
        full = [(r.choice(["user", None]), prose(4, r.randrange(3))) for _ in range(6)]
        for n, (role, t) in enumerate(full[: 1 + random.Random(c).randrange(6)]):
            turns.append((c, n, role, t))
    turns += [(90 + k, n, "user", f"turn {n}") for k, last in enumerate((400, 300, 128)) for n in range(last)]  # several pages of hashes
    turns += [(100, 0, "user", None), (100, 0, "user", None), (100, None, "user", "last"), (None, 0, "user", "x"), (101, 0, "user", None), (102, 0, "user", "tie"), (102, 0, "user", "other")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS id", "2 AS hash", "3 AS turns").repartition(4)
    whole = {}
    for c, n, role, t in sorted(set(turns), key=lambda x: (str(x[0]), x[1] is None, x[1] or 0, x[2] or "unknown", x[3] or "")):
        whole.setdefault(c, []).append((role or "unknown", t or ""))
    kept = {}
    for c, seq in whole.items():
        if not any(len(o) > len(seq) and o[: len(seq)] == seq for o in whole.values()):
            kept.setdefault(tuple(seq), []).append(c)
    want = sorted((str(min((c for c in cs if c is not None), default=None)), len(seq), len(cs), "\n".join(f"<|im_start|>{a}\n{b}<|im_end|>" for a, b in seq)) for seq, cs in kept.items())
    assert sorted((str(x["id"]), x["n_turns"], x["n_copies"], x["text"]) for x in chat.chat_texts(df).collect()) == want
    assert chat.chat_texts(df.limit(0)).count() == 0


# registered queries and the pipeline


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the sample tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    db = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, SMALL)
    cur = db.execute(queries.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert check.rows_of(df.collect(), df.columns) == check.rows_of(cur.fetchall(), names)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the sample tables")
def test_queries_without_sql(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries.QUERIES["op10_sharding"](spark, SMALL).collect():
        raw = text(docs[r["doc_id"]]["text"]).encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None) and 0 <= r["shard"] < 8
    for r in queries.QUERIES["op6_simhash"](spark, SMALL).collect():
        assert r["fingerprint"] == format(fingerprint(docs[r["doc_id"]]["text"]), "016x") and r["component_id"] <= r["doc_id"]
    got = queries.QUERIES["op7_langid"](spark, SMALL).collect()
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in got if r["held_out"]) >= 0.95 * sum(r["held_out"] for r in got)
    for name in ("op1_pii", "op5_licenses"):
        assert queries.QUERIES[name](spark, SMALL).count() == len(docs)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the sample tables")
def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    bench = [decontaminated_words(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    ids = set(rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before, out = docs, stage(spark, docs, SMALL)
        if k < 4:
            assert out.columns == before.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
            ids_now = {r["doc_id"] for r in docs.collect()}
            assert ids_now <= ids
        if name == "near duplicates":
            root = roots_of(sorted({fingerprint(rows[i]["text"]) for i in ids}), lambda a, b: (a ^ b).bit_count() <= 3)
            first = {}
            for i in sorted(ids, reverse=True):
                first[root[fingerprint(rows[i]["text"])]] = i
            assert ids_now == set(first.values())
        if name == "decontamination":
            holds = lambda i: any(f" {w} " in f" {decontaminated_words(rows[i]['text'])} " for w in bench)
            assert {i for i in ids if holds(i)} == ids - ids_now
        if k < 4:
            ids = ids_now
    placed = out.collect()
    assert sorted(r["doc_id"] for r in placed) == sorted(ids) and {r["shard"] for r in placed} <= set(range(8))


def decontaminated_words(t):
    return " ".join(re.findall(r"[^\W_]+", text(t).lower()))
