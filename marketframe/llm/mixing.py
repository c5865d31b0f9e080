"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells (source, language, topic). Raking scales the cells'
tokens until their sums over each of the three dimensions meet the target
shares; a document is then sampled with the probability its cell's calibrated
tokens ask for, by a hash of its id, so that a repeated or retried run draws
the same documents.

The caller lists the categories of each dimension and their shares, or they are
taken from the table: the ``MOST_CATEGORIES`` largest of each dimension, their
observed shares flattened. Every other value, and null, is the category
``other``. Cells are therefore at most the product of the lists' lengths, and
only they reach the driver. No cell is ever asked for more than it holds: others
of its categories make up for it.

Defined results: a null or empty text has no tokens and is drawn like any
document of its cell; a cell without tokens keeps probability zero unless it
has such documents only, which stay (probability one); targets of categories
that have no tokens are shared out among the others; rows of equal id draw the
same number and are kept or not by their own cells, those without an id draw by
their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
import json
import logging
import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketframe.llm.common import pick, stored, text_or_empty

OTHER = "other"
# Bounded raking: most rounds, the miss of a share that counts as met, and halvings of the total where targets are infeasible.
BOUNDED_ROUNDS, TOLERANCE, HALVINGS = 300, 1e-4, 12
# Targets from the table: at most so many categories of a dimension, shares as this power of the observed ones.
MOST_CATEGORIES, FLATTENED = 50, 0.7
LOG = logging.getLogger(__name__)
# First rule that matches names a document's topic; plain substrings.
TOPICS = (("license", ("License", "reserved", "Copyright")), ("contact", ("@", "+1 (")), ("table", (" | ",)), ("noise", ("%%%", "$$$", "###", "&&&", "***")))
DIMENSIONS = ("source", "lang", "topic")


@dataclasses.dataclass(frozen=True)
class Targets:
    """Share of the tokens for each category of each dimension; the listed categories need not sum to one."""
    source: dict[str, float]
    lang: dict[str, float]
    topic: dict[str, float]


def topic_of(text: Column) -> Column:
    found = F.lit("general")
    for name, marks in reversed(TOPICS):
        hit = F.lit(False)
        for mark in marks:
            hit = hit | F.contains(text, F.lit(mark))
        found = F.when(hit, F.lit(name)).otherwise(found)
    return found


def token_count(text: Column) -> Column:
    """Words between white space."""
    return F.size(F.array_remove(F.split(text, r"[ \t\n\x0B\f\r]+"), "")).cast("long")


def cells_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
             kept: Sequence[str] = ()) -> DataFrame:
    """Cell and tokens of every document: (id, source, lang, topic, tokens, lot); the lot decides its draw. Columns ``kept`` stay."""
    rows = pick(docs, id=id_col, text=text_col, source=source_col, lang=lang_col, **{c: c for c in kept})
    text = text_or_empty("text")
    return rows.select(
        "id", "source", "lang", topic_of(text).alias("topic"), token_count(text).alias("tokens"),
        F.coalesce(F.col("id").cast("string"), F.concat(F.lit("text "), F.md5(text))).alias("lot"), *kept)


def listed(rows: DataFrame, targets: Targets) -> DataFrame:
    """Categories that the targets do not list become ``other``."""
    return rows.withColumns({d: F.when(F.col(d).isin(list(getattr(targets, d))), F.col(d)).otherwise(F.lit(OTHER)) for d in DIMENSIONS})


def flattened(tokens: dict[str, float], keep: float, power: float = FLATTENED) -> dict[str, float]:
    """Target shares from observed tokens: proportional to a power of their shares, so that large categories give way to small ones.

    No category is asked for more than what it has over the root of ``keep``:
    a mixture of ``keep`` of all tokens can then meet the shares of all
    dimensions together.
    """
    names = sorted(k for k, n in tokens.items() if n > 0)
    if not names:
        return {}
    share = np.array([tokens[k] for k in names], float)
    share /= share.sum()
    most, wanted = share / math.sqrt(min(1.0, max(keep, 1e-9))), share ** power
    factor = _filled(most, wanted, 1.0)
    goal = np.minimum(most, wanted * factor) if math.isfinite(factor) else share
    return dict(zip(names, (goal / goal.sum()).tolist()))


def observed_targets(sums: DataFrame, keep: float, most: int = MOST_CATEGORIES) -> Targets:
    """Targets for a table whose (source, lang, topic, tokens) are given; the driver gets ``most`` categories a dimension and their rest."""
    found = {}
    for d in DIMENSIONS:
        tokens = sums.groupBy(d).agg(F.sum("tokens").alias("n"))
        whole = tokens.agg(F.sum("n")).first()[0] or 0
        top = {r[d]: r["n"] for r in tokens.where(F.col(d).isNotNull()).orderBy(F.desc("n"), d).limit(most).collect()}
        rest = whole - sum(top.values()) + top.pop(OTHER, 0)
        found[d] = flattened(top | {OTHER: rest}, keep)
    return Targets(**found)


def _filled(caps: np.ndarray, free: np.ndarray, goal: float) -> float:
    """Factor x for which the sum of min(caps, x * free) is ``goal``; infinite where all caps together are no more."""
    if caps.sum() <= goal:
        return np.inf
    at = caps / free
    order = np.argsort(at)
    held = np.concatenate(([0.0], np.cumsum(caps[order])[:-1]))
    rest = np.cumsum(free[order][::-1])[::-1]
    x = (goal - held) / rest
    return float(x[np.flatnonzero(x <= at[order])[0]])


def _bounded(had: np.ndarray, members: list[list[tuple[np.ndarray, float]]], total: float, rounds: int) -> tuple[np.ndarray, float]:
    """Raking in which no cell exceeds its tokens, and the largest miss of a category as a share of the total."""
    factors = [np.ones(len(had)) for _ in members]
    fitted = had
    for _ in range(rounds):
        for i, groups in enumerate(members):
            others = np.prod([f for k, f in enumerate(factors) if k != i], axis=0) * had
            for at, share in groups:
                factors[i][at] = min(_filled(had[at], others[at], share * total), 1e30) if share > 0 else 0.0
            fitted = np.minimum(had, others * factors[i])
        miss = max((abs(fitted[at].sum() / total - share) for groups in members for at, share in groups), default=0.0)
        if miss < 1e-9:
            break
    return fitted, miss


def rake_bounded(cells: dict[tuple, int], targets: Targets, total: float, rounds: int = BOUNDED_ROUNDS) -> dict[tuple, float]:
    """Calibrated tokens of every cell, none above what it holds: what a full cell cannot give, others of its categories do.

    Where no such cells meet the targets, the total is lowered to the largest
    at which they are met within ``TOLERANCE``; targets that no total meets
    are approached at the total asked for.
    """
    names = sorted(c for c, n in cells.items() if n > 0)
    had = np.array([float(cells[c]) for c in names])
    if not names or total <= 0:
        return dict.fromkeys(names, 0.0)
    members = []
    for i, dim in enumerate(DIMENSIONS):
        of = np.array([c[i] for c in names])
        goal = {k: getattr(targets, dim).get(k, 0.0) for k in sorted(set(of.tolist()))}
        whole = sum(goal.values())
        if whole > 0:
            members.append([(np.flatnonzero(of == k), g / whole) for k, g in goal.items()])
    # a cell of a category that should have nothing has nothing in the other dimensions either
    out = np.zeros(len(names), bool)
    for groups in members:
        for at, share in groups:
            out[at] |= share <= 0
    had = np.where(out, 1e-300, had)
    most = min([total] + [had[at].sum() / share for groups in members for at, share in groups if share > 0])
    fitted, miss = _bounded(had, members, most, rounds)
    low, high = 0.0, most
    if miss > TOLERANCE:
        for _ in range(HALVINGS):
            middle = (low + high) / 2
            tried, miss = _bounded(had, members, middle, rounds)
            if miss <= TOLERANCE:
                low, fitted = middle, tried
            else:
                high = middle
        if not low:
            fitted = _bounded(had, members, total, rounds)[0]
    return {c: float(n) for c, n in zip(names, np.where(out, 0.0, fitted))}


def shares(fitted: dict[tuple, float], targets: Targets) -> list[tuple[str, str, float, float]]:
    """(dimension, category, target share, achieved share) of calibrated tokens; targets without tokens are shared out among the others."""
    whole = sum(fitted.values())
    out = []
    for i, dim in enumerate(DIMENSIONS):
        wanted = getattr(targets, dim)
        present = sorted({c[i] for c in fitted})
        goals = sum(wanted.get(k, 0.0) for k in present)
        for k in present if goals else ():
            got = sum(n for c, n in fitted.items() if c[i] == k)
            out.append((dim, k, wanted.get(k, 0.0) / goals, got / whole if whole else 0.0))
    return out


def _chances(rows: DataFrame, targets: Targets | None, keep: float) -> tuple[Targets, Column]:
    """The targets, and the probability of the cell of each listed row, a literal table."""
    sums = stored(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-sums")
    targets = targets or observed_targets(sums, keep)
    found = listed(sums, targets).groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")).collect()  # at most the product of the categories
    cells = {tuple(r[d] for d in DIMENSIONS): r["tokens"] for r in found}
    total = keep * sum(cells.values())
    fitted = rake_bounded(cells, targets, total)
    if sum(fitted.values()) < total * (1 - TOLERANCE):
        missed = ", ".join(f"{d} {k} {want:.4f} {got:.4f}" for d, k, want, got in shares(fitted, targets))
        LOG.warning("mixture holds %.0f of %.0f tokens asked for; category, target and achieved share: %s", sum(fitted.values()), total, missed)
    chance = {c: min(1.0, fitted[c] / n) if n else 1.0 for c, n in cells.items()}
    table = F.from_json(F.lit(json.dumps({"\x1f".join(c): p for c, p in chance.items()})), "map<string,double>")
    return targets, table[F.concat_ws("\x1f", *DIMENSIONS)]


def _drawn(seed: str) -> Column:
    """Whether 32 bits of a checksum of the lot fall below the probability."""
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), F.col("lot"))), 1, 8), 16, 10).cast("long")
    return draw < F.col("p") * F.lit(float(1 << 32))


def mix(docs: DataFrame, targets: Targets | None, keep: float, seed: str = "mix", **columns: str) -> DataFrame:
    """Cell, calibrated probability and draw of every document: (id, source, lang, topic, tokens, p, drawn).

    ``keep`` is the share of all tokens the mixture should hold; without
    ``targets`` they are taken from the table.
    """
    rows = stored(cells_of(docs, **columns), "mix-cells")
    targets, chance = _chances(rows, targets, keep)
    return listed(rows, targets).withColumn("p", chance).withColumn("drawn", _drawn(seed)).drop("lot")


def sampled(docs: DataFrame, targets: Targets | None, keep: float, id_col: str = "doc_id", seed: str = "mix", **columns: str) -> DataFrame:
    """The drawn documents, all columns kept; each row is decided by its own cell and lot."""
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    named = {"text_col": "text", "source_col": "source", "lang_col": "lang"} | columns
    cell = cells_of(flat, f"_c{names.index(id_col)}", **{k: f"_c{names.index(c)}" for k, c in named.items()}, kept=flat.columns)
    targets, chance = _chances(cell, targets, keep)
    return listed(cell, targets).withColumn("p", chance).where(_drawn(seed)).select(*flat.columns).toDF(*names)
