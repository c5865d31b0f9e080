"""License scans: Aho-Corasick phrase search and a small licence-expression evaluator.

A text is lower-cased (A-Z) and reduced to its words; one automaton finds all
notice phrases and identifier tags (``SPDX-License-Identifier: …``) as runs of
whole words in a single pass. The expression behind a tag, to the end of its
line, is evaluated by a shunting-yard parser with the precedences WITH > AND >
OR; what follows WITH is an exception, no licence.

The score says how restrictive a document is, 0 (no or no limiting licence) to
1: OR takes the mildest choice, AND the strictest duty, an exception softens
its licence, and all findings of a document hold together.

Defined results: a null or empty text has no words, no labels and score 0; a
malformed expression counts as the licence ``unreadable`` (score 1); equal
findings are reported once in labels but each place counts; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketframe.llm.common import pick

# Phrases every scan reports, with their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
NOTICES = (
    ("apache license", "apache"), ("apache license version 2 0", "apache-2.0"), ("mit license", "mit"),
    ("permission is hereby granted free of charge", "mit"), ("redistribution and use in source and binary forms", "bsd"),
    ("bsd license", "bsd"), ("mozilla public license", "mpl"), ("lesser general public license", "lgpl"),
    ("affero general public license", "agpl"), ("public domain", "public-domain"), ("creative commons", "cc"),
    ("creative commons attribution", "cc-by"), ("cc by sa", "cc-by-sa"), ("cc by nc", "cc-by-nc"), ("cc by nd", "cc-by-nd"),
    ("cc0", "cc0"), ("isc license", "isc"), ("eclipse public license", "epl"), ("do not distribute", "reserved"),
)
# How much a licence limits reuse.
LIMITS = {
    "public-domain": 0.0, "cc0": 0.0, "unlicense": 0.0, "0bsd": 0.0, "mit": 0.1, "isc": 0.1, "bsd": 0.1, "apache": 0.1, "cc-by": 0.2, "cc": 0.3,
    "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.7, "agpl": 0.8, "cc-by-nd": 0.8, "cc-by-nc": 0.9, "reserved": 1.0, "unreadable": 1.0,
}
UNKNOWN_LIMIT, EXCEPTION = 0.6, 0.2
# A tag as its words and as it is written; its expression ends with its line.
TAG_WORDS, TAG = "spdx license identifier", b"spdx-license-identifier"
BEHIND_TAG = re.compile(rb"\s*:[ \t]*([^\r\n]*)")
TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:\-]+")
RANK = {"or": 1, "and": 2, "with": 3}
# Bytes of words stay, A-Z becomes a-z, every other ASCII byte is a blank.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """All phrases and the tag, each between blanks so that only whole words match."""
    labels: dict[str, list[tuple[str, bool]]] = {}
    for phrases, base in ((BASE, True), (NOTICES, False)):
        for phrase, label in phrases:
            labels.setdefault(phrase, []).append((label, base))
    found = ahocorasick.Automaton()
    labels[TAG_WORDS] = [(TAG_WORDS, False)]
    for phrase, what in labels.items():
        found.add_word(f" {phrase} ", (len(phrase) + 2, what))
    found.make_automaton()
    return found


def words_of(text: str | None) -> bytes:
    """The words of a text between single blanks, a blank at either end."""
    return b" " + b" ".join((text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()) + b" "


def phrases_in(words: bytes) -> list[tuple[int, str, bool]]:
    """Every place of every phrase: (first word, label, is it a base phrase)."""
    hits = list(automaton().iter(words.decode("latin-1")))
    if not hits:
        return []
    blanks = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    starts = np.searchsorted(blanks, [end - size + 1 for end, (size, _) in hits])
    return [(int(at), label, base) for at, (_, (_, what)) in zip(starts, hits) for label, base in what]


def expressions_at(text: str, places: list[int]) -> list[str]:
    """The expressions behind the tags that begin at these words."""
    raw = text.encode("utf-8", "surrogatepass")
    inside = np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 32
    starts = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1])))
    found = []
    for at in starts[places].tolist():
        behind = BEHIND_TAG.match(raw, at + len(TAG)) if raw[at: at + len(TAG)].lower() == TAG else None
        if behind:
            found.append(behind[1].decode("utf-8", "replace").strip())
    return found


def postfix(expression: str) -> list[str] | None:
    """Shunting yard: operands and operators in evaluation order, or None where the expression is malformed."""
    output, waiting, operand_next = [], [], True
    if re.sub(r"\s", "", TOKEN.sub("", expression)):
        return None
    for token in TOKEN.findall(expression):
        word = token.lower()
        if token == "(":
            if not operand_next:
                return None
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                output.append(waiting.pop())
            if operand_next or not waiting:
                return None
            waiting.pop()
        elif word in RANK:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and RANK[waiting[-1]] >= RANK[word]:
                output.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        else:
            if not operand_next:
                return None
            output.append(word)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return output + waiting[::-1]


def limit_of(licence: str) -> float:
    """The limit of the longest known name the licence begins with: ``gpl-3.0-only`` is a ``gpl``."""
    known = [n for n in LIMITS if licence == n or licence.startswith((n + "-", n + "+"))]
    return LIMITS[max(known, key=len)] if known else UNKNOWN_LIMIT


def evaluate(expression: str) -> tuple[list[str], float]:
    """Licences named in an expression, without exceptions, and how much it limits reuse at its mildest choice."""
    steps = postfix(expression)
    if steps is None:
        return ["unreadable"], LIMITS["unreadable"]
    stack: list[tuple[float, bool]] = []  # limit, and whether it is one plain name
    names: list[str] = []
    for step in steps:
        if step not in RANK:
            names.append(step)
            stack.append((limit_of(step), True))
            continue
        (right, exception), (left, plain) = stack.pop(), stack.pop()
        if step == "with":
            if not plain or not exception:
                return ["unreadable"], LIMITS["unreadable"]
            names.pop()  # the name just read is that of the exception
            left = max(0.0, left - EXCEPTION)
        else:
            left = max(left, right) if step == "and" else min(left, right)
        stack.append((left, False))
    return names, stack[0][0]


def scan(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float, str]:
    """(words, base places, first, last, base labels, all labels, score, expressions) of one whole text."""
    words = words_of(text)
    found = phrases_in(words)
    tags = [at for at, label, _ in found if label == TAG_WORDS]
    found = [hit for hit in found if hit[1] != TAG_WORDS]
    base = [(at, label) for at, label, is_base in found if is_base]
    labels = {label for _, label, _ in found}
    score = max((LIMITS.get(label, limit_of(label)) for label in labels), default=0.0)
    expressions = expressions_at(text, tags) if tags else []
    for e in expressions:
        names, limit = evaluate(e)
        labels.update(names)
        score = max(score, limit)
    places = [at for at, _ in base]
    return (words.count(b" ") - 1 if len(words) > 2 else 0, len(base), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), score, " | ".join(expressions))


FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions string"


def scanner():
    """Arrow-batched function text -> struct of ``FIELDS``."""
    names = [f.split()[0] for f in FIELDS.split(", ")]

    @pandas_udf(FIELDS)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan(t) for t in texts], columns=names).astype({"first_word": "Int64", "last_word": "Int64"})
    return scanned


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What each whole text says about its licence: id and the columns of ``FIELDS``. No shuffle."""
    rows = pick(docs, id=id_col, text=text_col)
    return rows.select("id", scanner()(F.col("text")).alias("s")).select("id", "s.*")
