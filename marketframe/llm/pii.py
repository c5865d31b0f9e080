"""Information-theoretic sanitisation of personal data.

E-mail addresses, IP addresses, card and phone numbers are found by pattern.
Each distinct value is a protected entity. All words of a document outside its
spans are terms of all its entities, however far off they stand; the corpus
tells how much a term gives away: with document counts,

    PMI(t, e) = log(N · n(t, e) / (n(t) · n(e))),   IC(e) = log(N / n(e)),

and PMI / IC is the share of the entity's information that the term discloses
(one: the term occurs with this entity only). Terms above ``REMOVE`` are
removed, those above ``GENERALISE`` are replaced by their class, at every place
in every document that holds the entity.

Counts cover all documents. One pass of Arrow-batched pattern search writes
compact rows (spans, entities, places of terms); all counting and joining is on those.

Defined results: null and empty texts have no spans; rows that repeat id and
text get equal results; an entity in every document has nothing left to
disclose; a null id is an ordinary value; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterable

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketframe.llm.common import pick, stored, text_or_empty

# Order decides between spans that start together; the last two are the method's.
KINDS = ("email", "ip", "card", "phone", "remove", "generalise")
# A hot entity's terms are dealt to so many keys.
SALTS = 16
REMOVE, GENERALISE = 0.9, 0.7

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
WORD = re.compile(r"[^\W_]+")

Span = tuple[int, int, int]  # start, kind, end


def emails(text: str) -> list[tuple[int, int]]:
    """Around each @: all local characters before it, back to the last match, and a dotted domain after it."""
    found, floor, at = [], 0, text.find("@")
    while at >= 0:
        before = text[floor:at]
        local = len(before) - len(before.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if local else None
        floor = at + 1
        if domain:
            found.append((at - local, domain.end()))
            floor = domain.end()
        at = text.find("@", floor)
    return found


def addresses(text: str) -> list[tuple[int, int]]:
    """Four numbers at a time of each run of dotted numbers; those over 255 are dropped."""
    found = []
    for m in DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        parts, start = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i: i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                found.append((start, end))
            start = end + 1
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by start, then kind."""
    spans = [(a, 0, b) for a, b in emails(text)] + [(a, 1, b) for a, b in addresses(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def entity_of(kind: int, value: str) -> int:
    """Name of a protected value: case and separators do not count."""
    plain = value.lower() if kind < 2 else "".join(c for c in value if c.isdigit())
    return xxhash.xxh64_intdigest(f"{KINDS[kind]}:{plain}".encode("utf-8", "surrogatepass")) - (1 << 63)


def terms_of(text: str, spans: list[Span]) -> tuple[list[int], list[tuple[str, int, int]]]:
    """The distinct entities, and (term, start, end) of every word outside the spans."""
    taken, reach = [], 0  # spans in order, and how far any span up to here reaches
    for a, _, b in spans:
        reach = max(reach, b)
        taken.append((a, reach))
    begins = [a for a, _ in taken]

    def free(a: int, b: int) -> bool:
        i = bisect.bisect_left(begins, b)
        return not i or taken[i - 1][1] <= a

    places = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
    return sorted({entity_of(kind, text[a:b]) for a, kind, b in spans}), [x for x in places if len(x[0]) > 1 and free(x[1], x[2])]


BASE_FIELDS = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base array<struct<start:int,kind:int,stop:int>>, "
               "entities array<long>, places array<struct<term:string,start:int,stop:int>>")


def base_scanner():
    """Arrow-batched function text -> struct of ``BASE_FIELDS``."""
    names = re.findall(r"(\w+) (?:long|string|array)", BASE_FIELDS)

    def scan(text):
        text = text or ""
        spans = base_spans(text)
        counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
        as_rows = [{"start": a, "kind": k, "stop": b} for a, k, b in spans]
        entities, places = terms_of(text, spans) if spans else ([], [])
        places = [dict(zip(("term", "start", "stop"), x)) for x in places]
        return (*counts, hashlib.sha256(joined(spans).encode()).hexdigest(), as_rows, entities, places)

    @pandas_udf(BASE_FIELDS)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan(t) for t in texts], columns=names)
    return scanned


def term_counts(texts: DataFrame) -> DataFrame:
    """Documents that hold each word: (word, n_t)."""
    words = F.array_distinct(F.split(F.lower(text_or_empty("text")), r"[^\p{L}\p{N}]+"))
    return texts.select(F.explode(words).alias("word")).where(F.length("word") > 1).groupBy("word").agg(F.count(F.lit(1)).alias("n_t"))


def held(base: DataFrame) -> DataFrame:
    """Each entity of each document with each of its terms: (id, at, entity, term)."""
    some = base.where(F.size("entities") > 0)
    each = some.select("id", "at", "entities", F.explode(F.array_distinct(F.transform("places", lambda x: x["term"]))).alias("term"))
    return each.select("id", "at", F.explode("entities").alias("entity"), "term")


def disclosing(base: DataFrame, texts: DataFrame, remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """Terms that give an entity away: (entity, term, share, kind)."""
    total = texts.count()
    joint = held(base).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_te"))
    entities = base.select(F.explode("entities").alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("n_e"))
    entities = entities.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = joint.withColumn("salt", F.pmod(F.hash("term"), F.lit(SALTS)))
    pairs = salted.join(entities, (F.col("entity") == F.col("e")) & (F.col("salt") == F.col("s"))).select("entity", "term", "n_te", "n_e")
    pairs = pairs.where(F.lit(total) > F.col("n_e"))  # else nothing is left to disclose
    counted = pairs.join(term_counts(texts), F.col("term") == F.col("word"), "left")
    n_t = F.greatest(F.coalesce("n_t", "n_te"), "n_te")
    share = 1 - F.log(n_t / F.col("n_te")) / F.log(F.lit(total) / F.col("n_e"))
    judged = counted.select("entity", "term", share.alias("share")).where(F.col("share") >= generalise)
    return judged.withColumn("kind", F.when(F.col("share") >= remove, 4).otherwise(5))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remove: float = REMOVE, generalise: float = GENERALISE) -> DataFrame:
    """Spans of every document: (id, at, n_email, n_ip, n_card, n_phone, base_sha256, base, spans); ``at`` names the text.

    base and spans are arrays of (start, kind, stop), by start and kind.
    """
    rows = pick(docs, id=id_col, text=text_col)
    base = rows.select("id", F.xxhash64(text_or_empty("text")).alias("at"), base_scanner()(F.col("text")).alias("b")).select("id", "at", "b.*")
    base = stored(base, "pii-base")
    risky = stored(disclosing(base, rows.select("text"), remove, generalise), "pii-terms")
    found = held(base).join(risky.select("entity", "term", "kind"), ["entity", "term"])
    # a word that discloses several entities takes the stricter treatment
    found = found.groupBy("id", "at", "term").agg(F.min("kind").alias("kind"))
    found = found.groupBy(F.col("id").alias("of"), F.col("at").alias("of_text")).agg(F.map_from_entries(F.collect_list(F.struct("term", "kind"))).alias("kinds"))
    whole = base.join(found, F.col("id").eqNullSafe(F.col("of")) & (F.col("at") == F.col("of_text")), "left")
    told = F.transform("places", lambda x: F.struct(x["start"].alias("start"), F.try_element_at(F.col("kinds"), x["term"]).alias("kind"), x["stop"].alias("stop")))
    more = F.when(F.col("kinds").isNotNull(), F.filter(told, lambda x: x["kind"].isNotNull()))
    spans = F.array_sort(F.concat("base", F.coalesce(more, F.array().cast("array<struct<start:int,kind:int,stop:int>>"))))
    return whole.withColumn("spans", spans).drop("of", "of_text", "entities", "places", "kinds")


def spans_text(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["stop"])), ",")


def redact(text: str, spans: Iterable) -> str:
    """The text with personal data replaced by its kind, disclosing terms removed and others replaced by their class."""
    out, at = [], 0
    for start, kind, stop in sorted(tuple(s) for s in spans):
        if start < at:  # overlaps a span that is already replaced
            at = max(at, stop)
            continue
        word = text[start:stop]
        cls = "number" if word.isdigit() else "name" if word[:1].isupper() else "word"
        out += [text[at:start], "" if kind == 4 else f"[{cls}]" if kind == 5 else f"[{KINDS[kind]}]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with sanitised texts; all columns kept, null texts stay null."""
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    i, t = (f"_c{names.index(c)}" for c in (id_col, text_col))
    found = personal_data(docs, id_col, text_col, **options).where(F.size("spans") > 0).select("id", "at", "spans").dropDuplicates(["id", "at"])

    @pandas_udf("string")
    def apply(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([x if s is None or x is None else redact(x, [(r["start"], r["kind"], r["stop"]) for r in s]) for x, s in zip(texts, spans)])
    on = F.col(i).eqNullSafe(F.col("id")) & (F.xxhash64(text_or_empty(t)) == F.col("at"))
    return flat.join(found, on, "left").withColumn(t, apply(F.col(t), F.col("spans"))).drop("id", "at", "spans").toDF(*names)
