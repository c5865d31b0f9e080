"""Language identification: sparse multinomial logistic regression on character n-grams.

Texts become TF-IDF vectors of hashed character n-grams (one to three
characters of the lower-cased text, anything but letters counting as a space).
Weights are fitted by follow-the-regularised-leader with elastic-net penalties,
which leaves most of them exactly zero; a temperature fitted on rows kept aside
calibrates the probabilities.

Document frequencies and label counts cover every labelled row. The weights are
fitted on a sample of at most about ``SAMPLE_ROWS`` rows, chosen by a hash of
the id and dealt evenly to the languages; only that sample and one number per
bucket reach the driver. The model has ``BUCKETS`` × languages weights.

Defined results: a null text, one without a letter, and any text when nothing
was learned, is ``und`` with score 0; rows with a null label are not learned
from; ties go to the language that sorts first; equal rows get equal results;
an empty table gives an empty result.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from marketframe.llm.common import pick

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
SAMPLE_ROWS = 4000
UNKNOWN = "und"
CHUNK = 1 << 20
FACTORS = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
SHIFT = np.uint64(64 - BUCKET_BITS)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


# Code points below this are told letters by a table; above it every one counts as a letter.
LETTERS = np.array([chr(i).isalpha() for i in range(0x3000)])


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket occurs in a whole text."""
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(text), CHUNK):
        # two characters more, so that n-grams across the cut count once
        part = text[max(0, start - 2): start + CHUNK].lower()
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.where(LETTERS[np.minimum(code, len(LETTERS) - 1)] | (code >= len(LETTERS)), code, 32).astype(np.uint64)
        # a run of spaces is one space
        code = code[np.concatenate(([True], (code[1:] != 32) | (code[:-1] != 32)))]
        overlap = min(2, len(code)) if start else 0
        mixed = code
        for n, factor in enumerate(FACTORS):
            if n:
                if len(mixed) < 2:
                    break
                mixed = mixed[:-1] * np.uint64(0x100000001B3) + code[n:]
            new = mixed[max(0, overlap - n):]
            counts += np.bincount(((new * factor) >> SHIFT).astype(np.int64), minlength=BUCKETS)
    return counts


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-zero entries of the text's TF-IDF vector of length one: (buckets, values)."""
    counts = gram_counts(text)
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    norm = np.sqrt((values * values).sum())
    return at, values / norm if norm else values


@dataclasses.dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x (buckets + 1), the last column a bias
    temperature: float = 1.0

    def probabilities(self, text: str) -> np.ndarray:
        at, values = features(text, self.idf)
        return softmax((self.weights[:, at] @ values + self.weights[:, -1]) / self.temperature)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        p = self.probabilities(text)
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, max(0.0, p[best])))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max())
    return e / e.sum()


class Ftrl:
    """FTRL-proximal with L1 and L2 penalties; one weight vector per language."""

    def __init__(self, languages: int, size: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.002):
        self.z, self.n = np.zeros((languages, size)), np.zeros((languages, size))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[:, at], self.n[:, at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(w @ values)
        error[label] -= 1
        g = error[:, None] * values[None, :]
        n = self.n[:, at]
        self.z[:, at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[:, at] = n + g * g


def fit_temperature(scores: list[np.ndarray], labels: list[int]) -> float:
    """The temperature of least log loss, by golden-section search over its logarithm."""
    if not labels:
        return 1.0
    table, right = np.stack(scores), np.array(labels)

    def loss(log_t: float) -> float:
        s = table / np.exp(log_t)
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(right)), right]).mean())

    low, high, step = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - step * (high - low), low + step * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per partition: texts that hold each bucket, and texts of each label (bucket null)."""
    held, labels = np.zeros(BUCKETS, np.int64), {}
    for batch in batches:
        for label, text in zip(batch.column(0), batch.column(1)):
            held += gram_counts(text.as_py()) > 0
            labels[label.as_py()] = labels.get(label.as_py(), 0) + 1
    at = np.flatnonzero(held)
    yield pa.RecordBatch.from_arrays(
        [pa.array([None] * len(at) + list(labels), pa.string()), pa.array([*at.tolist(), *[None] * len(labels)], pa.int32()),
         pa.array([*held[at].tolist(), *labels.values()], pa.int64())], names=["lang", "bucket", "n"])


def _chance(id_col: str, salt: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), F.col(id_col).cast("string")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def train(rows: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int = SAMPLE_ROWS, epochs: int = 3) -> Model:
    """Fit on labelled rows. Only text and label are learned from; the id only picks the sample."""
    known = pick(rows, id=id_col, text=text_col, lang=label_col).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    seen = known.select("lang", "text").mapInArrow(_frequencies, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    idf, totals = np.zeros(BUCKETS), {}
    for r in seen.collect():  # one row per bucket and per language
        if r["bucket"] is None:
            totals[r["lang"]] = r["n"]
        else:
            idf[r["bucket"]] = r["n"]
    count = sum(totals.values())
    idf = np.log((1 + count) / (1 + idf)) + 1
    languages = sorted(totals)
    if not languages:
        return Model([], idf, np.zeros((0, BUCKETS + 1)))

    share = max(1, sample_rows // len(languages))
    rate = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(share / totals[lang]))])
    chosen = known.withColumn("draw", _chance("id", "sample")).where(F.col("draw") < rate[F.col("lang")])

    def vectors(batches):
        for batch in batches:
            got = [features(t.as_py(), idf) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([a.astype(np.int32) for a, _ in got], pa.list_(pa.int32())),
                 pa.array([v.astype(np.float32) for _, v in got], pa.list_(pa.float32()))], names=["order", "lang", "at", "values"])

    order = F.xxhash64(F.lit("order"), F.col("id").cast("string")).alias("order")
    sample = chosen.select(order, "lang", "text").mapInArrow(vectors, "order long, lang string, at array<int>, values array<float>").toArrow()
    place = {lang: i for i, lang in enumerate(languages)}
    examples = []
    for o, lang, at, values in zip(*[sample.column(c).to_pylist() if c in ("order", "lang") else sample.column(c) for c in sample.column_names]):
        # a bias feature of value one follows the buckets
        x = np.append(at.values.to_numpy(), BUCKETS), np.append(values.values.to_numpy().astype(float), 1.0)
        examples.append((o, place[lang], *x))
    examples.sort(key=lambda e: (e[0], e[1], len(e[2])))
    aside, learned = examples[::5], [e for i, e in enumerate(examples) if i % 5]
    ftrl = Ftrl(len(languages), BUCKETS + 1)
    for _ in range(epochs):
        for _, label, at, values in learned:
            ftrl.learn(at, values, label)
    weights = ftrl.weights()
    t = fit_temperature([weights[:, at] @ values for _, _, at, values in aside], [label for _, label, _, _ in aside])
    return Model(languages, idf, weights, t)


def predictor(model: Model, df: DataFrame):
    """Arrow-batched function text -> struct(lang, score) with the model sent once to each executor."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([sent.value.predict(t) for t in texts], columns=["lang", "score"])
    return predict


def held_out(id_col: str) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Predict every row after learning from the rows outside the held-out fold: (id, held_out, lang, score)."""
    rows = pick(docs, id=id_col, text=text_col, label=label_col).withColumn("held_out", held_out("id"))
    model = train(rows.where(~F.col("held_out")), "id", "text", "label")
    found = rows.select("id", "held_out", predictor(model, docs)(F.col("text")).alias("p"))
    return found.select("id", "held_out", F.col("p.lang").alias("lang"), F.col("p.score").alias("score"))


def known_language(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Rows whose language is recognised with at least this calibrated probability; all columns kept."""
    rows = pick(docs, id=id_col, text=text_col, label=label_col)
    model = train(rows.where(~held_out("id")), "id", "text", "label")
    names = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    judged = flat.withColumn("_p", predictor(model, docs)(F.col(f"_c{names.index(text_col)}")))
    return judged.where((F.col("_p.lang") != UNKNOWN) & (F.col("_p.score") >= least)).drop("_p").toDF(*names)
