"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character 1- to 3-grams of the lower-cased text, weighted (1 + log tf) * idf and scaled to length
1; idf comes from all training documents. Weights are trained with follow-the-regularised-leader under an elastic-net
penalty, on a bounded sample: the PER_LANGUAGE training documents of each language whose ids hash lowest. A temperature
is then fitted on a part of the sample that was kept from training, so that scores are probabilities."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
import pickle

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import modest_batches, released, saved, small

FEATURES = 1 << 14
#: Bound of the training sample: documents of a language, and of all languages together (a language of many has an equal
#: share of that, LEAST at least). All languages are learned.
PER_LANGUAGE, SAMPLE, LEAST = 2_500, 200_000, 20
#: N-grams of a text up to which they are sorted; beyond, all features are counted.
SHORT = 6_000
UNKNOWN = "und"
ALPHA, BETA, L1, L2, EPOCHS = 0.6, 1.0, 0.02, 0.01, 2
_LETTER = regex.compile(r"\p{L}")
_FOLD = np.arange(0x80, dtype=np.uint32)
_FOLD[[c for c in range(0x80) if not chr(c).isalpha()]] = 32


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The hashed n-grams of the whole text, and how often each occurs; ASCII characters other than letters count as spaces."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = np.where(c < 0x80, _FOLD[np.minimum(c, 0x7F)], c).astype(np.uint32)
    keep = np.ones(len(c), dtype=bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    c = np.concatenate(([32], c[keep], [32])).astype(np.uint32)
    a = c * np.uint32(0x9E3779B1)
    grams = [a, a[:-1] * np.uint32(0x85EBCA6B) + c[1:] * np.uint32(0xC2B2AE35) + np.uint32(1)]
    grams.append(grams[1][:-1] * np.uint32(0x27D4EB2F) + c[2:] * np.uint32(0x165667B1) + np.uint32(2))
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    g = np.concatenate(grams)
    g ^= g >> np.uint32(15)
    g = (g * np.uint32(0x2C1B3C6D)) >> shift
    if len(g) < SHORT:
        at, n = np.unique(g, return_counts=True)
        return at.astype(np.int64), n
    found = np.bincount(g, minlength=FEATURES)
    at = np.flatnonzero(found)
    return at, found[at]


def vector(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes and values of a document's scaled TF-IDF vector."""
    at, n = found
    v = (1 + np.log(n)) * idf[at]
    return at, (v / math.sqrt(float(v @ v) or 1.0)).astype(np.float64)


@dataclass
class Model:
    labels: list[str]
    idf: np.ndarray
    weights: np.ndarray  # FEATURES x labels
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, v: np.ndarray) -> np.ndarray:
        return v @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or text is None or not _LETTER.search(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*vector(counts(text), self.idf)) / self.temperature)
        k = int(p.argmax())
        return self.labels[k], float(min(1.0, p[k]))


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(vectors: list[tuple[np.ndarray, np.ndarray]], classes: list[int], n: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal with per-coordinate rates: a weight is 0 while its sum of gradients is within L1."""
    z, s = np.zeros((FEATURES, n)), np.zeros((FEATURES, n))
    bias, bias_s = np.zeros(n), np.zeros(n)

    def weights(z: np.ndarray, s: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(s)) / ALPHA + L2))

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(vectors)):
            at, v = vectors[i]
            zi, si = z[at], s[at]
            w = weights(zi, si)
            error = softmax(v @ w + bias)
            error[classes[i]] -= 1
            g = v[:, None] * error
            grown = si + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(si)) / ALPHA * w
            s[at] = grown
            bias_s += error * error
            bias -= ALPHA * error / (BETA + np.sqrt(bias_s))
    return weights(z, s), bias


def calibrate(logits: np.ndarray, classes: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm. Targets are smoothed by one wrong label
    in n + 2, so that a sample without errors doesn't make every score 1."""
    if not len(classes) or logits.shape[1] < 2:
        return 1.0
    wrong = 1 / (len(classes) + 2)
    target = np.full(logits.shape, wrong / (logits.shape[1] - 1))
    target[np.arange(len(classes)), classes] = 1 - wrong

    def loss(t: float) -> float:
        x = logits / math.exp(t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - (target * x).sum(axis=1)).mean())

    a, b, r = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) <= loss(d) else (c, b)
    return math.exp((a + b) / 2)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's documents with each feature; feature -1: its documents."""
    df, n = np.zeros(FEATURES, dtype=np.int64), 0
    for b in batches:
        for t in b.column(0):
            df[counts(t.as_py() or "")[0]] += 1
            n += 1
    if n:
        at = np.flatnonzero(df)
        released()
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(([-1], at)), pa.int32()), pa.array(np.concatenate(([n], df[at])), pa.int64())], names=["feature", "n"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model:
    """Learns from the rows of docs with a language and a text. Rows are its only input: held-out ones must be gone.

    Repeated rows count in the idf; an id is in the sample once, with its least language and text. Rows of null id are
    one such id. No rows: a model without labels, which predicts und. Other columns aren't read."""
    known = modest_batches(docs).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string").alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(text_col).alias("_text"))
    sizes = saved(known.groupBy("_lang").agg(F.count("*").alias("_size")), "langid-sizes")
    labels = sorted(r["_lang"] for r in sizes.collect())  # the model has a column of weights for each
    if not labels:
        return Model([], np.ones(FEATURES), np.zeros((FEATURES, 0)), np.zeros(0), 1.0)
    df = {r["feature"]: r["n"] for r in known.select("_text").mapInArrow(_document_counts, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}  # at most FEATURES + 1 rows
    total = df.pop(-1)
    seen = np.zeros(FEATURES)
    seen[list(df)] = list(df.values())
    idf = np.log((1 + total) / (1 + seen)) + 1
    per = min(per_language, max(LEAST, SAMPLE // len(labels)))
    # Hashes under a bound that twice as many documents as needed are expected to meet: so few rows of a language meet.
    known = known.withColumn("_id", F.coalesce("_id", F.lit(""))).withColumn("_share", F.xxhash64("_id", F.lit(10)) / F.lit(2.0**64) + 0.5)
    near = known.select("_id", "_lang", "_share").join(small(sizes), "_lang").where(F.col("_share") <= (2 * per + 100) / F.col("_size"))
    lowest = F.row_number().over(W.partitionBy("_lang").orderBy("_share", "_id"))
    chosen = near.select("_id", "_lang", "_share").distinct().withColumn("_n", lowest).where(F.col("_n") <= per)
    chosen = saved(chosen.groupBy("_id").agg(F.min("_lang").alias("_lang")), "langid-sample")
    sample = known.drop("_share").join(small(chosen), ["_id", "_lang"]).groupBy("_id").agg(F.min(F.struct("_lang", "_text")).alias("r")).select("_id", "r._lang", "r._text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, place = [], {label: k for k, label in enumerate(labels)}
        for b in batches:
            for i, lang, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at, v = vector(counts(text), idf)
                rows.append((i, place[lang], at.astype(np.uint16), v.astype(np.float32)))
        rows.sort(key=lambda r: r[0])
        aside = [k % 8 == 7 for k in range(len(rows))]
        kept, rest = [r for r, a in zip(rows, aside) if not a], [r for r, a in zip(rows, aside) if a]
        weights, bias = train([(r[2], r[3].astype(np.float64)) for r in kept], [r[1] for r in kept], len(labels))
        model = Model(labels, idf, weights, bias, 1.0)
        if rest:
            model.temperature = calibrate(np.array([model.logits(r[2], r[3].astype(np.float64)) for r in rest]), np.array([r[1] for r in rest]))
        rows.clear()
        released()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    return pickle.loads(sample.repartition(1).mapInArrow(learn, "model binary").first()["model"])


def learned(docs: DataFrame, id_col: str = "doc_id", **columns) -> Model:
    """A model from all but the held-out rows: those whose crc32(id as text) mod 4 is 2. A null id isn't held out."""
    return fit(docs.where(~held_out(id_col)), id_col, **columns)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@lru_cache(maxsize=2)
def _model(dumped: bytes) -> Model:
    return pickle.loads(dumped)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs with lang_pred and score (columns of these names are replaced, all others kept): the likeliest language and its
    calibrated probability, from the whole text alone; of equal ones the first by code point. und and 0 if the text is null
    or has no letter, or nothing was learned. Each row stands for itself: ids aren't read, repeated rows agree."""
    dumped = pickle.dumps(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        m = _model(dumped)
        found = [m.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], names=["lang", "score"])

    found = modest_batches(docs).select(F.struct("*").alias("row"), predict(F.col(text_col)).alias("found"))
    kept = [c for c in docs.columns if c.lower() not in (lang_out.lower(), score_out.lower())]
    return found.select(*(F.col("row")[c].alias(c) for c in kept), F.col("found.lang").alias(lang_out), F.col("found.score").alias(score_out))


def accepted(docs: DataFrame, least_score: float = 0.35, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs in a language that the model learned from them, with a score of least_score or more; junk
    without letters and texts that look like no learned language go. All columns stay, whatever their names."""
    model = learned(docs, id_col, text_col=text_col, lang_col=lang_col)
    found = identify(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), model, "text", "lang_pred", "score")
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)).select("row.*")
