"""Quality classifier: Bradley-Terry ranking from preference pairs, and a threshold at a quantile of the scores.

A text becomes MEASURES: shares of kinds of characters, repeated words, phrases and lines, lengths. Each measure is spread
over ramps between its own quantiles, so that a linear score can bend. Preference pairs join a document labelled 1 with one
labelled 0; the weights are those under which the differences of their ramps explain, by logistic loss, that the first is
preferred. All documents are then scored, and the threshold is that one of 1,001 quantiles of their scores which parts the
labelled ones with the fewest errors. Scores are moved so that it lies at CUT.

The fit reads the labelled documents with the lowest hashes, PER_LABEL of each label at most; quantiles and the choice among
them cover all documents and all labelled ones that may be learned from."""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import modest_batches, released, saved, small

MEASURES = ("upper", "digits", "punctuation", "symbols", "spaces", "repeated_neighbours", "repeated_words", "repeated_phrases", "repeated_lines", "mean_length", "length_spread", "symbol_starts", "symbol_ends", "shouted", "lines", "words")
#: Bound of the training sample, and preference pairs for each document in it.
PER_LABEL, PARTNERS = 4_000, 6
CUT = 0.3
QUANTILES = [i / 1000 for i in range(1001)]
_RAMPS = (0, 0.01, 0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98, 0.99, 1)
#: Code points of a text that are looked at together.
BLOCK = 1 << 20
_SPACE, _LETTER, _UPPER, _DIGIT, _MARK, _SYMBOL = range(6)
_FACTOR, _STEPS = 0x2545F4914F6CDD1D, 1 << 12


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """The kind of each code point of the first plane; the others count as letters."""

    def kind(c: str) -> int:
        if c.isspace():
            return _SPACE
        general = unicodedata.category(c)
        if general in ("Lu", "Lt"):
            return _UPPER
        if general[0] in "LMC":
            return _LETTER
        return _DIGIT if general[0] == "N" else _MARK if c in ".,;:?!'\"()-" else _SYMBOL

    return np.array([kind(chr(c)) for c in range(0x10000)] + [_LETTER], dtype=np.uint8)


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(_STEPS - 1, _FACTOR, dtype=np.uint64))), dtype=np.uint64)


def _sums(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of values; runs follow one another and none is empty."""
    place = np.arange(len(values)) - np.repeat(starts, lengths)
    powers = _powers()[place] if len(place) and place.max() < _STEPS else _powers()[place % _STEPS] + (place // _STEPS).astype(np.uint64)
    h = np.add.reduceat(values * powers, starts) + lengths.astype(np.uint64) if len(starts) else np.empty(0, dtype=np.uint64)
    return (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def _blocks(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        if end < len(text):  # a block ends after a space or line if it has one
            end = max(text.rfind(" ", at, end), text.rfind("\n", at, end)) + 1 or end
            end = end if end > at else min(len(text), at + BLOCK)
        yield text[at:end]
        at = end


def _repeated(h: np.ndarray) -> float:
    in_order = np.sort(h)
    return float((in_order[1:] == in_order[:-1]).sum() / len(h)) if len(h) else 0.0


def measures(text: str | None) -> np.ndarray:
    """The MEASURES of a whole text; all 0 for one without words."""
    characters, words, lines, lengths = np.zeros(6), [], [], []
    starts_marked = ends_marked = shouted = 0
    for part in _blocks(text or ""):
        c = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kind = _kinds()[np.minimum(c, 0x10000)]
        characters += np.bincount(kind, minlength=6)
        inside = kind != _SPACE
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            continue
        long = ends - starts
        hashed = _sums(c[inside].astype(np.uint64) + np.uint64(1), np.cumsum(long) - long, long)
        line = np.searchsorted(np.flatnonzero(c == 10), starts)
        first = np.flatnonzero(np.diff(line, prepend=-1))
        words.append(hashed)
        lengths.append(long)
        lines.append(_sums(hashed, first, np.diff(first, append=len(line))))
        starts_marked += int((kind[starts] >= _MARK).sum())
        ends_marked += int((kind[ends - 1] == _SYMBOL).sum())
        shouted += int(((long > 1) & (kind[starts] == _UPPER) & (kind[np.minimum(starts + 1, len(kind) - 1)] == _UPPER)).sum())
    h = np.concatenate(words) if words else np.empty(0, dtype=np.uint64)
    if not len(h):
        return np.zeros(len(MEASURES))
    n, long = len(h), np.concatenate(lengths)
    four = h[3:] * np.uint64(3) + h[2:-1] * np.uint64(5) + h[1:-2] * np.uint64(7) + h[:-3] * np.uint64(11) if n > 3 else h[:0]
    of = characters / characters.sum()
    neighbours = float((h[1:] == h[:-1]).mean()) if n > 1 else 0.0
    row = [of[_UPPER], of[_DIGIT], of[_MARK], of[_SYMBOL], of[_SPACE], neighbours, _repeated(h), _repeated(four), _repeated(np.concatenate(lines)), long.mean(), long.std(), starts_marked / n, ends_marked / n, shouted / n, sum(map(len, lines)) / n, math.log1p(n)]
    return np.array(row, dtype=np.float64)


@dataclass
class Model:
    """The knots of each measure's ramps, the weights of the ramps, and the raw score that lies at CUT."""

    knots: list[np.ndarray]
    weights: np.ndarray
    threshold: float = 0.0

    def raw(self, m: np.ndarray) -> np.ndarray:
        return ramps(m, self.knots) @ self.weights

    def score(self, raw: Column) -> Column:
        """From 0 to 1, CUT at the threshold."""
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.least(F.lit(700.0), F.greatest(F.lit(-700.0), F.lit(self.threshold + math.log((1 - CUT) / CUT)) - raw))))


def ramps(m: np.ndarray, knots: list[np.ndarray]) -> np.ndarray:
    """Between two knots a ramp goes from 0 to 1."""
    columns = [np.clip((m[:, j] - a) / (b - a), 0, 1) for j, k in enumerate(knots) for a, b in zip(k[:-1], k[1:], strict=True)]
    return np.stack(columns, axis=1) if columns else np.zeros((len(m), 0))


def bradley_terry(better: np.ndarray, worse: np.ndarray, l2: float = 1e-4, steps: int = 30) -> np.ndarray:
    """Weights of least logistic loss over pairs: P(a before b) = 1 / (1 + exp(-w (a - b))), by Newton's method. Each row of the
    longer side meets PARTNERS of the other, dealt in turn."""
    w = np.zeros(better.shape[1])
    if not len(better) or not len(worse) or not len(w):
        return w
    n = np.arange(max(len(better), len(worse)))
    deals = [(n % len(better), (n + k * 7919) % len(worse)) for k in range(PARTNERS)]
    pairs = len(n) * PARTNERS

    def loss(v: np.ndarray) -> float:
        up, down = better @ v, worse @ v
        return sum(float(np.logaddexp(0, down[j] - up[i]).sum()) for i, j in deals) / pairs + l2 / 2 * float(v @ v)

    now = loss(w)
    for _ in range(steps):
        up, down = better @ w, worse @ w
        g, h = l2 * w, l2 * np.eye(len(w))
        for i, j in deals:
            miss = 1 / (1 + np.exp(np.clip(up[i] - down[j], -500, 500)))
            apart = better[i] - worse[j]
            g = g - miss @ apart / pairs
            h += (apart * (miss * (1 - miss))[:, None]).T @ apart / pairs
        step, size = np.linalg.solve(h, g), 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w, before = w - size * step, now
        now = loss(w)
        if before - now < 1e-7:
            break
    return w


def learn(m: np.ndarray, labels: np.ndarray) -> Model:
    """A model of rows in a fixed order: measures and labels 0 or 1."""
    knots = [np.unique(np.quantile(m[:, j], _RAMPS)) if len(m) else np.zeros(1) for j in range(len(MEASURES))]
    x = ramps(m, knots)
    return Model(knots, bradley_terry(x[labels == 1], x[labels == 0]))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32(id as text) mod 5 is 0. A null id isn't held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, m) for every row of docs, written: texts are read once."""

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        found = [measures(t.as_py()) for t in texts]
        released()
        return pa.array(found, pa.list_(pa.float64()))

    return saved(modest_batches(docs).select(F.col(id_col).alias("id"), of(F.col(text_col)).alias("m")), "quality-measures")


def fit(rows: DataFrame, labels: DataFrame, per_label: int = PER_LABEL) -> Model:
    """rows: (id, m); labels: (id, label), those that may be learned from, a row an id. The fit's sample is per_label documents of
    each label whose ids hash lowest, and one row of an id that stands repeatedly."""
    order = F.row_number().over(W.partitionBy("label", "part").orderBy("share", "id"))
    shares = labels.withColumn("share", F.xxhash64(F.col("id").cast("string"), F.lit(11))).withColumn("part", F.pmod(F.col("share"), F.lit(32)))
    near = shares.withColumn("n", order).where(F.col("n") <= per_label).drop("n", "part")  # of each part the lowest, so few meet below
    lowest = near.withColumn("n", F.row_number().over(W.partitionBy("label").orderBy("share", "id"))).where(F.col("n") <= per_label)
    chosen = saved(lowest.select("id", "label", "share"), "quality-sample")
    sample = rows.join(small(chosen), "id").groupBy("id", "label", "share").agg(F.min("m").alias("m")).orderBy("share", "id")
    found = sample.collect()  # 2 * per_label rows of len(MEASURES) numbers
    m = np.array([r["m"] for r in found], dtype=np.float64).reshape(len(found), len(MEASURES))
    return learn(m, np.array([r["label"] for r in found], dtype=np.int64))


def with_raw(rows: DataFrame, model: Model) -> DataFrame:
    @F.arrow_udf("double")
    def raw(m: pa.Array) -> pa.Array:
        return pa.array(model.raw(np.asarray(m.flatten()).reshape(len(m), len(MEASURES))))

    return rows.withColumn("raw", raw("m"))


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """Of the 1,001 quantiles of all raw scores the one that parts the labelled documents with the fewest errors; of equally
    good ones the middle of the longest run."""
    grid = scored.agg(F.percentile_approx("raw", [float(q) for q in QUANTILES], 100_000).alias("q")).first()["q"]
    if not grid:
        return 0.0
    grid = sorted(set(grid))

    @F.arrow_udf("int")
    def place(raw: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(grid, np.asarray(raw), side="right"), pa.int32())  # how many quantiles it reaches

    counts = scored.join(labels, "id").groupBy(place("raw").alias("place"), "label").agg(F.count("*").alias("n")).collect()  # 2 rows a quantile at most
    n = np.zeros((2, len(grid) + 1))
    for r in counts:
        n[r["label"], r["place"]] += r["n"]
    if not n.sum(axis=1).all():
        return grid[0]
    below = np.cumsum(n, axis=1)[:, : len(grid)]  # places 0 to k are below grid[k]
    errors = n[0].sum() - below[0] + below[1]
    best = np.flatnonzero(errors == errors.min())
    run = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
    return float(grid[run[len(run) // 2]])


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", learn_from: Column | None = None) -> DataFrame:
    """A row per row of docs: its id, score (0 to 1, higher: label 1 likelier) and predicted (1 if the score is CUT or more).

    A score depends on the whole text alone. Null and empty texts are scored as texts without words; repeated rows agree. learn_from
    says which rows of labels may be learned from (all). Null labels and ids teach nothing, labels other than 0 and 1 neither; of
    several labels of an id the least holds. Without both labels all scores are above CUT. Other columns aren't read."""
    rows = measured(docs, id_col, text_col)
    usable = labels.where(learn_from if learn_from is not None else F.lit(True)).where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    known = saved(usable.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("label")), "quality-labels")
    model = fit(rows, known)
    scored = saved(with_raw(rows, model).select("id", "raw"), "quality-scores")
    model.threshold = threshold(scored, known)
    score = model.score(F.col("raw"))
    return scored.select(F.col("id").alias(id_col), score.alias("score"), (score >= CUT).cast("int").alias("predicted"))
