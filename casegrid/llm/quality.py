"""Quality classifier: regularised quadratic discriminant on document statistics.

Every document becomes a short vector of transformed counts (logarithms of
smoothed rates). Each class gets a mean and a shrunk covariance

    S = (1 - a) * ((1 - b) * S_class + b * S_pooled) + a * trace / d * I

and a document's score is the logistic of the difference of the two Gaussian
log-densities plus the log prior odds. Distances come from Cholesky factors that
are computed once on the driver and travel with the tasks.

All labelled rows of the learning fold take part, up to about ``MAX_LABELS``: tasks sum counts, vectors and
their products for each class, so only ``2 * (1 + d + d * d)`` numbers are
gathered. Labels, language, source and id are no inputs of a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.common import as_bytes, with_results

THRESHOLD = 0.3
MAX_LABELS = 1 << 20
POOLED = 0.05
ROUND = 0.01

_SYMBOLS = re.compile(rb"[#*$%&|<>{}\[\]^~=+@_\\/]")
_MARKS = re.compile(rb"[!?]")
_CAPITALS = re.compile("[A-ZÀ-Þ]")
_DIGITS = re.compile(rb"[0-9]")
_STOPS = re.compile(rb"[.,;:]")

STATISTICS = ("words", "word_length", "symbols", "marks", "capitals", "digits", "stops", "lone", "same_next", "repeated",
              "kinds", "lines", "same_lines")


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of STATISTICS; finite for any text."""
    words = text.split()
    n = len(words)
    size = max(1, sum(map(len, words)))
    kinds = len(set(words))
    same = sum(map(bytes.__eq__, words, words[1:]))
    threes = list(zip(words, words[1:], words[2:], strict=False))
    repeated = len(threes) - len(set(threes))
    lone = sum(1 for w in words if len(w) == 1 and not w.isalnum() and w < b"\x80")
    lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]

    def rate(count: float, of: float, least: float = 0.5) -> float:
        return float(np.log((count + least) / (of + 2 * least)))

    capitals = len(_CAPITALS.findall(text.decode("utf-8", "replace")))
    return [
        float(np.log1p(n)), float(np.log(size / max(1, n))),
        rate(len(_SYMBOLS.findall(text)), size), rate(len(_MARKS.findall(text)), size), rate(capitals, size),
        rate(len(_DIGITS.findall(text)), size), rate(len(_STOPS.findall(text)), n), rate(lone, n), rate(same, n),
        rate(repeated, n), rate(kinds, n), rate(len(lines), n), rate(len(lines) - len(set(lines)), max(1, len(lines))),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Class means and inverse Cholesky factors; index 0 and 1 are the labels."""

    counts: tuple[float, float]
    means: np.ndarray | None = None
    factors: np.ndarray | None = None

    @staticmethod
    def fit(moments: dict[int, np.ndarray], pooled: float, to_round: float) -> Discriminant:
        """From each label's (n, sum, sum of products), flat. Without rows of a label there are no factors."""
        d = len(STATISTICS)
        counts = tuple(float(moments[k][0]) if k in moments else 0.0 for k in (0, 1))
        if not all(counts):
            return Discriminant(counts)
        means = np.stack([moments[k][1 : 1 + d] / counts[k] for k in (0, 1)])
        spreads = [moments[k][1 + d :].reshape(d, d) / counts[k] - np.outer(means[k], means[k]) for k in (0, 1)]
        common = (counts[0] * spreads[0] + counts[1] * spreads[1]) / sum(counts)
        factors = []
        for s in spreads:
            s = (1 - pooled) * s + pooled * common
            s = (1 - to_round) * s + to_round * max(np.trace(s) / d, 1e-6) * np.eye(d)
            factors.append(np.linalg.inv(np.linalg.cholesky(s)))
        return Discriminant(counts, means, np.stack(factors))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; with one label unseen, its smoothed prior for every row."""
        prior = np.log(self.counts[1] + 1) - np.log(self.counts[0] + 1)
        odds = np.full(len(x), prior)
        if self.factors is not None:
            for sign, mean, factor in ((-1, self.means[0], self.factors[0]), (1, self.means[1], self.factors[1])):
                z = (x - mean) @ factor.T
                odds += sign * (np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=1))
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def vectors(texts: pa.Array) -> np.ndarray:
    """The statistics of each text (null: those of an empty text)."""
    return np.array([statistics(t) for t in as_bytes(texts)], dtype=float).reshape(-1, len(STATISTICS))


def moments(labelled: DataFrame) -> DataFrame:
    """``labelled``: (label 0 or 1, text). The flat (n, sum, sum of products) of each label's vectors, by place.

    Statistics and sums are one step in Python: two in a row would keep two workers for each core, which
    stay, with what they hold, for as long as other Python steps follow.
    """

    def sums(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            labels, x = batch.column(0).to_numpy(zero_copy_only=False), vectors(batch.column(1))
            for k in np.unique(labels):
                mine = x[labels == k]
                made = np.concatenate([[len(mine)], mine.sum(axis=0), (mine.T @ mine).ravel()])
                total[int(k)] = total.get(int(k), 0) + made
        for k, made in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()),
                                              pa.array(made)], names=["label", "place", "value"])

    return (labelled.where(F.col("label").isin(0, 1)).select(F.col("label").cast("int").alias("label"), "text")
            .mapInArrow(sums, "label int, place int, value double")
            .groupBy("label", "place").agg(F.sum("value").alias("value")))


def fit(labelled: DataFrame, pooled: float = POOLED, to_round: float = ROUND) -> Discriminant:
    """``labelled``: (label 0 or 1, text). Rows without a label, or with another, take no part."""
    rows = moments(labelled).collect()
    found: dict[int, np.ndarray] = {}
    for label in {r["label"] for r in rows}:
        mine = sorted((r["place"], r["value"]) for r in rows if r["label"] == label)
        found[label] = np.array([v for _, v in mine])
    return Discriminant.fit(found, pooled, to_round)


def learn(docs: DataFrame, labels: DataFrame, learning, id_col: str, text_col: str, label_col: str,
          pooled: float = POOLED, to_round: float = ROUND, max_labels: int = MAX_LABELS) -> Discriminant:
    """The model of the labelled rows for which ``learning`` (a column over ``id``) holds.

    A document that is labelled twice counts twice; labels without a document don't count.
    The labels go to the documents, whose statistics are made for labelled ones only: of
    more than ``max_labels`` labels, a share chosen by the hash of the id is used, of about that number.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where(F.col("label").isin(0, 1)).where(learning)
    n = marks.count()
    if n > max_labels:
        marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < (max_labels << 30) // n)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(marks), "id")  # max_labels pairs of numbers
    return fit(rows.select("label", "text"), pooled, to_round)


def score_documents(docs: DataFrame, model: Discriminant, text_col: str = "text") -> DataFrame:
    """Columns ``row`` (the document) and ``score``; a null text counts as empty."""

    def fn(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(model.score(vectors(texts)), pa.float64())]

    return with_results(docs, [text_col], "score double", fn)


def filter_by_quality(docs: DataFrame, labels: DataFrame, learning, id_col: str = "doc_id", text_col: str = "text",
                      label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` whose score is ``threshold`` or more, as they came."""
    model = learn(docs, labels, learning, id_col, text_col, label_col)
    return score_documents(docs, model, text_col).where(F.col("score") >= threshold).select("row.*")
