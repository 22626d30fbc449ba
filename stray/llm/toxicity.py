"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

The model has one weight vector w, shared by all thresholds, and ordered thresholds
t1 < t2 < ... : P(grade >= k | x) = sigmoid(w x - t_k). Features are log(1 + count) of the
terms that a bounded sample of labelled documents ties to the label by their log odds:
words, and the beginnings of words, which inflected forms share.
The expected severity is the sum of P(grade >= k) over k.

The labels say toxic or not; grades above 0 come from how many words of a labelled-toxic
document are terms that favour the label: up to the first and second third of that count
among them is grade 1 and 2, beyond is grade 3. Fitting uses at most `sample` documents
of each class, those with the least hash of their id; classes are weighted back to their
share in the labels. Scoring streams over all documents with the weights, a table of at
most `terms` entries.

Defined cases: a null or empty text has no features; null labels and labels without a
document are ignored; several labels of one document count as the highest; without
labels of both classes nothing is toxic and the severity is 0; repeated rows are scored
each; extra columns stay in one struct and cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from stray.llm.common import bounded_batches, text_of

GRADES = 3
WORD = re.compile(r"[^\W_]+")
#: Letters of the beginnings of words that are terms too; shorter words have none.
BEGINNINGS = (4, 5)


@dataclass(frozen=True)
class Fit:
    """sample: labelled documents of each class at most; terms: features at most, of those
    in min_docs documents with log odds of min_odds and min_z deviations of it or more."""

    sample: int = 3000
    terms: int = 2000
    min_docs: int = 5
    min_odds: float = 3.0
    min_z: float = 2.9
    l2: float = 0.02
    steps: int = 400
    rate: float = 0.1


@dataclass
class OrdinalModel:
    weights: dict[str, float] = field(default_factory=dict)
    thresholds: list[float] = field(default_factory=list)

    def grade_probabilities(self, text: str) -> list[float]:
        """P(grade >= k) for k = 1, 2, ...; no thresholds: all 0."""
        w = self.weights
        counts = Counter(t for t in terms_of(text) if t in w) if w else {}
        x = sum(w[t] * math.log1p(c) for t, c in counts.items())
        return [1 / (1 + math.exp(-max(-500.0, min(500.0, x - t)))) for t in self.thresholds] or [0.0] * GRADES


def terms_of(text: str) -> list[str]:
    """Lower-case words, and marked beginnings of them."""
    words = WORD.findall(text.lower())
    return words + [w[:n] + "-" for n in BEGINNINGS for w in words if len(w) > n]


def fit_cumulative_link(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, grade: np.ndarray, weight: np.ndarray,
                        n_terms: int, f: Fit) -> tuple[np.ndarray, np.ndarray]:
    """(w, thresholds) minimising the weighted negative log likelihood plus l2 |w|^2 / 2, by Adam.

    Thresholds are t1 and positive gaps exp(g2), exp(g3), which keeps their order.
    """
    n, top = len(grade), GRADES
    weight = weight / weight.sum()
    w, t1, gaps = np.zeros(n_terms), 1.0, np.zeros(top - 1)
    m, v = np.zeros(n_terms + top), np.zeros(n_terms + top)
    for step in range(1, f.steps + 1):
        t = t1 + np.r_[0.0, np.cumsum(np.exp(gaps))]
        x = np.bincount(rows, vals * w[cols], n)
        s = 1 / (1 + np.exp(-np.clip(x[:, None] - t, -60, 60)))  # P(grade >= k)
        above = np.c_[np.ones(n), s, np.zeros(n)]
        d_above = np.c_[np.zeros(n), s * (1 - s), np.zeros(n)]
        i = np.arange(n)
        p = np.maximum(above[i, grade] - above[i, grade + 1], 1e-12)
        low, high = d_above[i, grade] / p, d_above[i, grade + 1] / p
        dx = -weight * (low - high)
        dt = np.zeros(top)
        np.add.at(dt, np.maximum(grade - 1, 0), np.where(grade > 0, weight * low, 0.0))
        np.add.at(dt, np.minimum(grade, top - 1), np.where(grade < top, -weight * high, 0.0))
        tail = np.cumsum(dt[::-1])[::-1]
        g = np.r_[np.bincount(cols, vals * dx[rows], n_terms) + f.l2 / n * w, tail[0], tail[1:] * np.exp(gaps)]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = f.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, t1, gaps = w - move[:n_terms], t1 - move[n_terms], gaps - move[n_terms + 1:]
    return w, t1 + np.r_[0.0, np.cumsum(np.exp(gaps))]


def fit_model(texts: list[str], toxic: np.ndarray, share: float, f: Fit = Fit()) -> OrdinalModel:
    """Choose the features, grade the toxic texts, and fit; `share` is the label's share at large."""
    n1, n0 = int(toxic.sum()), int((1 - toxic).sum())
    if not n1 or not n0:
        return OrdinalModel()
    bags = [Counter(terms_of(t)) for t in texts]
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for bag, y in zip(bags, toxic):
        seen[y].update(bag.keys())
    z = {}
    for term in seen[0].keys() | seen[1].keys():
        a, b = seen[1][term], seen[0][term]
        if a + b >= f.min_docs:
            odds = math.log((a + .5) / (n1 - a + .5)) - math.log((b + .5) / (n0 - b + .5))
            if abs(odds) >= f.min_odds:
                z[term] = odds / math.sqrt(1 / (a + .5) + 1 / (n1 - a + .5) + 1 / (b + .5) + 1 / (n0 - b + .5))
    chosen = sorted((t for t in z if abs(z[t]) >= f.min_z), key=lambda t: (-abs(z[t]), t))[:f.terms]
    if not chosen:
        return OrdinalModel()
    code = {t: i for i, t in enumerate(chosen)}
    favours = {t for t in chosen if z[t] > 0}
    hits = np.array([sum(c for t, c in bag.items() if t in favours) for bag in bags])
    cuts = np.quantile(hits[toxic == 1], [1 / 3, 2 / 3], method="lower")
    grade = np.where(toxic == 1, 1 + (hits > cuts[0]) + (hits > cuts[1]), 0)
    cells = [(i, code[t], math.log1p(c)) for i, bag in enumerate(bags) for t, c in bag.items() if t in code]
    rows, cols, vals = (np.array(x) for x in zip(*cells))
    weight = np.where(toxic == 1, share / n1, (1 - share) / n0)
    w, t = fit_cumulative_link(rows, cols, vals, grade, weight, len(chosen), f)
    return OrdinalModel({term: float(w[i]) for term, i in code.items()}, t.tolist())


def train(docs: DataFrame, labels: DataFrame, f: Fit = Fit()) -> OrdinalModel:
    """Fit on at most `f.sample` labelled documents of each class."""
    marks = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
             .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("y")))
    sizes = {r.y: r.n for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return OrdinalModel()
    few = None
    for y in (0, 1):
        part = marks.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(f.sample)
        few = part if few is None else few.union(part)
    found = (docs.select(F.col("doc_id").cast("long").alias("id"), text_of("text").alias("t"))
             .join(F.broadcast(few), "id")  # at most 2 * f.sample rows
             .groupBy("id").agg(F.max("y").alias("y"), F.min("t").alias("t")).orderBy("id").toPandas())
    return fit_model(found["t"].tolist(), found["y"].to_numpy(np.int64), sizes[1] / (sizes[0] + sizes[1]), f)


SCORES = StructType([StructField("p", DoubleType()), StructField("p2", DoubleType()), StructField("p3", DoubleType()),
                     StructField("severity", DoubleType()), StructField("grade", LongType())])


def grade_documents(docs: DataFrame, labels: DataFrame, f: Fit = Fit()) -> DataFrame:
    """(doc, s) per row: the row as a struct, and P(grade >= k), expected severity and likeliest grade."""
    bounded_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, f))  # at most f.terms weights

    @F.pandas_udf(SCORES)
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            p = np.array([model.value.grade_probabilities(t) for t in texts], dtype=float).reshape(-1, GRADES)
            each = -np.diff(np.c_[np.ones(len(p)), p, np.zeros(len(p))], axis=1)
            grade = each.argmax(axis=1) if len(p) else np.zeros(0, np.int64)
            yield pd.DataFrame(np.c_[p, p.sum(axis=1)], columns=SCORES.names[:4]).assign(grade=grade.astype("int64"))

    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), text_of("text").alias("_t")).select(
        "doc", scores("_t").alias("s"))


def toxicity_query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's grade probabilities, expected severity, grade, and whether it is toxic."""
    out = grade_documents(docs.select("doc_id", "text"), labels)
    return out.select("doc.doc_id", F.col("s.severity").alias("expected_severity"), F.col("s.grade").alias("grade"),
                      F.col("s.p").alias("p_grade_1"), F.col("s.p2").alias("p_grade_2"), F.col("s.p3").alias("p_grade_3"),
                      (F.col("s.p") >= 0.5).alias("toxic"))


def toxicity_stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic."""
    return grade_documents(docs, labels).where("s.p < 0.5").select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
