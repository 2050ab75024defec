"""Toxicity as severity grades: cumulative-link ordinal regression on sparse text features.

Features are the presence of words and of word beginnings (``PREFIXES`` bytes, so inflected forms
share one), and each of them again where it stands ``OFTEN`` times, known by 60 bits of their
hashes.  Labels know two classes; toxic rows are
split at their median number of telling features, which gives the grades 0, 1 and 2.  One weight
vector serves all thresholds: P(grade <= k) = sigmoid(theta_k - w x).

The classifier is fitted on a bounded sample: at most ``SAMPLE_ROWS`` labelled rows of each
class, lowest hash first.  Features that don't point to the toxic class there (``LEAST_DOCS``
rows, ``LEAST_Z`` deviations, the ``MOST_FEATURES`` strongest) have weight 0.  A quarter of the
sample is held out to set the score from which a document counts as toxic, where the share of
toxic rows missed plus twice the share of clean rows accused is least.  Scoring covers every row
and its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import words as W
from ledgerloom.llm.store import scratch, written

PREFIXES = (4, 6)
OFTEN = 3
SAMPLE_ROWS = 4000
LEAST_DOCS = 5
LEAST_Z = 5.0
MOST_FEATURES = 2048
GRADES = 3
#: how much worse it is to accuse a clean row than to miss a toxic one
ACCUSED_WEIGHT = 2


@dataclass
class SeverityModel:
    features: np.ndarray  # sorted feature numbers
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, GRADES - 1 of them
    cut: float  # a document is toxic from this score on


def text_features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a batch: first row, features of all words and beginnings, n + 1 offsets of the rows."""
    raw, offsets = W.text_buffers(column)
    for a, b in W.pieces(offsets):
        part = offsets[a : b + 1]
        both, at = W.word_and_beginning_hashes(raw[part[0] : part[-1]], part - part[0], W.ALNUM, PREFIXES)
        yield a, (both >> np.uint64(4)).astype(np.int64), at


def doc_features(features: np.ndarray) -> np.ndarray:
    """The distinct features of one document."""
    once, n = np.unique(features, return_counts=True)
    often = W.mix(once[n >= OFTEN].astype(np.uint64) + np.uint64(1 << 61)) >> np.uint64(4)
    return np.concatenate([once, often.astype(np.int64)])


def _features_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features beside the labels."""
    for batch in batches:
        for a, features, at in text_features(batch.column("text")):
            rows = [doc_features(features[at[i] : at[i + 1]]) for i in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(a, len(rows)) for c in ("labelled_id", "toxic")] + [pa.array(rows, pa.list_(pa.int64()))], ["labelled_id", "toxic", "features"])


def fit_ordinal(x: np.ndarray, y: np.ndarray, grades: int, l2: float = 1e-4, rounds: int = 300, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds by gradient steps (Adam) on the mean log-likelihood."""
    n, k = len(x), grades - 1
    w = np.zeros(x.shape[1])
    first, gaps = -0.5, np.zeros(k - 1)  # thresholds: first, then exp(gaps) apart
    par = np.concatenate([w, [first], gaps])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, rounds + 1):
        w, theta = par[: x.shape[1]], np.cumsum(np.concatenate([par[x.shape[1] : x.shape[1] + 1], np.exp(par[x.shape[1] + 1 :])]))
        bounds = np.concatenate([[-40.0], theta, [40.0]])
        score = x @ w
        up, low = 1 / (1 + np.exp(score - bounds[y + 1])), 1 / (1 + np.exp(score - bounds[y]))
        p = np.maximum(up - low, 1e-12)
        d_up, d_low = up * (1 - up) / p, low * (1 - low) / p
        g_theta = np.array([(d_up[y == j].sum() - d_low[y == j + 1].sum()) for j in range(k)]) / n
        tail = np.cumsum(g_theta[::-1])[::-1]
        g = -np.concatenate([-(x.T @ (d_up - d_low)) / n, tail[:1], tail[1:] * np.exp(par[x.shape[1] + 1 :])])
        g[: x.shape[1]] += l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        par = par - rate * (1 - step / (rounds + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return par[: x.shape[1]], np.cumsum(np.concatenate([par[x.shape[1] : x.shape[1] + 1], np.exp(par[x.shape[1] + 1 :])]))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(labelled_id, toxic, text) of at most ``rows`` labelled ids of each class, lowest hash first.

    One row an id: of several rows of a document the text with the lowest hash.
    """
    per = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    per = per.select(F.col("doc_id").cast("long").alias("labelled_id"), (F.col("toxic") > 0).cast("int").alias("toxic"))
    order = [F.xxhash64("labelled_id"), "labelled_id"]
    ids = per.where("toxic = 1").orderBy(*order).limit(rows).unionByName(per.where("toxic = 0").orderBy(*order).limit(rows))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    labelled = texts.join(ids, F.col("doc_id") == F.col("labelled_id"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one")
    return labelled.groupBy("labelled_id", "toxic").agg(one).select("labelled_id", "toxic", F.col("one.text").alias("text"))


def best_cut(scores: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the gap between held-out scores where the error is least, the highest of ties."""
    known = np.unique(scores)
    at = np.concatenate([(known[1:] + known[:-1]) / 2, [known[-1] + 1]])
    missed = np.searchsorted(np.sort(scores[toxic]), at) / max(toxic.sum(), 1)
    accused = 1 - np.searchsorted(np.sort(scores[~toxic]), at) / max((~toxic).sum(), 1)
    error = missed + ACCUSED_WEIGHT * accused
    return float(at[np.flatnonzero(error == error.min())[-1]])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> SeverityModel:
    """Without labelled rows of both classes, or features that tell them apart, everything is grade 0."""
    nothing = SeverityModel(np.empty(0, np.int64), np.empty(0), np.array([20.0, 30.0]), np.inf)
    with scratch(docs.sparkSession):
        return _fitted(docs, labels, rows, nothing)


def _fitted(docs: DataFrame, labels: DataFrame, rows: int, nothing: SeverityModel) -> SeverityModel:
    data, _ = written(labelled_sample(docs, labels, rows).mapInArrow(_features_task, "labelled_id long, toxic int, features array<long>"), "toxicity-sample")
    held = F.pmod(F.xxhash64(F.col("labelled_id") + 1), F.lit(4)) == 0
    sizes = {(r["held"], r["toxic"]): r["n"] for r in data.groupBy(held.alias("held"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get((False, 1), 0), sizes.get((False, 0), 0)
    if not bad or not good:
        return nothing
    per = data.where(~held).select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.sum("toxic").alias("in_bad"), F.sum(1 - F.col("toxic")).alias("in_good"))
    rate = (F.col("in_bad") + F.col("in_good")) / F.lit(bad + good)
    z = (F.col("in_bad") / bad - F.col("in_good") / good) / F.sqrt(rate * (1 - rate) * F.lit(1 / bad + 1 / good) + F.lit(1e-12))
    chosen = per.withColumn("z", z).where((F.col("in_bad") + F.col("in_good") >= LEAST_DOCS) & (F.col("z") >= LEAST_Z))
    features = np.array(sorted(r["f"] for r in chosen.orderBy(F.col("z").desc(), "f").limit(MOST_FEATURES).collect()), np.int64)
    if not len(features):
        return nothing

    known = F.array(*map(F.lit, features.tolist())).cast("array<long>")
    sample = data.select("labelled_id", "toxic", held.alias("held"), F.array_intersect("features", known).alias("f")).collect()
    sample.sort(key=lambda r: (r["labelled_id"], r["f"]))  # at most 2 * rows short rows
    x = np.zeros((len(sample), len(features)))
    for i, r in enumerate(sample):
        x[i, np.searchsorted(features, r["f"])] = 1
    toxic, kept_out = np.array([r["toxic"] == 1 for r in sample]), np.array([r["held"] for r in sample])
    telling = x.sum(axis=1)
    grade = toxic.astype(np.int64) + (toxic & (telling > np.median(telling[toxic])))
    weights, thresholds = fit_ordinal(x[~kept_out], grade[~kept_out], GRADES)
    judge = kept_out if toxic[kept_out].any() and not toxic[kept_out].all() else ~kept_out
    return SeverityModel(features, weights, thresholds, best_cut((x @ weights)[judge], toxic[judge]))


def scores_of(model: SeverityModel, column: pa.Array) -> np.ndarray:
    """Weighted features of each row of a text column."""
    out = np.zeros(len(column))
    if not len(model.features):
        return out
    base = model.features
    for a, features, at in text_features(column):
        for i in range(len(at) - 1):
            present = doc_features(features[at[i] : at[i + 1]])
            near = np.minimum(np.searchsorted(base, present), len(base) - 1)
            out[a + i] = model.weights[near[base[near] == present]].sum()
    return out


def grade_chances(model: SeverityModel, scores: np.ndarray) -> np.ndarray:
    """P(grade = k) for each score."""
    below = 1 / (1 + np.exp(np.clip(scores[:, None] - model.thresholds[None, :], -500, 500)))
    return np.diff(np.concatenate([np.zeros((len(scores), 1)), below, np.ones((len(scores), 1))], axis=1), axis=1)


def score(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, expected_severity (0 to 2), grade (the
    likeliest, the lower of ties) and toxic.

    Null and empty texts have no features and get the base severity; repeated rows are scored
    alike; other columns don't matter; an empty table gives no rows.
    """

    def task(batches):
        for batch in batches:
            scores = scores_of(model, batch.column("text"))
            p = grade_chances(model, scores)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(p @ np.arange(p.shape[1])), pa.array(p.argmax(axis=1), pa.int64()), pa.array(scores >= model.cut)],
                ["doc_id", "expected_severity", "grade", "toxic"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, expected_severity double, grade long, toxic boolean")


def keep_civil(docs: DataFrame, model: SeverityModel) -> DataFrame:
    """The rows of ``docs`` that aren't toxic, with all their columns."""
    at = docs.columns.index("text")

    def task(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores_of(model, batch.column(at)) < model.cut))

    return docs.mapInArrow(task, T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema]))
