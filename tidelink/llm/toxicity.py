"""Toxicity severity by cumulative-link ordinal regression.

P(grade >= k) = sigmoid(w . x - t_k): one weight vector shared by ordered
thresholds t_1 < t_2 < ... The features are sparse: which hashed words and
character windows occur in a text. Those that mark toxic training rows (by
the log-likelihood ratio of their counts) are kept. The output is the
expected grade, the sum of the probabilities of reaching each grade.

Grades come from the caller, or from labels of toxic or not: rows that are
not toxic have grade 0, toxic ones 1 to 3 by the third they fall in when
ordered by how many of the marking features they show.

Defined results: a null, empty or letterless text has no features and gets
the severity of the empty text; without toxic or without clean training rows
every text has severity 0; whole texts are used; a row labelled twice counts
as toxic if one label says so; other columns pass through, and columns named
like the outputs are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelink.llm.common import Remembered, without
from tidelink.session import materialize

BUCKETS = 1 << 20
WINDOWS = (4, 5, 6)
# At most this many labelled ids of either kind train the model.
SAMPLE_ROWS = 4000
MAX_FEATURES = 2000
MIN_RATIO = 25.0  # log-likelihood ratio of a marking feature
MIN_LIFT = 5.0  # and its rate in toxic rows against that in the others
GRADES = 3
STEPS, RATE, PENALTY = 600, 0.1, 1e-4
CACHE_ENTRIES = 300_000

_WORDS = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[int]:
    """Buckets of a lower-cased word and of its character windows."""
    marked = f" {word} "
    pieces = chain(["=" + word], (marked[i:i + n] for n in WINDOWS for i in range(len(marked) - n + 1)))
    return sorted({crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in pieces})  # at most BUCKETS


def text_words(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


@lru_cache(maxsize=1)
def _features_of() -> Remembered:
    return Remembered(word_features, 50_000)


@dataclass
class SeverityModel:
    buckets: np.ndarray  # kept features, ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def reach(self, eta: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row for each linear predictor."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - eta[:, None], -500, 500)))


def fit_ordinal(x: list[np.ndarray], grade: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds by gradient descent on the penalised
    cumulative-link likelihood; ``x`` has each row's feature numbers.

    Thresholds are a first value and positive gaps, so they stay ordered.
    """
    k, n = int(grade.max()), len(grade)
    rows = np.repeat(np.arange(n), [len(f) for f in x])
    cols = np.concatenate(x).astype(np.int64) if rows.size else np.zeros(0, np.int64)
    share = np.array([(grade >= j).mean() for j in range(1, k + 1)]).clip(1e-6, 1 - 1e-6)
    start = -np.log(share / (1 - share))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    theta = np.concatenate([np.zeros(n_features), free])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        w, t = theta[:n_features], theta[n_features] + np.concatenate([[0], np.cumsum(np.exp(theta[n_features + 1:]))])
        eta = np.bincount(rows, w[cols], n)
        # F(k) = P(grade >= k), with F(0) = 1 and F(K + 1) = 0
        up = 1 / (1 + np.exp(np.clip(t[None, :] - eta[:, None], -500, 500)))
        edge = np.hstack([np.ones((n, 1)), up, np.zeros((n, 1))])
        slope = edge * (1 - edge)
        at = np.arange(n)
        p = np.maximum(edge[at, grade] - edge[at, grade + 1], 1e-12)
        d_eta = (slope[at, grade] - slope[at, grade + 1]) / p
        d_t = np.zeros((n, k + 2))
        d_t[at, grade] -= slope[at, grade] / p
        d_t[at, grade + 1] += slope[at, grade + 1] / p
        g_t = d_t[:, 1:k + 1].mean(axis=0)
        tail = np.cumsum(g_t[::-1])[::-1]
        grad = np.concatenate([np.bincount(cols, d_eta[rows], n_features) / n - PENALTY * w,
                               tail[:1], tail[1:] * np.exp(theta[n_features + 1:])])
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad ** 2
        theta = theta + RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return theta[:n_features], theta[n_features] + np.concatenate([[0], np.cumsum(np.exp(theta[n_features + 1:]))])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
        sample_rows: int = SAMPLE_ROWS) -> SeverityModel | None:
    """Train on at most ``sample_rows`` toxic and as many other labelled ids,
    those of the least hashes; an id of several rows shows what any of them shows."""
    spark = docs.sparkSession
    known = labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).alias("_id")).agg((F.max(toxic_col) > 0).alias("toxic"))
    known = materialize(known.select("*", F.xxhash64("_id").alias("_pick")))
    drawn = [known.where(c).orderBy("_pick", "_id").limit(sample_rows) for c in ("toxic", "not toxic")]
    chosen = drawn[0].union(drawn[1]).select("_id", "toxic")  # at most two samples of ids
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _features_of()
        for batch in batches:
            found: dict = {}  # rows of one id in a batch are one
            for i, toxic, t in zip(*(batch.column(c).to_pylist() for c in ("_id", "toxic", "text"))):
                found.setdefault((i, toxic), set()).update(*(of[w] for w in text_words(t)))
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], batch.schema.field("_id").type),
                                              pa.array([y for _, y in found], pa.bool_()),
                                              pa.array([sorted(f) for f in found.values()], pa.list_(pa.int32()))],
                                             ["_id", "toxic", "features"])

    id_type = docs.schema[id_col].dataType.simpleString()
    sample = materialize(rows.mapInArrow(featured, f"_id {id_type}, toxic boolean, features array<int>"))
    # an id has the features of all its rows, each once: those of several rows meet as pairs
    ids = materialize(sample.groupBy("_id", "toxic").agg((F.count("*") > 1).alias("several")))
    totals = {r["toxic"]: r["count"] for r in ids.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return None
    # log-likelihood ratio of each feature's two-by-two table
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    n1, n0 = float(totals[True]), float(totals[False])
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    s = (a + b) / (n1 + n0)
    ratio = 2 * (term(a, n1 * s) + term(b, n0 * s) + term(n1 - a, n1 * (1 - s)) + term(n0 - b, n0 * (1 - s)))
    rows_of = sample.join(F.broadcast(ids.select("_id", "several")), "_id")  # at most two samples of ids
    pairs = lambda several: rows_of.where(F.col("several") == several).select(
        "_id", "toxic", F.explode("features").alias("f"))
    counted = pairs(False).unionByName(pairs(True).distinct()).groupBy("f").agg(
        F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b"))
    marking = (counted.where(a / n1 > MIN_LIFT * b / n0).select("f", ratio.alias("g")).where(F.col("g") >= MIN_RATIO)
               .orderBy(F.desc("g"), "f").limit(MAX_FEATURES))
    buckets = np.array(sorted(r["f"] for r in marking.collect()), np.int64)
    if not len(buckets):
        return None
    keep = spark.createDataFrame(pd.DataFrame({"f": buckets.astype(np.int32), "k": np.arange(len(buckets), dtype=np.int32)}))
    hits = sample.select("_id", F.explode("features").alias("f")).join(F.broadcast(keep), "f").select("_id", "k").distinct()
    hits = hits.groupBy("_id").agg(F.sort_array(F.collect_list("k")).alias("k"))  # at most MAX_FEATURES of an id
    table = ids.select("_id", "toxic").join(hits, "_id", "left").orderBy(F.xxhash64("_id"), "_id").collect()
    x = [np.array(r["k"] or [], np.int64) for r in table]
    toxic = np.array([r["toxic"] for r in table])
    shown = np.array([len(f) for f in x])
    edges = np.quantile(shown[toxic], [i / GRADES for i in range(1, GRADES)])
    grade = np.where(toxic, 1 + np.searchsorted(edges, shown, "left"), 0)
    _, grade = np.unique(grade, return_inverse=True)  # thirds that coincide are one grade
    weights, thresholds = fit_ordinal(x, grade.astype(np.int64), len(buckets))
    return SeverityModel(buckets, weights, thresholds)


@lru_cache(maxsize=1)
def _kept_of(buckets: bytes) -> Remembered:
    number = {int(b): k for k, b in enumerate(np.frombuffer(buckets, np.int64))}

    def kept(word: str) -> tuple[int, ...]:
        return tuple(number[f] for f in word_features(word) if f in number)

    return Remembered(kept, CACHE_ENTRIES)


def score(docs: DataFrame, model: SeverityModel | None, text_col: str = "text") -> DataFrame:
    """Add ``severity`` (expected grade), ``toxic_probability`` (of grade 1 or
    more) and ``toxic`` (that probability is at least one half)."""
    base = without(docs, "severity", "toxic_probability", "toxic")
    if model is None:
        return base.select("*", F.lit(0.0).alias("severity"), F.lit(0.0).alias("toxic_probability"),
                           F.lit(False).alias("toxic"))
    shared = base.sparkSession.sparkContext.broadcast(model)  # at most MAX_FEATURES weights

    @F.pandas_udf("severity double, toxic_probability double, toxic boolean")
    def scored(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        of = _kept_of(m.buckets.tobytes())
        eta = np.zeros(len(texts))
        for i, t in enumerate(texts):
            hits = set().union(*map(of.__getitem__, text_words(t)))
            if hits:
                eta[i] = m.weights[list(hits)].sum()
        reach = m.reach(eta)
        return pd.DataFrame({"severity": reach.sum(axis=1), "toxic_probability": reach[:, 0], "toxic": reach[:, 0] >= 0.5})

    return base.select("*", scored(F.col(text_col)).alias("_p")).select(*[F.col(f"`{c}`") for c in base.columns], "_p.*")
