"""Quality classifier: histogram gradient-boosted trees over text statistics.

The statistics are DataFrame expressions; trees are fitted with numpy on a
bounded sample of labelled rows (``SAMPLE``, drawn by a hash of the id) and
flattened into three arrays, which a vectorised pandas UDF walks for all rows
of a batch at once, level by level. Only numbers, never texts, reach Python.

Defined cases: empty and null texts get the score of their zero statistics;
without labels of both kinds every score is the share of good labels (0.5
without any); null and repeated ids keep their rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm.statistics import FEATURES, id_remainder, labelled_statistics, with_statistics
from zonecast.llm.storage import column_of, documents, numbered, picked

SAMPLE = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
TREES, DEPTH, RATE, BINS, RIDGE, LEAST = 40, 4, 0.2, 64, 1.0, 8


@dataclass
class Forest:
    """Complete trees of one depth: split feature and threshold of each inner node, value of each leaf."""
    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            while len(x) and node[0] < len(feature):           # all rows are on the same level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Boosted trees for P(y = 1), split by histograms of at most BINS intervals a feature."""
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3)))
    inner = 2 ** depth - 1
    forest = Forest(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf),
                    np.zeros((trees, inner + 1)))
    if share in (0.0, 1.0) or not len(y):
        return Forest(base, forest.feature[:0], forest.threshold[:0], forest.leaf[:0])
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)  # bin > k: x > edges[k]
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, wide = 2 ** level - 1, 2 ** level
            at = node - first
            total_g, total_h = np.bincount(at, grad, wide), np.bincount(at, hess, wide)
            gain = np.full(wide, 1e-6)
            for f, cut in enumerate(edges):
                cell, cells = at * (BINS + 1) + bins[:, f], wide * (BINS + 1)
                left = [np.bincount(cell, v, cells).reshape(wide, -1).cumsum(1)[:, :len(cut)]
                        for v in (grad, hess, None)]
                size = np.bincount(at, minlength=wide)[:, None]
                rest_g, rest_h = total_g[:, None] - left[0], total_h[:, None] - left[1]
                won = (left[0] ** 2 / (left[1] + RIDGE) + rest_g ** 2 / (rest_h + RIDGE)
                       - (total_g ** 2 / (total_h + RIDGE))[:, None])
                won[(left[2] < LEAST) | (size - left[2] < LEAST)] = 0
                if not won.size:
                    continue
                best = won.argmax(1)
                value = won[np.arange(wide), best]
                better = value > gain
                gain = np.where(better, value, gain)
                forest.feature[t, first:first + wide][better] = f
                forest.threshold[t, first:first + wide][better] = cut[best[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), forest.feature[t, node]] > forest.threshold[t, node])
        leaf = node - inner
        forest.leaf[t] = RATE * np.bincount(leaf, grad, inner + 1) / (np.bincount(leaf, hess, inner + 1) + RIDGE)
        margin += forest.leaf[t, leaf]
    return forest


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Trees from labelled rows outside the held-out fold."""
    seen = id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT
    table = labelled_statistics(docs, labels, sample, seen).toPandas().sort_values("doc_id")
    return fit(table[list(FEATURES)].to_numpy(float), (table["quality"].to_numpy() != 0).astype(float))


def with_score(docs: DataFrame, forest: Forest) -> DataFrame:
    """``numbered(docs)`` with the score of each text in column score."""
    @F.pandas_udf("double")
    def scored(*columns: pd.Series) -> pd.Series:
        return pd.Series(forest.score(np.column_stack([c.to_numpy(float) for c in columns])))

    scored = scored.asNondeterministic()        # a filter on the score stays above its computation
    rows = numbered(docs)
    counted = with_statistics(rows, column_of(docs, "text"))
    return counted.select(*rows.columns, scored(*[F.col(f) for f in FEATURES]).alias("score"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject, with all their columns."""
    scored = with_score(docs, train(docs, labels))
    return scored.where(F.col("score") >= threshold).drop("score").toDF(*docs.columns)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    forest = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    doc_id = column_of(docs, "doc_id")
    return with_score(docs, forest).select(
                       doc_id.alias("doc_id"), (id_remainder(doc_id, FOLDS) == HELD_OUT).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
