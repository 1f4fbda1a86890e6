"""Quality classifier: histogram gradient-boosted trees over document statistics, as flat arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.labelled import FOLDS, HELD_OUT, SAMPLE, STATISTICS, statistics, training_sample
from parcelspark.llm.text import fold, slices

THRESHOLD = 0.7


@dataclass
class Trees:
    """Complete binary trees of one depth: node i's children are 2 i + 1 (at most the threshold) and
    2 i + 2; a node that was not split sends everything left. All trees' nodes lie in flat arrays."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.bias)
        inner, leaves = (1 << self.depth) - 1, 1 << self.depth
        for t in range(len(self.value) // leaves):
            feature, threshold = self.feature[t * inner : (t + 1) * inner], self.threshold[t * inner : (t + 1) * inner]
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += self.value[t * leaves + node - inner]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least: float = 4.0, ridge: float = 1.0) -> Trees:
    """Boosting on the logistic loss. Values are binned at quantiles once; a node's best split is read off
    its histograms of gradients and hessians. Without rows, or with one class alone, there is no tree
    and every score is the smoothed share of label 1."""
    n, width = x.shape
    bias = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    none = Trees(np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0), depth, bias)
    if not n or y.min() == y.max():
        return none
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower").astype(np.float32)) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1) + np.arange(width) * bins
    features, thresholds, values = [], [], []
    margin = np.full(n, bias)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node, feature, threshold = np.zeros(n, np.int64), np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            cell = ((node - first) * (width * bins))[:, None] + binned
            size = count * width * bins
            g = np.bincount(cell.ravel(), np.repeat(grad, width), size).reshape(count, width, bins).cumsum(2)
            h = np.bincount(cell.ravel(), np.repeat(hess, width), size).reshape(count, width, bins).cumsum(2)
            total_g, total_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge) - total_g**2 / (total_h + ridge)
            gain[(h < least) | (total_h - h < least)] = 0
            best = gain.reshape(count, -1).argmax(1)
            for k in range(count):
                j, b = divmod(int(best[k]), bins)
                if gain[k, j, b] > 1e-6 and b < len(edges[j]):
                    feature[first + k], threshold[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + ridge)
        margin += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.concatenate(features), np.concatenate(thresholds), np.concatenate(values), depth, bias)


def _statistics(column: pa.Array) -> np.ndarray:
    return np.concatenate([np.zeros((0, len(STATISTICS)), np.float32), *(statistics(x) for x in slices(column))])


def train(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE, label: str = "quality") -> Trees:
    """Trees fitted on at most `limit` labelled rows, whose statistics (not texts) reach the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.FixedSizeListArray.from_arrays(pa.array(_statistics(batch.column(2)).ravel()), len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), x.cast(pa.list_(pa.float32()))], ["doc_id", "y", "x"])

    found = training_sample(docs, labels, label, limit).select(F.col("doc_id").cast("long"), "y", "text").mapInArrow(rows, "doc_id long, y int, x array<float>").toArrow().sort_by("doc_id")
    x = found["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
    return fit(x, (found["y"].to_numpy() > 0).astype(np.float64))


def score_quality(docs: DataFrame, trees: Trees) -> DataFrame:
    """`docs` and a double column `quality_score` (a column of that name is replaced): 0 to 1, from the
    whole text alone. Null and empty texts are scored by the statistics of an empty text; repeated rows
    and ties score alike; an empty table gives no rows."""
    columns = [c for c in docs.columns if c != "quality_score"]
    place = columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(trees.scores(_statistics(batch.column(place))))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "quality_score"])

    kept = docs.select(*(F.col(f"`{c}`") for c in columns))
    return kept.mapInArrow(scored, kept.select("*", F.lit(0.0).alias("quality_score")).schema)


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    trees = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = score_quality(docs, trees).select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), F.col("quality_score").alias("score"))
    return scores.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
