"""Boosted trees with isotonic calibration over dense features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A calibrated score keeps this much of the trees' own probability, so that the steps of
# the calibration do not make ties of different scores.
ORDER_SHARE = 0.02


@dataclass(frozen=True)
class BoostedModel:
    """Trees and their calibration; without both, one score for all rows."""

    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float = 0.0

    def score(self, rows: DataFrame, into: str = "score") -> DataFrame:
        """``rows`` with a score from 0 to 1 made from their ``features array<double>``."""
        if self.trees is None:
            return rows.withColumn(into, F.lit(self.constant))
        scored = rows.withColumn("_vector", array_to_vector("features"))
        scored = self.trees.setFeaturesCol("_vector").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_both").transform(scored)
        scored = scored.withColumn("_raw", vector_to_array("_both")[1])
        if self.calibration is None:
            return scored.withColumn(into, F.col("_raw")).drop("_vector", "_both", "_raw")
        scored = self.calibration.setFeaturesCol("_raw").setPredictionCol("_fit").transform(scored)
        mixed = (1 - ORDER_SHARE) * F.col("_fit") + ORDER_SHARE * F.col("_raw")
        return scored.withColumn(into, F.greatest(F.lit(0.0), F.least(F.lit(1.0), mixed))).drop("_vector", "_both", "_raw", "_fit")


def fit(rows: DataFrame, trees: int = 20, depth: int = 3, seed: int = 11) -> BoostedModel:
    """Fit on ``rows (features, label, part)``; rows with ``part`` 0 only calibrate.

    ``rows`` must be a bounded, written table: it is read once per level of each tree.
    With one label only, or none, every row gets that label's share as its score.
    """
    counts = {(r.fold, int(r.label)): r["count"] for r in rows.groupBy((F.col("part") == 0).alias("fold"), "label").count().collect()}
    total = sum(counts.values())
    positive = sum(n for (_, label), n in counts.items() if label == 1)
    if positive in (0, total):
        return BoostedModel(None, None, positive / total if total else 0.0)
    # Too few rows to set some apart: the trees see all of them and stay uncalibrated.
    apart = all(counts.get((fold, label), 0) >= 10 for fold in (True, False) for label in (0, 1))
    vectors = rows.withColumn("vector", array_to_vector("features"))
    grower = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2, maxBins=64, seed=seed)
    model = grower.fit(vectors.where("part <> 0") if apart else vectors)
    if not apart:
        return BoostedModel(model, None)
    raw = model.transform(vectors.where("part = 0")).select("label", vector_to_array("probability")[1].alias("raw"))
    return BoostedModel(model, IsotonicRegression(featuresCol="raw", labelCol="label").fit(raw))
