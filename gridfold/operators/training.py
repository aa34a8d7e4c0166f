"""Training sets of labelled pixels, and classifiers over them."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, NaiveBayes, OneVsRest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridfold.operators.bands import lit
from gridfold.session import cut


def balanced(rows: DataFrame, most: int = 5000, seed: int = 1, label: str = "label", key: str = "id") -> DataFrame:
    """As many rows of each class as the first one (by label) has, `most` at most, in an order drawn by a hash of the key."""
    first = rows.groupBy(label).agg(F.count(F.lit(1)).alias("c")).agg(F.least(F.min_by("c", label), F.lit(most)).alias("take"))
    order = W.partitionBy(label).orderBy(F.xxhash64(F.lit(seed), key), key)
    return rows.withColumn("rank_", F.row_number().over(order)).crossJoin(F.broadcast(first)).where("rank_ <= take").drop("rank_", "take")


def labelled(classes: dict[str, DataFrame]) -> DataFrame:
    """Pixels of one table per class as one, the label being the class's place in name order."""
    out = None
    for i, name in enumerate(sorted(classes)):
        part = classes[name].withColumns({"label": F.lit(i), "class": F.lit(name)})
        out = part if out is None else out.unionByName(part)
    return out


def training_set(classes: dict[str, DataFrame], places: list[int], most: int = 5000, seed: int = 1) -> DataFrame:
    """(id, class, label, features): of each class's pixels(id, spectrum) that are lit, the bands at these places, as many of
    each class as of the first one in name order."""
    rows = labelled({name: pixels.where(lit(F.col("spectrum"))) for name, pixels in classes.items()})
    features = F.array(*[F.get("spectrum", F.lit(i)) for i in places])
    return balanced(rows, most, seed).select("id", "class", "label", features.alias("features"))


def text_lines(rows: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """'%-12.5f ... %-d': a row of aligned numbers and the class."""
    return rows.select(F.concat_ws(" ", F.transform(features, lambda v: F.format_string("%-12.5f", v)), F.format_string("%d", F.col(label).cast("int"))).alias("value"))


def from_lines(lines: DataFrame) -> DataFrame:
    parts = F.split(F.trim("value"), " +")
    n = F.size(parts)
    return lines.where(F.trim("value") != "").select(F.transform(F.slice(parts, 1, n - 1), lambda v: v.cast("double")).alias("features"), F.element_at(parts, -1).cast("int").alias("label"))


def classifier(rows: DataFrame, kind: str = "svm", cost: float = 1000.0, rounds: int = 50, features: str = "features", label: str = "label"):
    """A fitted model of linear support vectors (one against the rest), Gaussian naive Bayes, or a decision tree."""
    stage = {
        "svm": lambda: OneVsRest(classifier=LinearSVC(regParam=1.0 / cost, maxIter=rounds), featuresCol="v", labelCol=label),
        "bayes": lambda: NaiveBayes(modelType="gaussian", featuresCol="v", labelCol=label),
        "tree": lambda: DecisionTreeClassifier(featuresCol="v", labelCol=label, seed=1),
    }[kind]()
    # fitting reads its rows many times over
    return Pipeline(stages=[stage]).fit(cut(rows.select(label, array_to_vector(features).alias("v"))))


def classified(model, rows: DataFrame, features: str = "features") -> DataFrame:
    return model.transform(rows.withColumn("v", array_to_vector(features))).withColumn("prediction", F.col("prediction").cast("int")).drop("v", "rawPrediction", "probability")


class KernelMachine:
    """Radial-basis support vectors, one class against each other, by projected dual ascent on a bounded training set."""

    def __init__(self, cost: float = 100.0, gamma: float = 0.01, rounds: int = 300):
        self.cost, self.gamma, self.rounds = cost, gamma, rounds

    def _kernel(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.exp(-self.gamma * ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T))

    def fit(self, x: np.ndarray, y: np.ndarray) -> KernelMachine:
        self.x, self.classes = x, np.unique(y)
        k = self._kernel(x, x) + 1.0  # the constant stands for the offset
        step = 1.0 / np.linalg.eigvalsh(k)[-1]
        self.weights = []
        for c in self.classes:
            s = np.where(y == c, 1.0, -1.0)
            q, a = k * s[:, None] * s, np.zeros(len(y))
            for _ in range(self.rounds):
                a = np.clip(a + step * (1 - q @ a), 0, self.cost)
            self.weights.append(a * s)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        k = self._kernel(x, self.x) + 1.0
        return self.classes[np.argmax([k @ w for w in self.weights], 0)]


def kernel_classified(training: DataFrame, rows: DataFrame, cost: float = 100.0, gamma: float = 0.01, most: int = 5000) -> DataFrame:
    """rows(id, features) with the class by a kernel machine, fitted on at most so many training rows."""
    got = training.orderBy(F.xxhash64("id")).limit(most).collect()
    machine = rows.sparkSession.sparkContext.broadcast(KernelMachine(cost, gamma).fit(np.array([r.features for r in got]), np.array([r.label for r in got])))

    def run(frames):
        for f in frames:
            p = machine.value.predict(np.stack(f["features"].to_numpy())) if len(f) else []
            yield f[["id"]].assign(prediction=np.asarray(p, "int32"))

    return rows.select("id", "features").mapInPandas(run, "id long, prediction int")
