"""Features, clustering, random forest, reports."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_missing(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows whose features are all there, neither null nor NaN."""
    return df.dropna(subset=features)


def missing_report(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, missing, percent), in one pass."""
    n = [F.count_if(F.col(f).isNull() | F.isnan(F.col(f).cast("double"))).alias(f) for f in features]
    rows = [F.struct(F.lit(f).alias("feature"), F.col(f).alias("missing"), (F.col(f) / F.col("_n") * 100).alias("percent")) for f in features]
    return df.agg(*n, F.count(F.lit(1)).alias("_n")).select(F.inline(F.array(*rows)))


def standardise(df: DataFrame, features: list[str]) -> DataFrame:
    """M1: features less their means, over their population deviations (0 deviation: 1). One pass for the statistics,
    which are constants of the second."""
    s = df.agg(*[a for f in features for a in (F.avg(f).alias(f"{f}_m"), F.stddev_pop(f).alias(f"{f}_s"))]).first()
    return df.withColumns({f: (F.col(f) - F.lit(s[f"{f}_m"])) / F.lit(s[f"{f}_s"] or 1.0) for f in features}) if s and s[f"{features[0]}_m"] is not None else df


def class_centroid_distance(df: DataFrame, cls: str, features: list[str], out: str = "distance") -> DataFrame:
    """Each row's distance from its class's mean."""
    c = df.groupBy(cls).agg(*[F.avg(f).alias(f"_c{i}") for i, f in enumerate(features)])
    d2 = reduce(Column.__add__, [(F.col(f) - F.col(f"_c{i}")) * (F.col(f) - F.col(f"_c{i}")) for i, f in enumerate(features)])
    return df.join(F.broadcast(c), cls).withColumn(out, F.sqrt(d2)).drop(*[f"_c{i}" for i in range(len(features))])  # a row a class


def lloyd(x: np.ndarray, k: int, seed: int, starts: int = 10, steps: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """Labels and centroids of the best of several k-means++ starts."""
    best, rng = None, np.random.default_rng(seed)
    for _ in range(starts):
        c = x[[rng.integers(len(x))]]
        while len(c) < k:
            d = ((x[:, None] - c) ** 2).sum(2).min(1)
            c = np.vstack([c, x[rng.choice(len(x), p=d / d.sum()) if d.sum() > 0 else rng.integers(len(x))]])
        for _ in range(steps):
            label = ((x[:, None] - c) ** 2).sum(2).argmin(1)
            new = np.array([x[label == i].mean(0) if (label == i).any() else c[i] for i in range(k)])
            if np.allclose(new, c):
                break
            c = new
        d = ((x[:, None] - c) ** 2).sum(2)
        if best is None or d.min(1).sum() < best[0]:
            best = d.min(1).sum(), d.argmin(1), c
    return best[1], best[2]


def silhouette(x: np.ndarray, label: np.ndarray, block: int = 512) -> float:
    """Mean silhouette by Euclidean distance, of a block's rows against all others at a time."""
    ks, own = np.unique(label, return_inverse=True)
    if len(ks) < 2:
        return -1.0
    member, size = np.eye(len(ks))[own], np.bincount(own)
    square, total = (x * x).sum(1), 0.0
    for i in range(0, len(x), block):
        rows = np.arange(i, min(len(x), i + block))
        d = np.sqrt(np.maximum(square[rows, None] + square - 2 * x[rows] @ x.T, 0.0))
        d[np.arange(len(rows)), rows] = 0.0
        mean = d @ member / np.maximum(1, size - member[rows])
        a = mean[np.arange(len(rows)), own[rows]]
        mean[np.arange(len(rows)), own[rows]] = np.inf
        b = mean.min(1)
        total += float(np.where(size[own[rows]] == 1, 0.0, (b - a) / np.maximum(np.maximum(a, b), 1e-12)).sum())
    return total / len(x)


def kmeans_distance(df: DataFrame, cls: str, features: list[str], out: str = "distance", seed: int = 42, group: list[str] = ()) -> DataFrame:
    """M2: each row's distance from its cluster's centroid, clusters sought within its class (and group): k from 2 to
    min(5, n // 5) with the best silhouette; under 6 rows the class is one cluster. Classes are training samples, whose
    size the sampling quotas bound."""

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        x = pdf[features].to_numpy(float)
        best = (-2.0, np.zeros(len(x), int), x.mean(0, keepdims=True))
        if len(x) >= 6:
            for k in range(2, min(5, len(x) // 5) + 1):
                label, c = lloyd(x, k, seed)
                best = max(best, (silhouette(x, label), label, c), key=lambda t: t[0])
        return pdf.assign(**{out: np.sqrt(((x - best[2][best[1]]) ** 2).sum(1))})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{out}` double"
    return df.groupBy(*group, cls).applyInPandas(work, schema)


def train_forest(df: DataFrame, cls: str, features: list[str], trees: int = 500, depth: int = 20, seed: int = 42):
    """M4, M9: a random forest with classes weighted by n / (classes * n of the class); a PipelineModel whose assembler
    pins the features' order."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    n = df.groupBy(cls).agg(F.count(F.lit(1)).alias("_n"))
    of = n.agg(F.sum("_n").alias("s"), F.count(F.lit(1)).alias("k")).first()
    d = df.join(F.broadcast(n), cls).withColumn("_w", F.lit(float(of["s"])) / (F.lit(float(of["k"])) * F.col("_n"))).withColumn("_label", F.col(cls).cast("double"))
    forest = RandomForestClassifier(featuresCol="_features", labelCol="_label", weightCol="_w", numTrees=trees, maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_features", handleInvalid="skip"), forest]).fit(d)


def importances(spark, model) -> DataFrame:
    """M5: (feature, importance), the greatest first."""
    names, forest = model.stages[0].getInputCols(), model.stages[1]
    return spark.createDataFrame([(f, float(v)) for f, v in zip(names, forest.featureImportances.toArray(), strict=True)], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def predict(df: DataFrame, model, variables: list[str], threshold: float = 30.0, nodata: int = 255) -> DataFrame:
    """M6: df with classification, classification_unfiltered, classification_probability. A pixel is nodata if any of
    `variables`, the model's or not, is NaN. Raises if the model needs a feature that isn't there. Scoring is a narrow
    pass of one plan: no collect, no rejoin."""
    from pyspark.ml.functions import vector_to_array

    from ..functions.columns import confident_class, whole_percent

    need = model.stages[0].getInputCols()
    if gone := sorted(set(need) - set(df.columns)):
        raise ValueError(f"features that the model needs aren't there: {gone}")
    ok = reduce(Column.__and__, [F.col(v).isNotNull() & ~F.isnan(F.col(v).cast("double")) for v in dict.fromkeys([*variables, *need])])
    d = df.withColumn("_ok", ok)
    filled = d.select(*[c for c in d.columns if c not in need], *[F.when(F.col("_ok"), F.col(f).cast("double")).otherwise(F.lit(0.0)).alias(f) for f in need], F.struct(*[F.col(f) for f in need]).alias("_raw"))
    s = model.transform(filled).withColumn("_p", F.array_max(vector_to_array("probability")))
    s = s.withColumns({
        "classification_unfiltered": F.when(F.col("_ok"), F.col("prediction").cast("int")).otherwise(F.lit(nodata)),
        "classification_probability": F.when(F.col("_ok"), whole_percent("_p")).otherwise(F.lit(nodata)),
    })
    s = s.withColumn("classification", confident_class("classification_unfiltered", F.col("classification_probability"), threshold, nodata))
    kept = [F.col(f"_raw.{c}").alias(c) if c in need else F.col(c) for c in df.columns]
    return s.select(*kept, "classification", "classification_unfiltered", "classification_probability")


def classification_report(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """(class, precision, recall, f1, support) a class, with its rows from one confusion count; 0 for 0/0."""
    cell = df.groupBy(F.col(truth).alias("t"), F.col(guess).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    each = cell.select(F.inline(F.array(
        F.struct(F.col("t").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"), F.when(F.col("t") == F.col("g"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("hit")),
        F.struct(F.col("g").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"), F.lit(0).cast("long").alias("hit")),
    )))
    s = each.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hit")])
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))
    s = s.withColumns({"precision": share("hit", "called"), "recall": share("hit", "support")})
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return s.select("class", "precision", "recall", f1.alias("f1"), "support")


def report_averages(report: DataFrame) -> DataFrame:
    """Macro and weighted averages of a report."""
    m = [F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")]
    w = [(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")]
    return report.agg(*m, *w, F.sum("support").alias("support"))


def correlated_pairs(df: DataFrame, features: list[str], over: float = 0.95) -> DataFrame:
    """(a, b, correlation) of pairs of features, all in one pass, that are over the limit in size."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1 :]]
    d = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("correlation")) for a, b in pairs]
    return d.select(F.inline(F.array(*rows))).filter(F.abs("correlation") > over)
