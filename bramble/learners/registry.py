"""Learners by name with their default tuning grids."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml import classification as mc
from pyspark.ml import clustering as mk
from pyspark.ml import recommendation as mr
from pyspark.ml import regression as mg
from pyspark.ml.tuning import ParamGridBuilder

from bramble.learners.knn import KNNClassifier, KNNRegression

CLASSIFIERS: dict[str, Callable[..., Estimator]] = {
    "logistic": mc.LogisticRegression,
    "svm": mc.LinearSVC,
    "decision_tree": mc.DecisionTreeClassifier,
    "random_forest": mc.RandomForestClassifier,
    "gbt": mc.GBTClassifier,
    "naive_bayes": mc.NaiveBayes,
    "perceptron": mc.MultilayerPerceptronClassifier,
    "one_vs_rest": mc.OneVsRest,
    "knn": KNNClassifier,
}
REGRESSORS: dict[str, Callable[..., Estimator]] = {
    "linear": mg.LinearRegression,
    "glm": mg.GeneralizedLinearRegression,
    "decision_tree": mg.DecisionTreeRegressor,
    "random_forest": mg.RandomForestRegressor,
    "gbt": mg.GBTRegressor,
    "isotonic": mg.IsotonicRegression,
    "aft_survival": mg.AFTSurvivalRegression,
    "knn": KNNRegression,
}
CLUSTERERS: dict[str, Callable[..., Any]] = {
    "kmeans": mk.KMeans,
    "bisecting_kmeans": mk.BisectingKMeans,
    "gaussian_mixture": mk.GaussianMixture,
    "lda": mk.LDA,
    "power_iteration": mk.PowerIterationClustering,
}
RECOMMENDERS: dict[str, Callable[..., Estimator]] = {"als": mr.ALS}

_KINDS = {"classification": CLASSIFIERS, "regression": REGRESSORS, "clustering": CLUSTERERS,
          "recommendation": RECOMMENDERS}

# small default grids for the training jobs; pass other settings to search more
GRIDS: dict[str, dict[str, Sequence[Any]]] = {
    "decision_tree": {"maxDepth": (4, 5, 6, 7, 8), "maxBins": (16, 32, 48, 64)},
    "logistic": {"regParam": (0.01, 0.1, 0.3), "elasticNetParam": (0.0, 0.5, 1.0)},
    "svm": {"regParam": (0.01, 0.1, 0.3), "maxIter": (50, 100)},
    "kmeans": {"k": (2, 3, 4), "maxIter": (20, 40)},
    "knn": {"k": (3, 5, 7)},
    "random_forest": {"numTrees": (10, 20), "maxDepth": (4, 6)},
}


def learner(kind: str, name: str, **params: Any):
    """A learner of one kind with the given parameters."""
    try:
        make = _KINDS[kind][name]
    except KeyError:
        raise ValueError(f"no {kind} learner named {name}") from None
    return make(**params)


def grid(estimator: Estimator, settings: Mapping[str, Sequence[Any]]):
    """Cartesian product of parameter values as a list of parameter maps."""
    builder = ParamGridBuilder()
    for name, values in settings.items():
        builder = builder.addGrid(estimator.getParam(name), list(values))
    return builder.build()
