"""Training and scoring as commands.

    python -m bramble.learners.command train <learner> <input.csv> <model> [--no-tuning] [options]
    python -m bramble.learners.command score <input.csv> <output> <model>

Each learner's default grid is searched by cross-validation unless ``--no-tuning`` is given.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from bramble.learners import jobs
from bramble.learners.registry import GRIDS
from bramble.session import build_session

KINDS = {"logistic": "classification", "svm": "classification", "decision_tree": "classification", "knn": "classification",
         "random_forest": "classification", "kmeans": "clustering"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="bramble.learners.command")
    modes = top.add_subparsers(dest="mode", required=True)
    train = modes.add_parser("train")
    train.add_argument("learner", choices=sorted(KINDS))
    train.add_argument("input")
    train.add_argument("model")
    train.add_argument("--label", help="default: the last column")
    train.add_argument("--key", help="column that identifies a row; the split follows its hash")
    train.add_argument("--no-tuning", action="store_true")
    train.add_argument("--folds", type=int, default=3)
    train.add_argument("--param", action="append", default=[], metavar="NAME=JSON", help="fixed parameter of the learner")
    score = modes.add_parser("score")
    for name in ("input", "output", "model"):
        score.add_argument(name)
    score.add_argument("--single-file", action="store_true")
    return top


def run(arguments: Sequence[str], spark: SparkSession | None = None) -> jobs.TrainReport | None:
    """Carry out one command; a report of the measure is printed after training."""
    given = parser().parse_args(list(arguments))
    spark = spark or build_session("bramble")
    if given.mode == "score":
        jobs.score_job(spark, given.input, given.output, given.model, single_file=given.single_file)
        return None
    params = {name: json.loads(value) for name, value in (p.split("=", 1) for p in given.param)}
    settings = {} if given.no_tuning else {n: v for n, v in GRIDS[given.learner].items() if n not in params}
    report = jobs.train_job(spark, given.input, given.model, kind=KINDS[given.learner], learner=given.learner,
                            label=given.label, key=given.key, settings=settings, params=params, folds=given.folds)
    print(json.dumps({"metric": report.metric, "value": report.value, "settings": len(report.grid_values)}))
    return report


if __name__ == "__main__":
    run(sys.argv[1:])
