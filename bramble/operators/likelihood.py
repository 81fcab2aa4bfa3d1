"""Objectives and likelihoods of given models as aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def margin(columns: Sequence[str], coefficients: Sequence[float], intercept: float) -> Column:
    total = F.lit(float(intercept))
    for name, weight in zip(columns, coefficients, strict=True):
        total = total + F.col(name) * float(weight)
    return total


def squared_objective(df: DataFrame, columns: Sequence[str], coefficients: Sequence[float], intercept: float, *,
                      label: str = "label") -> DataFrame:
    """One row: ``n, objective``, half the mean squared error of a linear model."""
    gap = F.col(label) - margin(columns, coefficients, intercept)
    return df.agg(F.count("*").alias("n"), (F.avg(gap * gap) / 2).alias("objective"))


def logistic_objective(df: DataFrame, columns: Sequence[str], coefficients: Sequence[float], intercept: float, *,
                       label: str = "label") -> DataFrame:
    """One row: ``n, objective``, the mean negative log-likelihood of 0/1 labels."""
    signed = margin(columns, coefficients, intercept) * (1 - 2 * F.col(label))
    # log(1 + e^x) without overflow
    loss = F.greatest(signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))
    return df.agg(F.count("*").alias("n"), F.avg(loss).alias("objective"))


def survival_likelihood(df: DataFrame, columns: Sequence[str], coefficients: Sequence[float], intercept: float,
                        scale: float, *, label: str = "label", censor: str = "censor") -> DataFrame:
    """One row: ``n, log_likelihood`` of a Weibull model of accelerated failure time.

    ``censor`` is 1 where the event was seen and 0 where it lies beyond the label.
    """
    gap = (F.log(label) - margin(columns, coefficients, intercept)) / float(scale)
    each = F.col(censor) * (gap - F.log(F.lit(float(scale)))) - F.exp(gap)
    return df.agg(F.count("*").alias("n"), F.sum(each).alias("log_likelihood"))


def survival_quantiles(columns: Sequence[str], coefficients: Sequence[float], intercept: float, scale: float,
                       shares: Sequence[float]) -> list[Column]:
    """The times by which each share of rows like this one has had the event."""
    centre = margin(columns, coefficients, intercept)
    return [F.exp(centre + float(scale) * F.log(-F.log(F.lit(1.0 - float(s))))) for s in shares]
