"""Pooled least squares on two features, fitted from one aggregate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Features count as collinear when their squared correlation is within this of one.
COLLINEAR = 1e-12


def scaled(column: Column, log_scale: bool) -> Column:
    return F.log1p(column) if log_scale else column


def least_squares(
    train: DataFrame, lag: str, rolling: str, target: str, log_scale: bool = False
) -> DataFrame:
    """One row: intercept, coef_lag, coef_rolling, train_rows for target ~ 1 + lag + rolling.

    Variances and covariances combine before the shuffle, so the fit is one aggregate of any size.
    Collinear features get the solution of least norm.
    """
    a, b, y = (scaled(F.col(c), log_scale) for c in (lag, rolling, target))
    moments = train.select(a.alias("a"), b.alias("b"), y.alias("y")).agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.avg("a").alias("ma"),
        F.avg("b").alias("mb"),
        F.avg("y").alias("my"),
        F.var_pop("a").alias("aa"),
        F.var_pop("b").alias("bb"),
        F.covar_pop("a", "b").alias("ab"),
        F.covar_pop("a", "y").alias("ay"),
        F.covar_pop("b", "y").alias("by"),
    )
    return solved(moments)


def solved(moments: DataFrame) -> DataFrame:
    """The fit of `least_squares` from train_rows, means (ma, mb, my), variances and covariances."""
    aa, bb, ab, ay, by = (F.col(c) for c in ("aa", "bb", "ab", "ay", "by"))
    det = aa * bb - ab * ab
    trace = aa + bb
    regular = det > COLLINEAR * aa * bb

    def solve(full: Column, least_norm: Column) -> Column:
        # With rank one the pseudo-inverse of the covariance matrix is the matrix over its squared trace.
        return F.when(regular, F.try_divide(full, det)).otherwise(
            F.coalesce(F.try_divide(least_norm, trace * trace), F.lit(0.0))
        )

    fitted = moments.withColumns(
        {
            "coef_lag": solve(ay * bb - by * ab, aa * ay + ab * by),
            "coef_rolling": solve(by * aa - ay * ab, ab * ay + bb * by),
        }
    )
    intercept = F.col("my") - F.col("coef_lag") * F.col("ma") - F.col("coef_rolling") * F.col("mb")
    return fitted.select(intercept.alias("intercept"), "coef_lag", "coef_rolling", "train_rows")


@dataclass(frozen=True)
class LinearModel:
    """A fitted model; predicting with it is a column expression."""

    intercept: float
    coef_lag: float
    coef_rolling: float
    log_scale: bool = False

    def predict(self, lag: Column, rolling: Column) -> Column:
        line = (
            F.lit(self.intercept)
            + F.lit(self.coef_lag) * scaled(lag, self.log_scale)
            + F.lit(self.coef_rolling) * scaled(rolling, self.log_scale)
        )
        return F.expm1(line) if self.log_scale else line


def error_metrics(scored: DataFrame, target: str, prediction: str) -> DataFrame:
    """One row: mae, rmse, test_rows in the units of the target."""
    error = F.col(target) - F.col(prediction)
    return scored.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.count(F.lit(1)).alias("test_rows"),
    )
