"""Validation measures over scored tables, and the criteria as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.functions import arrays


def nll(log_probs: Column, label1: Column) -> Column:
    """Class negative log-likelihood of one row, from log-probabilities."""
    return -F.element_at(log_probs, label1)


def cross_entropy(logits: Column, label1: Column) -> Column:
    """The same from unnormalized scores."""
    return nll(arrays.log_softmax(logits), label1)


def mse(output: Column, target: Column) -> Column:
    """Mean squared difference of two arrays."""
    squares = F.zip_with(output, target, lambda o, t: (o - t) * (o - t))
    return F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s) / F.size(output)


def criterion(name: str, output: Column, target: Column) -> Column:
    """The per-row value of a training criterion."""
    return {"nll": nll, "cross_entropy": cross_entropy, "mse": mse}[name](output, target)


def top1_accuracy(scored: DataFrame, scores: str = "scores", label1: str = "label1") -> DataFrame:
    """Share of rows whose best class is the true one."""
    hit = arrays.argmax(F.col(scores)) == F.col(label1) - 1
    return scored.agg(F.avg(hit.cast("double")).alias("top1"))


def mean_loss(
    scored: DataFrame, name: str = "nll", scores: str = "scores", target: str = "label1"
) -> DataFrame:
    """Mean criterion over all rows."""
    return scored.agg(F.avg(criterion(name, F.col(scores), F.col(target))).alias("loss"))
