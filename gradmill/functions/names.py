"""Time-stamped run and model names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


# The time formats of run names and of model file names, for Spark and for Python.
RUN_TIME = "yyyyMMdd-HHmmss"
RUN_TIME_NOW = "%Y%m%d-%H%M%S"
MODEL_TIME = "%Y-%m-%d-%H-%M-%S"


def run_name(app: Column, ts: Column) -> Column:
    """``app-yyyyMMdd-HHmmss`` from a timestamp column."""
    return F.concat(app, F.lit("-"), F.date_format(ts, RUN_TIME))


def run_name_now(app: str, now: datetime | None = None) -> str:
    """The same name for a job started now."""
    return f"{app}-{(now or datetime.now()):{RUN_TIME_NOW}}"


def model_file_name(name: str, now: datetime | None = None) -> str:
    """``name-yyyy-MM-dd-HH-mm-ss`` for a saved model."""
    return f"{name}-{(now or datetime.now()):{MODEL_TIME}}"
