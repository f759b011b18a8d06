"""Training and validation logs as a table of scalars."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "run_id string, phase string, tag string, step bigint, value double, wall_time timestamp"
)
PARAM_SCHEMA = "run_id string, step bigint, layer string, param string, bucket int, n bigint"


class MetricsLog:
    """Append-only Parquet tables under ``folder``, partitioned by run."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.scalars = f"{folder.rstrip('/')}/scalars"
        self.parameters = f"{folder.rstrip('/')}/parameters"

    def append_table(self, metrics: DataFrame) -> None:
        """Append rows of :data:`SCHEMA` from any query."""
        metrics.write.mode("append").partitionBy("run_id").parquet(self.scalars)

    def append(
        self, run_id: str, phase: str, values: Iterable[tuple[str, int, float]]
    ) -> None:
        """Append ``(tag, step, value)`` scalars gathered by a driver loop."""
        now = datetime.now(timezone.utc)
        rows = [(run_id, phase, tag, step, float(v), now) for tag, step, v in values]
        if rows:
            self.append_table(self.spark.createDataFrame(rows, SCHEMA).coalesce(1))

    def append_histogram(self, run_id: str, step: int | Column, histogram: DataFrame) -> None:
        """Append the ``(layer, param, bucket, n)`` distribution of the parameters, at one step or by a column."""
        keyed = histogram.select(
            F.lit(run_id).alias("run_id"), F.lit(step).cast("bigint").alias("step"),
            "layer", "param", "bucket", "n",
        )
        keyed.coalesce(1).write.mode("append").partitionBy("run_id").parquet(self.parameters)

    def read_scalar(self, run_id: str, phase: str, tag: str) -> DataFrame:
        """``(step, value)`` of one series in step order; other runs are not opened."""
        table = self.spark.read.schema(SCHEMA).parquet(self.scalars)
        wanted = (F.col("run_id") == run_id) & (F.col("phase") == phase) & (F.col("tag") == tag)
        return table.where(wanted).select("step", "value").orderBy("step")

    def read_histograms(self, run_id: str) -> DataFrame:
        table = self.spark.read.schema(PARAM_SCHEMA).parquet(self.parameters)
        return table.where(F.col("run_id") == run_id)
