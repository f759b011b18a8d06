"""Symmetric int8 quantization of parameter tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradmill.functions.arrays import let


def _output_rows(shape: Column) -> Column:
    """Blocks that get a scale of their own: output rows, or a bias as a whole."""
    return (
        F.when(F.size(shape) == 1, 1)
        .when(F.size(shape) == 5, F.get(shape, F.lit(0)) * F.get(shape, F.lit(1)))
        .otherwise(F.get(shape, F.lit(0)))
    )


def quantize(params: DataFrame) -> DataFrame:
    """``(layer, param, shape, scales, q)`` with ``scale = max|w| / 127`` per output row.

    ``q`` rounds half away from zero; a row of zeros has scale 0 and stays zero.
    """
    rows = _output_rows(F.col("shape"))
    width = (F.size("values") / rows).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), rows - 1), lambda r: F.slice("values", r * width + 1, width)
    )

    def as_bytes(block: Column) -> Column:
        scale = F.array_max(F.transform(block, lambda w: F.abs(w))) / 127
        return let(
            scale,
            lambda s: F.struct(
                s.alias("scale"),
                F.transform(
                    block, lambda w: F.when(s == 0, 0).otherwise(F.round(w / s)).cast("tinyint")
                ).alias("q"),
            ),
        )

    both = F.transform(blocks, lambda b: let(b, as_bytes))
    done = params.select("layer", "param", "shape", both.alias("_b"))
    return done.select(
        "layer", "param", "shape", F.col("_b.scale").alias("scales"), F.flatten("_b.q").alias("q")
    )


def dequantize(quantized: DataFrame) -> DataFrame:
    """A parameter table of ``q * scale``."""
    width = F.size("q") / F.size("scales")

    def scaled(q: Column, scales: Column, n: Column) -> Column:
        return F.transform(q, lambda v, i: v * F.get(scales, F.floor(i / n).cast("int")))

    values = let(
        F.struct(F.col("q").alias("q"), F.col("scales").alias("scales"), width.alias("n")),
        lambda t: scaled(t["q"], t["scales"], t["n"]),
    )
    return quantized.select("layer", "param", "shape", values.alias("values"))


def size_report(params: DataFrame, quantized: DataFrame) -> DataFrame:
    """``(float_bytes, int8_bytes, saved_bytes)``: 4 per float and scale, 1 per int8."""
    zero = F.lit(0)
    full = params.select((4 * F.size("values")).alias("f"), zero.alias("q"))
    small = quantized.select(zero.alias("f"), (F.size("q") + 4 * F.size("scales")).alias("q"))
    sums = full.unionAll(small).agg(
        F.sum("f").alias("float_bytes"), F.sum("q").alias("int8_bytes")
    )
    return sums.withColumn("saved_bytes", F.col("float_bytes") - F.col("int8_bytes"))


def agreement(scored: DataFrame, a: str, b: str) -> DataFrame:
    """Share of rows on which two prediction columns agree."""
    return scored.agg(F.avg((F.col(a) == F.col(b)).cast("double")).alias("agreement"))
