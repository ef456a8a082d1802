"""Places in a total order without one task that sorts everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import materialize


def global_rank(df: DataFrame, order: list[Column], name: str = "place") -> DataFrame:
    """The rows with their place, from 0, in the order: ranges of it are numbered side by side
    and shifted by the rows of the ranges before. The order should be total."""
    ranged = materialize(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    up = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select("__range", F.coalesce(F.sum("__n").over(up), F.lit(0)).alias("__before"))
    here = Window.partitionBy("__range").orderBy(*order)
    return ranged.withColumn("__at", F.row_number().over(here) - 1).join(before, "__range").withColumn(name, F.col("__before") + F.col("__at")).drop("__range", "__at", "__before")


def quantiles(df: DataFrame, column: str, shares: dict[str, float], between: bool = False) -> DataFrame:
    """One row: for each name the least value that its share of the rows reach, or with ``between``
    the value at that share of the way, interpolated. Nulls take no part; nothing but the rows at
    the places asked for meets in one task."""
    rows = df.select(F.col(column).alias("v")).filter("v is not null")
    placed = global_rank(rows, [F.asc("v")])
    n = F.lit(placed.count())
    out = []
    for name, q in shares.items():
        at = (n - 1) * q if between else F.greatest(F.ceil(F.round(n * q, 9)) - 1, F.lit(0))
        low, high = F.floor(at), F.ceil(at)
        a, b = F.max(F.when(F.col("place") == low, F.col("v"))), F.max(F.when(F.col("place") == high, F.col("v")))
        out.append((a + (b - a) * (at - low) if between else a).alias(name))
    return placed.agg(*out)
