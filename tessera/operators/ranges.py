"""Sums and numbers over a whole order, without a task that sees all of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .graph import written


def running(df: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """Adds, under each name, the sum of the value over all rows before this one in the order; 0 for the first.

    Rows are dealt to ranges of the order and summed inside them; what lies before
    a range comes from one row a range.  Rows that the order ties share a range,
    so it should tell rows apart.  A null value counts as 0.
    """
    df = df.withColumns({f"_v_{name}": F.coalesce(value, F.lit(0)) for name, value in values.items()})
    # Written, since a second sampling of the order could cut other ranges.
    dealt = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    per = dealt.groupBy("_range").agg(*[F.sum(f"_v_{name}").alias(name) for name in values])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = per.select("_range", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_s_{name}") for name in values])
    before = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumns({f"_b_{name}": F.coalesce(F.sum(f"_v_{name}").over(before), F.lit(0)) for name in values})
    rows = rows.join(F.broadcast(starts), "_range")
    kept = [c for c in df.columns if not c.startswith("_v_")]
    return rows.select(*kept, *[(F.col(f"_s_{name}") + F.col(f"_b_{name}")).alias(name) for name in values])


def numbered(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """Adds the place, from 0, of each row in the order."""
    return running(df, order, {out: F.lit(1).cast("long")})
