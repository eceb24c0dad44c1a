"""What changed between two days' rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def fingerprint(df: DataFrame, volatile: list[str]) -> Column:
    """A hash of all columns but the volatile ones, in order of name."""
    return F.sha2(F.to_json(F.struct(*sorted(c for c in df.columns if c not in volatile))), 256)


def brief_delta(today: DataFrame, yesterday: DataFrame, group: str, url: str, rank: str, mark: str) -> DataFrame:
    """(group, url, status): new, moved, unchanged or resolved.

    Inside a group rows pair by equal URL first, the rest in order of rank.  A
    pair is unchanged where rank and fingerprint ``mark`` are the same.
    """
    t = today.select(F.col(group).alias("g"), F.col(url).alias("u"), F.col(rank).alias("r"), F.col(mark).alias("m"))
    y = yesterday.select(F.col(group).alias("g"), F.col(url).alias("yu"), F.col(rank).alias("yr"), F.col(mark).alias("ym"))
    exact = t.join(y, (t["g"] == y["g"]) & (t["u"] == y["yu"])).select(t["g"], "u", "r", "m", "yr", "ym")
    rest_t = t.join(exact.select("g", "u"), ["g", "u"], "left_anti")
    rest_y = y.join(exact.select("g", F.col("u").alias("yu")), ["g", "yu"], "left_anti")
    number = lambda c: F.row_number().over(Window.partitionBy("g").orderBy(c))
    paired = rest_t.withColumn("n", number("r")).join(rest_y.withColumn("n", number("yr")), ["g", "n"], "full")
    both = paired.select("g", F.coalesce("u", "yu").alias("u"), "r", "m", "yr", "ym").unionByName(exact)
    status = (
        F.when(F.col("yr").isNull(), "new").when(F.col("r").isNull(), "resolved")
        .when((F.col("r") == F.col("yr")) & F.col("m").eqNullSafe(F.col("ym")), "unchanged").otherwise("moved")
    )
    return both.select(F.col("g").alias("event"), F.col("u").alias("url"), status.alias("status"))
