"""Batching plans: chunks, rotations, lanes, windows, a sequential packer on bounded groups, and a reranker."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import graph


def chunks(df: DataFrame, key: str, size: int, solo: Column) -> DataFrame:
    """Adds ``chunk``: heavy rows alone, the others ``size`` at a time in order of key."""
    rn = F.row_number().over(Window.partitionBy("_solo").orderBy(key)) - 1
    df = df.withColumn("_solo", solo)
    return df.withColumn("chunk", F.when(F.col("_solo"), F.concat(F.lit("solo-"), F.col(key).cast("string"))).otherwise(F.concat(F.lit("chunk-"), F.floor(rn / size).cast("string")))).drop("_solo")


def rotation(df: DataFrame, position: str, day: int, size: int, total: int) -> DataFrame:
    """The ``size`` rows whose turn it is on a day, the window moving on by ``size`` and around."""
    return df.filter(F.pmod(F.col(position) - F.lit(day * size), F.lit(total)) < size)


def lanes(df: DataFrame, position: str, n: int) -> DataFrame:
    return df.withColumn("lane", F.pmod(F.col(position), F.lit(n)))


def day_splits(start: Column, end: Column, parts: int) -> Column:
    """``parts`` half-open windows that cover [start, end), as an array of structs."""
    a, b = F.unix_timestamp(start), F.unix_timestamp(end)
    edge = lambda i: F.timestamp_seconds(a + F.floor((b - a) * i / parts))
    return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(edge(i).alias("since"), edge(i + 1).alias("until")))


def filled(df: DataFrame, key: str, expected: str, budget: float, width: int, group: str) -> DataFrame:
    """Adds ``chunk``: rows of a group packed in order while they fit a budget and a width; one beyond the budget stands alone.

    Sequential by nature; a group is one plan's bounded list.
    """
    schema = df.schema.simpleString()[len("struct<"):-1] + ",chunk:int"
    columns = df.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([expected, key], ascending=[False, True]).reset_index(drop=True)
        out, chunk, used, n = [], -1, 0.0, 0
        for x in pdf[expected]:
            if chunk < 0 or n >= width or used + x > budget or used > budget:
                chunk, used, n = chunk + 1, 0.0, 0
            used, n = used + x, n + 1
            out.append(chunk)
        return pdf.assign(chunk=out)[[*columns, "chunk"]]

    return df.groupBy(group).applyInPandas(run, schema.replace(":", " "))


def diversified(df: DataFrame, pool: str, id_col: str, relevance: str, author: str, vector: str, k: int, balance: float = 0.7, cap: int = 2) -> DataFrame:
    """The ``k`` rows of each pool that a greedy trade of relevance against likeness picks, with rank and score.

    Each pick has the greatest ``balance * relevance - (1 - balance) * likeness
    to what is picked``; an author has at most ``cap`` rows.  An id is unique in
    its pool.  A round picks one row of every pool by a partial aggregation, so
    a pool may be of any size; what is kept between rounds is ``k`` rows a pool.
    """
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))
    rows = df.select(
        F.col(pool).alias("pool"), F.col(id_col).alias("id"), F.col(relevance).cast("double").alias("rel"), F.col(author).alias("who"),
        F.transform(F.col(vector).cast("array<double>"), lambda x: F.when(norm > 0, x / norm).otherwise(0.0)).alias("v"),
    )
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    # -score and -rel: the least struct is the best row, of equal ones that of least id.
    pick = lambda like: F.struct((F.lit(1 - balance) * like - F.lit(balance) * F.col("rel")).alias("s"), (-F.col("rel")).alias("r"), "id", "who", "v")
    picked = graph.written(rows.groupBy("pool").agg(F.array(F.min(pick(F.lit(0.0)))).alias("picks")))
    for n in range(1, k):
        before = picked
        # A pool that had no row to give in the last round has none now.
        open_ = picked.filter(F.size("picks") == n).withColumnRenamed("pool", "of")
        left = rows.join(open_, F.col("pool").eqNullSafe(F.col("of"))).drop("of")
        left = left.filter(~F.exists("picks", lambda p: p["id"] == F.col("id")) & (F.size(F.filter("picks", lambda p: p["who"].eqNullSafe(F.col("who")))) < cap))
        like = F.aggregate("picks", F.lit(0.0), lambda m, p: F.greatest(m, dot(F.col("v"), p["v"])))
        best = left.groupBy(F.col("pool").alias("of")).agg(F.min(pick(like)).alias("next"))
        picked = picked.join(best, F.col("pool").eqNullSafe(F.col("of")), "left")
        picked = picked.select("pool", F.when(F.col("next").isNotNull(), F.concat("picks", F.array("next"))).otherwise(F.col("picks")).alias("picks"))
        grown = graph.written(picked)
        graph.forget(before)
        picked = grown
    out = picked.select("pool", F.posexplode("picks").alias("at", "p"))
    return out.select(F.col("pool").alias(pool), F.col("p.id").alias(id_col), (F.col("at") + 1).alias("rank"), (-F.col("p.s")).alias("score"))
