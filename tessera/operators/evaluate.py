"""Ranking quality: precision, nDCG, AUC, ROC, sweeps and parity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import ranges


def precision_at(df: DataFrame, positive: Column, order: list[Column], k: int) -> DataFrame:
    """Share of positives among the first ``k`` rows, or among all where there are fewer."""
    top = df.withColumn("_y", positive).orderBy(*order).limit(k)
    return top.agg(F.avg(F.col("_y").cast("double")).alias("precision"))


def ndcg_at(df: DataFrame, positive: Column, order: list[Column], k: int, least: int = 5) -> DataFrame:
    """Binary nDCG; null with fewer than ``least`` positives.  Only the first ``k`` rows are ranked."""
    rows = df.withColumn("_y", positive.cast("int"))
    count = rows.agg(F.sum("_y").alias("p"))
    top = rows.orderBy(*order).limit(k).withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
    gain = top.agg(F.sum(F.col("_y") / F.log2(F.col("_rn") + 1)).alias("dcg"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(F.col("p"), F.lit(k)), F.lit(1)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1.0))
    return gain.crossJoin(count).select(F.when(F.col("p") >= least, F.col("dcg") / ideal).alias("ndcg"))  # one row each


def auc(df: DataFrame, positive: Column, score: Column) -> DataFrame:
    """Probability that a positive scores above a negative, ties half: from counts by distinct score, no pairs."""
    rows = df.select(positive.cast("int").alias("y"), score.cast("double").alias("s")).filter("s is not null and y is not null")
    per = rows.groupBy("s").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    per = ranges.running(per, [F.asc("s")], {"below": F.col("n")})
    wins = per.withColumn("w", F.col("p") * (F.col("below") + F.col("n") / 2))
    return wins.agg((F.sum("w") / (F.sum("p") * F.sum("n"))).alias("auc"))


def roc(df: DataFrame, positive: Column, score: Column) -> DataFrame:
    """(threshold, tpr, fpr) at each distinct score, from the highest; the point at infinity is (0, 0)."""
    rows = df.select(positive.cast("int").alias("y"), score.cast("double").alias("threshold")).filter("threshold is not null and y is not null")
    per = rows.groupBy("threshold").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
    per = ranges.running(per, [F.desc("threshold")], {"p_above": F.col("p"), "n_above": F.col("n")})
    total = F.broadcast(per.agg(F.sum("p").alias("p_all"), F.sum("n").alias("n_all")))  # one row
    tpr, fpr = (F.col("p_above") + F.col("p")) / F.col("p_all"), (F.col("n_above") + F.col("n")) / F.col("n_all")
    return per.crossJoin(total).select("threshold", tpr.alias("tpr"), fpr.alias("fpr"))


def label_counts(df: DataFrame, label: str, positive: list[str], negative: list[str], forbidden: list[str] = ()) -> DataFrame:
    """Rows by class; a forbidden label is an error, any other counts as unlabelled."""
    c = F.col(label)
    kind = (
        F.when(c.isin(list(forbidden)), F.raise_error(F.concat(F.lit("forbidden label "), c)).cast("string"))
        .when(c.isin(positive), "positive").when(c.isin(negative), "negative").otherwise("unlabelled")
    )
    return df.groupBy(kind.alias("class")).agg(F.count("*").alias("n"))


def sweep(df: DataFrame, score: str, positive: Column, gates: list[float]) -> DataFrame:
    """Rows, positives and precision at each gate, in one pass."""
    g = F.explode(F.array(*[F.lit(float(x)) for x in gates]))
    rows = df.select(F.col(score).alias("s"), positive.alias("y"), g.alias("gate")).filter("s >= gate")
    return rows.groupBy("gate").agg(F.count("*").alias("n"), F.count_if("y").alias("positives"), F.avg(F.col("y").cast("double")).alias("precision"))


def flips(df: DataFrame, value: str, baselines: list[float]) -> DataFrame:
    """For each baseline how many values turn from below zero to zero or above, once shifted by it."""
    b = F.explode(F.array(*[F.lit(float(x)) for x in baselines]))
    rows = df.select(F.col(value).alias("v"), b.alias("baseline"))
    return rows.groupBy("baseline").agg(F.count_if((F.col("v") < 0) & (F.col("v") + F.col("baseline") >= 0)).alias("flips"))


def parity(a: DataFrame, b: DataFrame, key: str, at: str) -> DataFrame:
    """Whether two selections hold the same keys, and at the same places."""
    both = a.select(F.col(key).alias("k"), F.col(at).alias("x")).join(b.select(F.col(key).alias("k"), F.col(at).alias("y")), "k", "full")
    return both.agg(
        F.bool_and(F.col("x").isNotNull() & F.col("y").isNotNull()).alias("same_set"),
        F.bool_and(F.col("x").eqNullSafe(F.col("y"))).alias("identical"),
    )


def near_pairs(a: DataFrame, b: DataFrame, key: str, score_a: str, score_b: str, margin: float = 0.05, least: float = 0.35) -> DataFrame:
    """Whether each adversarial row's score comes within ``margin`` of its partner's and reaches ``least``."""
    rows = a.join(b, key)
    return rows.withColumn("near", ((F.col(score_a) - F.col(score_b)) <= margin) & (F.col(score_a) >= least))


def gate_pairs(df: DataFrame, score: str, good: Column, tops: list[float], alsos: list[float]) -> DataFrame:
    """For every pair of gates the rows at the top one, between the two, and the good ones at the top.  One pass."""
    pairs = F.explode(F.array(*[F.struct(F.lit(float(t)).alias("top"), F.lit(float(a)).alias("also")) for t in tops for a in alsos]))
    rows = df.select(F.col(score).alias("_s"), good.alias("_good"), pairs.alias("_g")).select("_s", "_good", "_g.*")
    at_top = F.col("_s") >= F.col("top")
    return rows.groupBy("top", "also").agg(
        F.count_if(at_top).alias("n_top"), F.count_if((F.col("_s") >= F.col("also")) & ~at_top).alias("n_also"), F.count_if(at_top & F.col("_good")).alias("good_top")
    )


def roc_curve(df: DataFrame, positive: Column, score: Column) -> DataFrame:
    """The points of :func:`roc` between the ends that no and every threshold stand for."""
    points = roc(df, positive, score)
    ends = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0), (float("-inf"), 1.0, 1.0)], "threshold double, tpr double, fpr double")
    return points.select("threshold", "tpr", "fpr").unionByName(ends)
