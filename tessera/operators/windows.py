"""Rankings that depend on what stands before a row: distributions, slots, caps, runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def forced_distribution(df: DataFrame, score: str, order: list[Column], out: str = "final", key: str | None = None) -> DataFrame:
    """Only the first row keeps 100 or more (others get 99) and only the first two 90 or more (others get 89).

    With ``key``, which names a row, the first two are found by a limit and no
    task sees the whole order.
    """
    f = F.col(score)
    if key is None:
        df = df.withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
    else:
        first = df.orderBy(*order).limit(2).withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
        df = df.join(F.broadcast(first.select(F.col(key).alias("_key"), "_rn")), F.col(key) == F.col("_key"), "left").drop("_key")  # two rows
    rn = F.coalesce("_rn", F.lit(3))
    return df.withColumn(out, F.when((f >= 90) & (rn > 2), 89).when((f >= 100) & (rn > 1), 99).otherwise(f)).drop("_rn")


def gated_slots(
    df: DataFrame, score: str, order: list[Column], top_gate: float, also_gate: float, max_top: int, max_also: int,
    author: str | None = None, cap: Column | int | None = None, key: str | None = None,
) -> DataFrame:
    """Adds ``slot``: top, also or null, and with a cap how many rows of an author may be placed.

    Rows below ``also_gate`` drop; the first ``max_top`` at ``top_gate`` are top, the
    next ones also, up to ``max_also``.  Rows without an author aren't capped.
    With ``key``, which names a row, slots are found by limits and no task sees
    the whole order.
    """
    if also_gate > top_gate:
        raise ValueError("the gate of also must not lie above that of top")
    w = Window.orderBy(*order)
    df = df.withColumn("_fit", F.col(score) >= also_gate)
    if author is not None and cap is not None:
        rank = F.sum(F.col("_fit").cast("int")).over(Window.partitionBy(author).orderBy(*order))
        df = df.withColumn("_kept", F.col("_fit") & (F.col(author).isNull() | (rank <= cap)))
    else:
        df = df.withColumn("_kept", F.col("_fit"))
    running = lambda c: F.sum(c.cast("int")).over(w)
    high = F.col("_kept") & (F.col(score) >= top_gate)

    def first(rows: DataFrame, n: int, flag: str) -> DataFrame:
        return F.broadcast(rows.orderBy(*order).limit(n).select(F.col(key).alias("_key"), F.lit(True).alias(flag)))  # n rows

    def flagged(rows: DataFrame, found: DataFrame, flag: str) -> DataFrame:
        return rows.join(found, F.col(key) == F.col("_key"), "left").drop("_key").withColumn(flag, F.coalesce(flag, F.lit(False)))

    if key is None:
        df = df.withColumn("_top", high & (running(high) <= max_top))
        other = F.col("_kept") & ~F.col("_top")
        df = df.withColumn("_also", other & (running(other) <= max_also))
    else:
        df = flagged(df, first(df.filter(high), max_top, "_top"), "_top")
        df = flagged(df, first(df.filter(F.col("_kept") & ~F.col("_top")), max_also, "_also"), "_also")
    slot = F.when(F.col("_top"), "top").when(F.col("_also"), "also")
    reason = F.when(slot.isNotNull(), None).when(F.col("_fit") & ~F.col("_kept"), "author_cap").otherwise("below_gate_or_cap")
    return df.withColumn("slot", slot).withColumn("dropped", reason).drop("_fit", "_kept", "_top", "_also")


def winners(df: DataFrame, group: str, order: list[Column], url: str) -> DataFrame:
    """The rank of each row in its group, and the URL that it lost to."""
    w = Window.partitionBy(group).orderBy(*order)
    rn = F.row_number().over(w)
    return df.withColumn("rank", rn).withColumn("lost_to", F.when(F.col("rank") > 1, F.first(url).over(w)))


def known_run(df: DataFrame, known: Column, order: list[str], keys: list[str], least: int) -> DataFrame:
    """Adds ``run``, the length so far of the run of known rows, and ``stop`` on the first row where it reaches ``least``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_known", known).withColumn("_island", F.sum((~F.col("_known")).cast("int")).over(w))
    run = F.sum(F.col("_known").cast("int")).over(Window.partitionBy(*keys, "_island").orderBy(*order))
    df = df.withColumn("run", F.when(F.col("_known"), run).otherwise(0))
    hit = F.sum((F.col("run") >= least).cast("int")).over(w)
    return df.withColumn("stop", (F.col("run") >= least) & (hit == 1)).drop("_known", "_island")


def streak(df: DataFrame, bad: Column, good: Column, order: list[str], keys: list[str]) -> DataFrame:
    """Length so far of the streak of bad rows; a good one ends it, one that is neither carries it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    df = df.withColumn("_since", F.sum(good.cast("int")).over(w))
    return df.withColumn("streak", F.sum(bad.cast("int")).over(Window.partitionBy(*keys, "_since").orderBy(*order))).drop("_since")


def silent_days(df: DataFrame, value: str, order: str, keys: list[str], days: int) -> DataFrame:
    """Whether the last ``days`` rows up to each, all of them there, sum to zero."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(days - 1), 0)
    return df.withColumn("silent", (F.count("*").over(w) == days) & (F.sum(value).over(w) == 0))


def positional(df: DataFrame, order: list[Column], out: str = "position_score") -> DataFrame:
    """1 for the first row, falling evenly to 1/n for the last."""
    n = F.count("*").over(Window.partitionBy(F.lit(0)))
    return df.withColumn(out, 1 - (F.row_number().over(Window.orderBy(*order)) - 1) / F.greatest(n, F.lit(1)))
