"""Upserts, queues, retention and snapshots as pure table functions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F


def classify_upsert(new: DataFrame, old: DataFrame, key: str, priority: str, content: list[str]) -> DataFrame:
    """Adds ``action`` to each new row: created, skipped (a source of higher priority, or nothing changed) or updated."""
    o = old.select(F.col(key), F.col(priority).alias("_p"), *[F.col(c).alias(f"_{c}") for c in content], F.lit(True).alias("_there"))
    rows = new.join(o, key, "left")
    changed = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_{c}")) for c in content])
    same = F.col(priority) == F.col("_p")
    action = (
        F.when(F.col("_there").isNull(), "created")
        .when(F.col("_p") > F.col(priority), "skipped")
        .when(same & ~changed, "skipped")
        .otherwise("updated")
    )
    return rows.withColumn("action", action).select(*new.columns, "action")


def upsert(old: DataFrame, new: DataFrame, key: str, priority: str, content: list[str]) -> DataFrame:
    """The table after the upsert."""
    wins = classify_upsert(new, old, key, priority, content).filter("action != 'skipped'").drop("action")
    return old.join(wins.select(key), key, "left_anti").unionByName(wins.select(*old.columns))


def preferred(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row for each key, the first in order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_rn = 1").drop("_rn")


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key: compaction of a log."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def inserted_if_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return old.unionByName(new.join(old.select(key), key, "left_anti").select(*old.columns))


def replaced_children(children: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All children of the parents in ``new`` replaced."""
    return children.join(new.select(key).distinct(), key, "left_anti").unionByName(new.select(*children.columns))


def kept_days(df: DataFrame, day: str, today: str, ttl: int) -> DataFrame:
    """The last ``ttl`` days: a row goes once its day is ``today - ttl`` or before."""
    return df.filter(F.col(day) > F.date_sub(F.lit(today).cast("date"), ttl))


def kept_since(df: DataFrame, day: str, cutoff: str) -> DataFrame:
    """Rows from the cutoff on; those whose day can't be read stay."""
    return df.filter(F.col(day).isNull() | (F.col(day) >= F.lit(cutoff).cast("date")))


def snapshots(df: DataFrame, day: str, keep: int = 8) -> DataFrame:
    """The rows of the last ``keep`` days that there are."""
    days = df.select(day).distinct().orderBy(F.desc(day)).limit(keep)
    return df.join(F.broadcast(days), day, "left_semi")  # ``keep`` rows


def reclaimed(queue: DataFrame, status: str, leased: str, cutoff: Column) -> DataFrame:
    """Leases older than the cutoff are pending again."""
    stale = (F.col(status) == "leasing") & (F.col(leased) < cutoff)
    return queue.withColumn(status, F.when(stale, "pending").otherwise(F.col(status))).withColumn(leased, F.when(~stale, F.col(leased)))


def claimed(queue: DataFrame, id_col: str, status: str, n: int, owner: str) -> DataFrame:
    """The first ``n`` pending rows are leased to ``owner``."""
    ids = queue.filter(F.col(status) == "pending").orderBy(id_col).limit(n).select(id_col, F.lit(True).alias("_mine"))
    rows = queue.join(F.broadcast(ids), id_col, "left")  # n rows
    mine = F.coalesce("_mine", F.lit(False))
    return rows.withColumn("owner", F.when(mine, F.lit(owner))).withColumn(status, F.when(mine, "leasing").otherwise(F.col(status))).drop("_mine")


def released(queue: DataFrame, status: str, attempts: str, error: str, terminal: str, most: int) -> DataFrame:
    """Outcome of leased rows: done, pending again after a passing error, or failed for good."""
    failed = F.col(error).isNotNull()
    final = failed & (F.regexp_like(F.col(error), F.lit(terminal)) | (F.col(attempts) + 1 >= most))
    after = F.when(~failed, "done").when(final, "error").otherwise("pending")
    leased = F.col(status) == "leasing"
    tried = F.when(leased & failed, F.col(attempts) + 1).otherwise(F.col(attempts))
    return queue.withColumns({status: F.when(leased, after).otherwise(F.col(status)), attempts: tried})


def enqueue_decision(items: DataFrame, queue: DataFrame, key: str, has_result: Column, most: int) -> DataFrame:
    """Whether an item is enqueued, or why it isn't."""
    q = queue.select(key, F.col("status").alias("_s"), F.col("attempts").alias("_a"))
    decision = (
        F.when(has_result, "has_result")
        .when(F.col("_s").isin("pending", "leasing", "done"), F.col("_s"))
        .when((F.col("_s") == "error") & (F.col("_a") >= most), "gave_up")
        .otherwise("enqueue")
    )
    return items.join(q, key, "left").withColumn("decision", decision).drop("_s", "_a")
