"""Structured Streaming: windows, deduplication, upserts, streaks and leases."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import scalars
from ..operators import dml


def timed(df: DataFrame, ts: str) -> DataFrame:
    """Event times as instants, which watermarks need; files hold them without a zone."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def tumbling(df: DataFrame, ts: str, width: str, late: str, keys: list[str], *aggregates: Column) -> DataFrame:
    return timed(df, ts).withWatermark(ts, late).groupBy(F.window(ts, width), *keys).agg(*aggregates)


def sliding(df: DataFrame, ts: str, width: str, slide: str, late: str, keys: list[str], *aggregates: Column) -> DataFrame:
    return timed(df, ts).withWatermark(ts, late).groupBy(F.window(ts, width, slide), *keys).agg(*aggregates)


def sessions(df: DataFrame, ts: str, gap: str, late: str, keys: list[str], *aggregates: Column) -> DataFrame:
    return timed(df, ts).withWatermark(ts, late).groupBy(F.session_window(ts, gap), *keys).agg(*aggregates)


def first_seen(df: DataFrame, ts: str, late: str, keys: list[str]) -> DataFrame:
    """Each key once while the watermark remembers it."""
    return timed(df, ts).withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def first_seen_in_day(df: DataFrame, ts: str, late: str, keys: list[str]) -> DataFrame:
    """Each key once a day of Los Angeles."""
    return first_seen(timed(df, ts).withColumn("pt_day", scalars.pt_day(F.col(ts))), ts, late, ["pt_day", *keys])


def streaks(df: DataFrame, key: str, ts: str, bad: str, good: str, least: int) -> DataFrame:
    """(key, streak, alert): a key's streak of bad rows after each batch; a good row ends it, others carry it."""

    def step(name: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(ts)
        for is_bad, is_good in zip(rows["_bad"], rows["_good"]):
            run = 0 if is_good else run + bool(is_bad)
        state.update((run,))
        yield pd.DataFrame({key: [name[0]], "streak": [run], "alert": [run >= least]})

    kind = df.schema[key].dataType.simpleString()
    marked = timed(df, ts).select(key, ts, F.expr(bad).alias("_bad"), F.expr(good).alias("_good"))
    return marked.groupBy(key).applyInPandasWithState(
        step, f"{key} {kind}, streak long, alert boolean", "run long", "update", GroupStateTimeout.NoTimeout
    )


def upsert_sink(path: str, key: str, priority: str, content: list[str]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: a table of versions, each batch's upsert the next one.

    A batch that is run again writes the same version again.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = dml.preferred(batch, key, [F.desc(priority), *[F.asc(c) for c in content]])
        old = spark.read.schema(batch.schema).parquet(f"{path}/v{number - 1}") if number else spark.createDataFrame([], batch.schema)
        dml.upsert(old, new, key, priority, content).write.mode("overwrite").parquet(f"{path}/v{number}")

    return write


def run_all(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all there is, into a table in memory: for tests and backfills of bounded size."""
    df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return df.sparkSession.table(name)


def read_files(spark: SparkSession, path: str, like: DataFrame, pattern: str = "*.parquet") -> DataFrame:
    return spark.readStream.schema(like.schema).option("pathGlobFilter", pattern).parquet(path)
