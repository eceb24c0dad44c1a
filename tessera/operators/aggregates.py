"""Counts, buckets, histograms and funnels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import scalars
from . import ranges


def corpus_stats(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Total and conditional counts in one pass."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(t).alias(n) for n, t in tests.items()])


def counts_with_zero(parent: DataFrame, child: DataFrame, key: str, child_key: str, name: str, top: int | None = None) -> DataFrame:
    """Children of every parent, 0 for those without; the largest first if ``top`` is given."""
    n = child.groupBy(F.col(child_key).alias(key)).agg(F.count("*").alias("n"))
    out = parent.join(n, key, "left").select(name, F.coalesce("n", F.lit(0)).alias("n"))
    return out.orderBy(F.desc("n"), name).limit(top) if top else out


def weighted_buckets(df: DataFrame, key: str, weight: str, segment: str) -> DataFrame:
    """Weight, rows and leading segment (most weight, then first by name) of each key; weights to three places, half up."""
    per = df.groupBy(key, segment).agg(F.sum(weight).alias("w"), F.count("*").alias("n"))
    best = F.min(F.struct((-scalars.half_up(F.col("w"), 6)).alias("w"), F.col(segment).alias("s")))["s"]
    return per.groupBy(key).agg(scalars.half_up(F.sum("w")).alias("weight"), F.sum("n").alias("n"), best.alias("segment"))


def theme_histogram(df: DataFrame, themes: str, score: str, id_col: str, top: int = 8, examples: int = 3) -> DataFrame:
    """The most salient themes (rows, sum of scores) with examples; a row is an example of one theme at most, the first by name."""
    rows = df.select(F.col(id_col).alias("id"), F.col(score).alias("score"), F.explode(F.array_distinct(themes)).alias("theme"))
    best = rows.groupBy("theme").agg(F.count("*").alias("n"), F.sum("score").alias("salience"))
    best = best.orderBy(F.desc("n"), F.desc("salience"), "theme").limit(top)
    owned = rows.join(F.broadcast(best.select("theme")), "theme")  # ``top`` rows
    owned = owned.withColumn("_mine", F.row_number().over(Window.partitionBy("id").orderBy("theme"))).filter("_mine = 1")
    w = Window.partitionBy("theme").orderBy(F.desc("score"), "id")
    shown = owned.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= examples)
    shown = shown.groupBy("theme").agg(F.sort_array(F.collect_list(F.struct("_rn", "id"))).alias("x"))
    return best.join(shown, "theme", "left").select("theme", "n", "salience", F.coalesce(F.col("x.id"), F.array()).alias("examples"))


def loud(df: DataFrame, who: str, value: str, most: int = 8, least: int = 2) -> DataFrame:
    """The ``most`` authors of most rows, of those the ones with ``least`` or more: limit first, then filter."""
    per = df.groupBy(who).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return per.orderBy(F.desc("n"), F.desc("total"), who).limit(most).filter(F.col("n") >= least)


def mix(df: DataFrame, kind: str) -> DataFrame:
    """Rows of each kind, ``?`` for none."""
    return df.groupBy(F.coalesce(F.col(kind), F.lit("?")).alias("kind")).agg(F.count("*").alias("n"))


def funnel(df: DataFrame, reason: str) -> DataFrame:
    """Rows by reason, those of duplicate topics under one."""
    r = F.coalesce(F.col(reason), F.lit("kept"))
    return df.groupBy(F.when(r.startswith("topic_dup"), "topic_dup").otherwise(r).alias("reason")).agg(F.count("*").alias("n"))


def what_if(df: DataFrame, score: str, topic: str, gates: list[tuple[float, float]]) -> DataFrame:
    """For each (quick, top): rows and distinct topics at the top gate, rows between the two.  One pass."""
    g = F.explode(F.array(*[F.struct(F.lit(float(q)).alias("quick"), F.lit(float(t)).alias("top")) for q, t in gates]))
    rows = df.withColumn("_g", g).select("_g.quick", "_g.top", F.col(score).alias("s"), F.col(topic).alias("topic"))
    above = F.col("s") >= F.col("top")
    return rows.groupBy("quick", "top").agg(
        F.count_if(above).alias("n_top"), F.countDistinct(F.when(above, F.col("topic"))).alias("topics"),
        F.count_if((F.col("s") >= F.col("quick")) & ~above).alias("n_quick"),
    )


def silent_sources(df: DataFrame, source: str, score: str) -> DataFrame:
    return df.groupBy(source).agg(F.max(score).alias("best")).filter("best = 0").select(source)


def starving_topics(df: DataFrame, topic: str, score: str, gate: float, least: int = 5, share: float = 0.4) -> DataFrame:
    """The topic that takes ``share`` or more of the rows at the gate, if it has ``least`` rows or more."""
    per = df.filter(F.col(score) >= gate).groupBy(topic).agg(F.count("*").alias("n"))
    per = per.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))
    top = per.orderBy(F.desc("n"), topic).limit(1)
    return top.filter((F.col("n") >= least) & (F.col("share") >= share))


def repeated_values(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy(value).agg(F.count("*").alias("n")).filter("n > 1")


def truncated(df: DataFrame, who: str, cap: int) -> DataFrame:
    return df.groupBy(who).agg(F.count("*").alias("n")).withColumn("truncated", F.col("n") >= cap)


def tier_counts(df: DataFrame, who: str, value: str, floors: list[float], skip: Column) -> DataFrame:
    """Rows of each author at each floor, without those to skip."""
    rows = df.filter(~skip)
    per = rows.groupBy(who).agg(*[F.count_if(F.col(value) >= f).alias(f"t{i}") for i, f in enumerate(floors)])
    stack = F.explode(F.array(*[F.struct(F.lit(float(f)).alias("floor"), F.col(f"t{i}").alias("n")) for i, f in enumerate(floors)]))
    return per.select(who, stack.alias("_t")).select(who, "_t.floor", "_t.n")


def cost_floor(counts: DataFrame, who: str, cap: int, width: int) -> DataFrame:
    """Least calls for each floor: by rows and by authors."""
    per = counts.groupBy("floor").agg(F.sum("n").alias("rows"), F.countDistinct(who).alias("authors"))
    return per.withColumn("calls", F.greatest(F.ceil(F.col("rows") / cap), F.ceil(F.col("authors") / width)))


def quartiles(df: DataFrame, value: str) -> DataFrame:
    """Least, quartiles by linear interpolation, mean and greatest; null where there are no values.

    Distinct values are counted and the counts summed by ranges, so no task holds all values.
    """
    row = df.agg(F.min(value).alias("least"), F.avg(value).alias("mean"), F.max(value).alias("most"), F.count(value).alias("_n"))
    per = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    per = ranges.running(per, [F.asc("_v")], {"_at": F.col("_c")}).crossJoin(F.broadcast(row.select("_n")))  # one row
    picks, shares = [], {"p25": 0.25, "median": 0.5, "p75": 0.75}
    for name, share in shares.items():
        place = (F.col("_n") - 1) * F.lit(share)
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("_at") <= rank) & (rank < F.col("_at") + F.col("_c"))
            picks.append(F.max(F.when(here, F.col("_v"))).cast("double").alias(f"_{name}_{side}"))
    row = row.crossJoin(F.broadcast(per.agg(*picks)))  # one row
    cut = []
    for name, share in shares.items():
        place = (F.col("_n") - 1) * F.lit(share)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        cut.append((lo + (hi - lo) * (place - F.floor(place))).alias(name))
    return row.select("least", *cut, "mean", "most")


def histogram(df: DataFrame, value: str, width: float, buckets: int = 10) -> DataFrame:
    """Rows in each bucket; the last one takes all above."""
    return df.groupBy(F.least(F.floor(F.col(value) / width), F.lit(buckets - 1)).alias("bucket")).agg(F.count("*").alias("n"))


def spread(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, population deviation and range."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation"), (F.max(value) - F.min(value)).alias("span"))


def signs(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_if(F.col(value) > 0).alias("n_positive"), F.count_if(F.col(value) < 0).alias("n_negative"))


def probe(df: DataFrame, keys: list[str], known: Column, id_col: str, samples: int = 5) -> DataFrame:
    """Rows fetched, new and known, and the first ids that are new."""
    df = df.withColumn("_known", known)
    counts = df.groupBy(*keys).agg(F.count("*").alias("fetched"), F.count_if(~F.col("_known")).alias("net_new"), F.count_if("_known").alias("overlap"))
    # Each part of a key finds its own first ids, so a key with most rows isn't one task's.
    part = F.pmod(F.xxhash64(id_col), F.lit(64))
    fresh = df.filter(~F.col("_known")).withColumn("_part", part)
    for by in ([*keys, "_part"], keys):
        fresh = fresh.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(id_col))).filter(F.col("_rn") <= samples)
    shown = fresh.groupBy(*keys).agg(F.array_sort(F.collect_list(id_col)).alias("samples"))  # ``samples`` ids at most
    return counts.join(shown, keys, "left").withColumn("samples", F.coalesce("samples", F.array()))


def merged_stats(df: DataFrame, sums: list[str], flags: list[str], sets: list[str]) -> DataFrame:
    """Counters summed, flags or-ed, lists united.  Only distinct elements of the lists come together."""
    out = df.agg(*[F.sum(s).alias(s) for s in sums], *[F.bool_or(f).alias(f) for f in flags])
    for s in sets:
        distinct = df.select(F.explode(s).alias("_e")).distinct()
        out = out.crossJoin(distinct.agg(F.array_sort(F.collect_list("_e")).alias(s)))  # one row
    return out.select(*sums, *flags, *sets)


def guard_counts(df: DataFrame, guards: list[tuple[str, Column]]) -> DataFrame:
    """Rows that each guard, in order, is the first to stop, and those that pass all."""
    stage = F.lit("passed")
    for name, stops in reversed(guards):
        stage = F.when(F.coalesce(stops, F.lit(False)), name).otherwise(stage)
    return df.groupBy(stage.alias("stage")).agg(F.count("*").alias("n"))
