"""Entities, rule enrichment, host tools, deterministic clustering and the text to embed."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, scalars
from . import ranges


def entities(df: DataFrame, text: str) -> DataFrame:
    """Adds hashtags, mentions, urls and domains of a text, in order, case-insensitively distinct."""
    grab = lambda p: scalars.distinct_ignoring_case(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(p), F.lit(1)))
    df = df.withColumns({"hashtags": grab(r"#(\w+)"), "mentions": grab(r"@(\w+)"), "urls": grab(r"(https?://[^\s)\]]+)")})
    return df.withColumn("domains", F.array_distinct(F.filter(F.transform("urls", scalars.host_of), lambda h: h != "")))


def enriched(df: DataFrame, text: str) -> DataFrame:
    """Adds topic tags, categories, tools, format flags and the segment, by rule."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns({"_low": F.lower(t), "_plain": scalars.ascii_words(t)})  # once for all patterns
    low, plain = F.col("_low"), F.col("_plain")
    like = lambda p: scalars.like(low, plain, p)
    df = df.withColumns({
        "has_code": like(fixed.CODE_PATTERN), "is_launch": like(fixed.LAUNCH_PATTERN), "is_benchmark": like(fixed.BENCHMARK_PATTERN),
        "is_thread": F.regexp_like(t, F.lit(r"(?i)(^|\s)(thread|🧵)($|\s|:)")) | F.regexp_like(t, F.lit(r"(^|\s)\d{1,2}\s*/\s*\d{1,2}($|\s)")),
        "tools": scalars.matches(low, plain, fixed.TOOL_RULES),
    })
    df = df.withColumn("rules", scalars.matches(low, plain, fixed.TOPIC_RULES))
    category = F.create_map(*[F.lit(x) for tag, c, _ in fixed.TOPIC_RULES for x in (tag, c)])
    extra = F.array_compact(F.array(F.when(F.col("is_launch"), "launch"), F.when(F.col("is_benchmark"), "benchmark"), F.when(F.col("has_code"), "developer-tools")))
    df = df.withColumn("topic_tags", F.array_distinct(F.concat("rules", extra)))
    more = F.when(F.col("has_code"), F.array(F.lit("dev-tools"))).otherwise(F.array().cast("array<string>"))
    df = df.withColumn("categories", F.array_distinct(F.concat(F.transform("rules", lambda r: category[r]), more)))
    relevant = F.arrays_overlap("categories", scalars.words_in(fixed.RELEVANT_CATEGORIES)) | F.col("is_launch") | F.col("is_benchmark") | F.col("has_code")
    return df.withColumn("segment", F.when(relevant, "brief-relevant").otherwise("everything-else")).drop("_low", "_plain")


def tools_of_hosts(df: DataFrame, host: str, tools: dict[str, str]) -> DataFrame:
    """Adds the tool of a host by its exact domain, else by the nearest parent domain."""
    parts = F.split(F.col(host), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    table = F.create_map(*[F.lit(x) for kv in tools.items() for x in kv])
    return df.withColumn("tool", F.get(F.array_compact(F.transform(suffixes, lambda d: F.try_element_at(table, d))), F.lit(0)))


def clusters_for(n: int) -> int:
    return min(12, n, max(2, round((n / 24) ** 0.5)))


def kmeans(df: DataFrame, id_col: str, vector: str, k: int, dims: int = 32, rounds: int = 6) -> DataFrame:
    """(id, cluster): Lloyd's algorithm on ``dims`` evenly sampled dimensions from evenly spaced starts by id.

    Ties go to the lowest cluster; an empty cluster keeps its centre.  Only
    ``k`` centres of ``dims`` numbers ever reach the driver.
    """
    size = df.select(F.size(vector).alias("n")).limit(1).collect()
    if not size:
        return df.select(id_col, F.lit(0).alias("cluster"))
    width = size[0]["n"]
    take = sorted({int(i * width / min(dims, width)) for i in range(min(dims, width))})
    rows = df.select(id_col, F.array(*[F.col(vector)[i].cast("double") for i in take]).alias("v"))
    n = rows.count()
    k = min(k, n)
    starts = [int(i * n / k) for i in range(k)]
    first = ranges.numbered(rows, [F.asc(id_col)], "_at").filter(F.col("_at").isin(starts)).collect()  # k rows
    centres = np.array([r["v"] for r in sorted(first, key=lambda r: r["_at"])])

    def nearest(c: np.ndarray) -> Column:
        gaps = [
            F.struct(F.aggregate(F.zip_with("v", F.array(*[F.lit(float(x)) for x in row]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x).alias("d"), F.lit(i).alias("i"))
            for i, row in enumerate(c)
        ]
        return F.array_min(F.array(*gaps))["i"]

    for _ in range(rounds):
        means = rows.groupBy(nearest(centres).alias("c")).agg(*[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(len(take))])
        for r in means.collect():  # k rows
            centres[r["c"]] = [r[f"m{i}"] for i in range(len(take))]
    return rows.select(id_col, nearest(centres).alias("cluster"))


def embedded_text(parts: list[tuple[str, Column]]) -> Column:
    """Labelled lines of the parts that aren't empty."""
    lines = [F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{name}: "), c)) for name, c in parts]
    return F.array_join(F.array_compact(F.array(*lines)), "\n")
