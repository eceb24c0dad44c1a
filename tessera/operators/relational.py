"""Filters, joins, nesting, set operations and pages."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F


def filtered(df: DataFrame, **conditions) -> DataFrame:
    """Rows that meet every condition given: ``equals`` and ``isin`` (by column), ``contains`` (text, columns), ``where`` (column)."""
    tests: list[Column] = []
    tests += [F.col(c) == v for c, v in conditions.get("equals", {}).items()]
    tests += [F.col(c).isin(list(v)) for c, v in conditions.get("isin", {}).items()]
    if "contains" in conditions:
        word, columns = conditions["contains"]
        tests.append(any_contains([word], columns))
    tests += [conditions["where"]] if "where" in conditions else []
    return df.filter(reduce(and_, tests)) if tests else df


def any_contains(words: list[str], columns: list[str]) -> Column:
    """Whether one of the columns holds one of the words, case ignored."""
    return reduce(or_, [F.lower(F.col(c)).contains(w.lower()) for c in columns for w in words])


def page(df: DataFrame, order: list[Column], number: int, size: int, most: int = 100) -> DataFrame:
    """One page, counted from 1; a page holds at most ``most`` rows."""
    size = max(1, min(size, most))
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def page_after(df: DataFrame, key: str, cursor, size: int) -> DataFrame:
    """The page that follows a key."""
    rest = df.filter(F.col(key) > F.lit(cursor)) if cursor is not None else df
    return rest.orderBy(key).limit(size)


def in_window(df: DataFrame, ts: Column, since: str, until: str) -> DataFrame:
    """Rows from ``since`` on and before ``until``; rows without a time drop out."""
    return df.filter((ts >= F.lit(since).cast("timestamp_ntz")) & (ts < F.lit(until).cast("timestamp_ntz")))


def floor_or_known(df: DataFrame, value: str, least: float, who: str, known: list) -> DataFrame:
    """Rows at or above a floor, or from someone known."""
    return df.filter((F.col(value) >= least) | F.col(who).isin(known))


def with_any(df: DataFrame, child: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    child = child if where is None else child.filter(where)
    return df.join(child.select(key), key, "left_semi")


def with_none(df: DataFrame, child: DataFrame, key: str) -> DataFrame:
    return df.join(child.select(key), key, "left_anti")


def nested(parent: DataFrame, child: DataFrame, key: str, order: list[Column], fields: list[str], name: str) -> DataFrame:
    """Each parent with the array of its children, in order; an empty array where it has none."""
    at = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    item = F.struct(F.col("_at"), *fields)
    rows = child.withColumn("_at", at).groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    items = F.transform(F.coalesce("_items", F.array()), lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return parent.join(rows, key, "left").withColumn(name, items).drop("_items")


def joined_texts(child: DataFrame, key: str, text: str, order: str, sep: str = "\x01") -> DataFrame:
    """A key's texts in order, in one string."""
    items = F.sort_array(F.collect_list(F.struct(order, text)))
    return child.filter(F.col(text).isNotNull()).groupBy(key).agg(F.array_join(F.transform(items, lambda x: x[text]), sep).alias(text))


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def ordered_union(*lists: DataFrame, key: str, position: str) -> DataFrame:
    """Keys of several ranked lists in order of first sight."""
    rows = [x.select(key, F.lit(i).alias("_list"), F.col(position).alias("_at")) for i, x in enumerate(lists)]
    union = reduce(DataFrame.unionByName, rows)
    first = union.groupBy(key).agg(F.min(F.struct("_list", "_at")).alias("_first"))
    return first.select(key, F.row_number().over(Window.orderBy("_first", key)).alias("position"))


def merged(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Both, with the new row where both have the key."""
    return new.unionByName(old.join(new.select(key), key, "left_anti"))


def overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many keys both have, only one has, and their Jaccard similarity."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    both = a.join(b, key, "full")
    count = lambda c: F.count_if(c).alias
    out = both.agg(
        count(F.col("_l").isNotNull() & F.col("_r").isNotNull())("overlap"),
        count(F.col("_r").isNull())("only_left"),
        count(F.col("_l").isNull())("only_right"),
    )
    every = F.col("overlap") + F.col("only_left") + F.col("only_right")
    return out.withColumn("jaccard", F.when(every > 0, F.col("overlap") / every))


def missing_and_extra(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    a, b = expected.select(key).distinct(), got.select(key).distinct()
    gone = a.join(b, key, "left_anti").withColumn("side", F.lit("missing"))
    return gone.unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("extra")))
