"""Mixing sources to target weights by systematic sampling.

A source's target is its share by weight of all words, held to ``max_repeat``
times the words it has; what that cuts off is shared again by weight among the
sources still below.  Every document of a source then expects
``target / size`` copies, held as a whole number of ``2**-24``, so that sums are
exact.  The documents of a source lie in descending order of size; the prefix sum
of their expected copies plus one random offset, drawn once for the source, crosses
integers, and a document is emitted once for each that it crosses.  Ordering by
size makes the words taken differ from the target by less than the longest
document.

Prefix sums need no task that holds a source: rows are counted by cell (source,
size, salt), the cells summed in order within bands of ``BAND`` sizes and the
bands within their source, and rows numbered within their cell.  Salts grow with
the rows of a cell.  Sources are ranked in ranges, and the level up to which their
targets fill is found by sums over all of them: no task sees all sources either.

Defined cases: a null text has size 0; a null source is a source of its own,
after all others; a source without words has target 0 and no copies; repeated
rows are documents like any other; an empty table gives an empty table.  Equal
inputs give equal results, whatever the partitioning.  A source may have up to
2**37 documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import durable, forget, ranked, ranges

#: Rows that a part of one source and size holds, about.
CELL_ROWS = 100_000
#: Sizes in one band of cells.
BAND = 16
#: Steps in one expected copy.
UNIT = 1 << 24


def word_count(text: Column) -> Column:
    """Number of words; linear in the text and free of regular-expression recursion."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_repeat: int = 3, share: float = 1.0) -> DataFrame:
    """From written rows (src, src_null, source_size), one for each source: the target of each.

    Filling like water: sources whose cap lies at or below their share of what the
    others leave are held to it, until none is left above; each round is one sum.
    """
    rows = ranked(sizes, ["src_null", "src"], ranges(sizes))
    spot = F.pmod(F.col("_rank"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (spot + 1).cast("int"))
    rows = rows.withColumn("w", weight).withColumn("cap", (F.col("source_size") * max_repeat).cast("double")).drop("_rank")
    rows = durable(rows, "weights")
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    level, before = 0.0, None
    while True:
        held = F.col("cap") <= F.col("w") * F.lit(level)
        n, spent, rest = rows.agg(
            F.sum(held.cast("long")), F.sum(F.when(held, F.col("cap")).otherwise(0.0)), F.sum(F.when(held, 0.0).otherwise(F.col("w")))
        ).first()
        if n == before or not rest:
            break
        level, before = (total - spent) / rest, n
    target = F.when(held, F.col("cap")).otherwise(F.col("w") * F.lit(level))
    return rows.select("src", "src_null", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    max_repeat: int = 3,
    share: float = 1.0,
    seed: int = 42,
) -> DataFrame:
    """(row, id, size, source_size, target, copies): every input row once, as struct ``row``, with its copies in the mix."""
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(id_col).alias("id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
        F.col(source_col).isNull().alias("src_null"),
        word_count(F.col(text_col)).alias("size"),
    )
    return _mixed(rows, weights, max_repeat, share, seed)


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """:func:`mix` without the input row: the text never leaves the scan."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("src"),
        F.col(source_col).isNull().alias("src_null"),
        word_count(F.col(text_col)).alias("size"),
    )
    return _mixed(rows, **({"weights": (5, 2, 1), "max_repeat": 3, "share": 1.0, "seed": 42} | options))


def _mixed(rows: DataFrame, weights, max_repeat, share, seed) -> DataFrame:
    source, cell = ["src", "src_null"], ["src", "src_null", "size", "salt"]
    tie = [F.xxhash64("id", F.lit(seed + 1)), F.col("id")] + ([F.xxhash64("row")] if "row" in rows.columns else [])
    rows = rows.withColumn("draw", F.xxhash64("id", F.lit(seed), tie[-1]))
    # Texts are counted once for all sums, and once more only where whole rows are asked for.
    narrow = durable(rows.drop("row"), "narrow")
    rows = rows if "row" in rows.columns else narrow
    counts = durable(narrow.groupBy(*source, "size").agg(F.count("*").alias("n")), "sizes")
    sizes = durable(counts.groupBy(*source).agg(F.sum(F.col("n") * F.col("size")).alias("source_size")), "sources")
    # The largest cell sets how many parts each is dealt into; most parts of small ones stay empty.
    salts = max(1, -(-(counts.agg(F.max("n")).first()[0] or 1) // CELL_ROWS))
    salt = F.pmod("draw", F.lit(salts))
    rows = rows.withColumn("salt", salt).drop("draw")
    counts = narrow.withColumn("salt", salt).groupBy(*cell).agg(F.count("*").alias("n")).withColumn("band", F.floor(F.col("size") / BAND))
    band = [*source, "band"]
    inside = Window.partitionBy(*band).orderBy(F.desc("size"), "salt").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*source).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    bands = counts.groupBy(*band).agg(F.sum("n").alias("m")).select(*band, F.coalesce(F.sum("m").over(before), F.lit(0)).alias("below"))
    starts = counts.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(bands, band)
    starts = starts.withColumn("start", F.col("below") + F.col("within")).drop("band", "below", "within", "n")
    rate = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * UNIT)).otherwise(0.0).cast("long")
    offset = F.pmod(F.xxhash64(*source, F.lit(seed)), F.lit(UNIT))
    plan = targets(sizes, weights, max_repeat, share).withColumn("rate", rate).withColumn("offset", offset)
    cells = durable(starts.join(plan, source), "cells")
    forget(sizes)
    local = F.row_number().over(Window.partitionBy(*cell).orderBy(*tie)) - 1
    out = rows.withColumn("local", local).join(cells, cell).withColumn("rank", F.col("start") + F.col("local"))
    # Whole numbers throughout: no document crosses more integers than its expected copies, rounded up.
    crossed = lambda rank: F.shiftright(rank * F.col("rate") + F.col("offset"), UNIT.bit_length() - 1)
    out = out.withColumn("copies", crossed(F.col("rank") + 1) - crossed(F.col("rank")))
    return out.drop("salt", "local", "start", "rank", "rate", "offset", *source)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs, **options).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
