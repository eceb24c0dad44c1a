"""Exact deduplication by progressive refinement (DataFrame operations only).

Rows are grouped by the length of their normalised text, the groups of two or
more by a hash of the text's first characters, and the groups of two or more of
those by the SHA-256 of the whole text.  Each level sees only what survived the
one before, and only narrow rows (id, length, hashes) are shuffled.

``deduplicated`` takes the full hash only of texts that share length and prefix
with another.  Their keys, and the ids to drop, go to where the texts are if they
are counted to be few; beyond that they are joined as rows.  The report
``exact_dedup`` names the full hash of every text, so there it is taken in the
scan that finds length and prefix, and the levels refine the groups alone.

What a level finds is written before it is joined: both sides of the join are
then dealt out anew, and a length or a text that very many rows share is split.

Texts count as equal when they are identical after each run of white space
becomes one space.  Defined cases: a null text is the empty text; null ids sort
after all others and never keep a group that has another id; of rows that
repeat one id and text, one stays; an empty table gives an empty table; columns
besides id and text are ignored by the report and carried by ``deduplicated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE, durable, few_keys, forget

#: Characters that the second level hashes.
PREFIX = 256
#: Keys that may be broadcast.
FEW = 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _levels(text: Column) -> tuple[Column, Column, Column]:
    """Length, prefix hash (of the length too) and full hash."""
    norm = normalised(text)
    return F.length(norm), F.xxhash64(F.length(norm), F.substring(norm, 1, PREFIX)), F.sha2(norm, 256)


def survivors(rows: DataFrame) -> DataFrame:
    """The written rows (n, prefix, copies, ...) that share both with another row.

    Each level groups by one column of its own, so that every grouping is combined
    before it is dealt out.
    """
    total = F.sum("copies")
    lengths = durable(rows.groupBy("n").agg(total.alias("c")).filter("c > 1").select("n"), "lengths")
    first = rows.join(lengths, "n", "left_semi")
    heads = durable(first.groupBy("prefix").agg(total.alias("c")).filter("c > 1").select("prefix"), "heads")
    forget(lengths)
    return rows.join(heads, "prefix", "left_semi")


def groups(rows: DataFrame) -> DataFrame:
    """From rows (id, full, copies): the groups of two rows or more, with their keeper and size; written."""
    found = rows.groupBy("full").agg(F.min("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    return durable(found.filter("group_size > 1"), "groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    n, prefix, full = _levels(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), n.alias("n"), prefix.alias("prefix"), full.alias("full"))
    # Repeats of one id and text become a count here and rows again at the end.
    rows = durable(rows.groupBy("n", "prefix", "full", "id").agg(F.count("*").alias("copies")), "hashes")
    joined = rows.join(groups(survivors(rows)), "full", "left")
    out = joined.select(
        F.col("id").alias(id_col),
        F.coalesce("keep_id", "id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
        F.col("full").alias("text_sha256"),
    )
    kept = F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return out.select(id_col, "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    n, prefix, full = _levels(F.col(text_col))
    row, id_ = F.struct("*").alias("row"), F.col(id_col).alias("id")
    narrow = durable(docs.select(id_, n.alias("n"), prefix.alias("prefix"), F.lit(1).alias("copies")), "lengths-and-prefixes")
    keys = durable(survivors(narrow).select("prefix").distinct(), "prefixes")
    if keys.count() <= FEW:  # only survivors of both levels are read to their end
        heads = docs.select(id_, F.col(text_col).alias("text"), prefix.alias("prefix"))
        hashes = heads.join(F.broadcast(keys), "prefix", "left_semi").select("id", _levels(F.col("text"))[2].alias("full"))
    else:  # rather hash every text than move one
        hashes = docs.select(id_, prefix.alias("prefix"), full.alias("full")).join(keys, "prefix", "left_semi").select("id", "full")
    hashes = durable(hashes.groupBy("full", "id").agg(F.count("*").alias("copies")), "hashes")
    dropped = hashes.join(groups(hashes), "full").filter((F.col("copies") > 1) | ~F.col("id").eqNullSafe(F.col("keep_id")))
    dropped = dropped.select(F.col("id").alias("drop_id"), F.col("full").alias("drop_full"), F.col("id").eqNullSafe(F.col("keep_id")).alias("repeat"))
    dropped = durable(dropped, "dropped")
    ids = durable(dropped.select(F.col("drop_id").alias("hit"), F.lit(True).alias("is_hit")).distinct(), "dropped-ids")
    # A text is hashed once more only where its id is one of those to drop.
    rows = docs.select(row, id_, F.col(text_col).alias("text")).join(few_keys(ids, FEW), F.col("id").eqNullSafe(F.col("hit")), "left")
    rows = rows.select("row", "id", F.when(F.col("is_hit"), F.sha2(normalised(F.col("text")), 256)).alias("full"))
    marked = rows.join(few_keys(dropped, FEW), F.col("id").eqNullSafe(F.col("drop_id")) & (F.col("full") == F.col("drop_full")), "left")
    single = marked.filter(F.col("repeat").isNull()).select("row.*")
    # Rows that repeat the keeper's id and text: one of them stays.
    w = Window.partitionBy("full", "id").orderBy(F.xxhash64("row"))
    again = marked.filter("repeat").withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("row.*")
    forget(narrow, keys, hashes)
    return single.unionByName(again)
