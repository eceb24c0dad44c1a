"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: The white space that ends a word: space, tab, LF, VT, FF, CR.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is unset, one in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def durable(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once into the shared folder and read back: its lineage ends there, so a lost executor costs no recomputation of what came before."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._durable = path
    return back


def forget(*written: DataFrame) -> None:
    """Deletes the files under :func:`durable` results that nothing will read again."""
    for df in written:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._durable)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def input_bytes(df: DataFrame) -> int:
    """Size of the files under ``df`` as the optimizer knows it; 0 where it doesn't."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else 0


def ranges(df: DataFrame, each: int = 16 << 20) -> int:
    """Ranges to deal ``df`` into: some for each shuffle partition, and more where they would hold over ``each`` bytes of its files."""
    return max(4 * shuffle_partitions(df.sparkSession), input_bytes(df) // each)


def few_keys(keys: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Marks written ``keys`` for a broadcast if they are counted to be ``most`` at most; else they are joined as rows."""
    return F.broadcast(keys) if keys.count() <= most else keys


#: Keys that the cuts of ranges are taken from, about; and at most.
SAMPLE, SAMPLE_MOST = 4096, 16384


def splitters(keys: DataFrame, parts: int, sample: int = SAMPLE) -> list[tuple]:
    """At most ``parts - 1`` ascending key tuples that deal the rows into ranges of like size.

    They come from the keys whose hash lies below a threshold that a count of the
    rows sets: a repeatable sample of about ``sample`` keys and never more than
    ``SAMPLE_MOST``, however many tasks there are.  A key that many rows share
    travels once, with its count.  Results never depend on where the cuts fall.
    """
    cols = keys.columns
    keys = keys.na.drop()
    steps = 1 << 30
    level = min(steps, -(-sample * steps // max(1, keys.count())))
    some = keys.filter(F.pmod(F.xxhash64(*cols), F.lit(steps)) < level)
    got = sorted(tuple(r) for r in some.groupBy(*cols).count().limit(SAMPLE_MOST).collect())
    total, seen, cuts = sum(r[-1] for r in got), 0, []
    for r in got:
        if seen * parts // max(1, total) != (seen + r[-1]) * parts // max(1, total) and seen:
            cuts.append(r[:-1])
        seen += r[-1]
    return cuts


def range_bucket(cols: list[str], cuts: list[tuple]) -> Column:
    """Number of the range of ``cuts`` that a row's key falls in, found by halving; null keys fall in the first."""
    if not cuts:
        return F.lit(0)
    key = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(cols)])
    bounds = F.array(*[F.struct(*[F.lit(v).alias(f"k{i}") for i, v in enumerate(c)]) for c in cuts])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])

    def halve(at, step):
        return F.when(F.coalesce(F.get(bounds, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at)

    # Never null, and seen to be so: else plans that join on the range filter nulls out in one place and not in the other, and share nothing.
    return F.coalesce(F.aggregate(steps, F.lit(0), halve), F.lit(0))


def with_neighbours(rows: DataFrame, key: list[str], parts: int, split: list[str] | None = None, before=True, after=True, cyclic=False) -> DataFrame:
    """Deals rows into ranges of ``key`` whose windows also see the rows just outside.

    Adds ``_bucket`` (the range), ``_side`` (0; -1 or 1 for a copy of the row
    that comes just before or after the range) and ``_row`` (its number inside
    ``_bucket`` by ``_side`` and ``key``).  The result is partitioned by
    ``_bucket``; a window over it ordered by ``_row`` gives every row its true
    neighbours, without a task that sees the whole order.  ``cyclic`` puts the
    last row before the first.  ``key`` orders all rows and holds no nulls; the
    ranges are cut by its leading columns ``split``.
    """
    split = split or key
    cuts = splitters(rows.select(*split), parts)
    keyed = rows.withColumn("_bucket", range_bucket(split, cuts)).withColumn("_side", F.lit(0))
    point = F.struct(*key)
    # One row for each range: at most ``parts`` of them.
    ends = keyed.groupBy("_bucket").agg(F.min(point).alias("_lo"), F.max(point).alias("_hi"))
    w, every = Window.orderBy("_bucket"), Window.partitionBy(F.lit(0))
    up, down = F.lead("_bucket").over(w), F.lag("_bucket").over(w)
    if cyclic:
        up, down = F.coalesce(up, F.min("_bucket").over(every)), F.coalesce(down, F.max("_bucket").over(every))
    ends = ends.select("*", up.alias("_up"), down.alias("_down"))
    edge, out = keyed.join(F.broadcast(ends), "_bucket"), keyed
    for wanted, side, mark, to in ((before, -1, "_hi", "_up"), (after, 1, "_lo", "_down")):
        if wanted:
            copies = edge.filter((point == F.col(mark)) & F.col(to).isNotNull())
            copies = copies.withColumn("_bucket", F.col(to)).withColumn("_side", F.lit(side))
            out = out.unionByName(copies.select(*keyed.columns))
    return out.withColumn("_row", F.row_number().over(Window.partitionBy("_bucket").orderBy("_side", *key)))


def ranked(rows: DataFrame, key: list[str], parts: int) -> DataFrame:
    """Adds ``_rank``: the number, from 0, of each row in the order of ``key``, which orders all rows.

    Rows are numbered inside ranges of the key, and ranges by the counts before
    them: no task sees more than a range.  Null keys come first.
    """
    dealt = rows.withColumn("_bucket", range_bucket(key, splitters(rows.select(*key), parts)))
    # At most ``parts`` rows.
    sizes = dealt.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy("_bucket").orderBy(*key)) - 1
    out = dealt.withColumn("_local", local).join(F.broadcast(starts), "_bucket")
    return out.withColumn("_rank", F.col("_start") + F.col("_local")).drop("_bucket", "_local", "_start")
