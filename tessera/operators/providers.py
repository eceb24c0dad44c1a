"""Operators around injected functions: embeddings, translations and work queues."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from ..functions import wording
from . import curation, dml


def embedded(df: DataFrame, text: str, provider: Callable, dims: int, out: str = "vector") -> DataFrame:
    """Adds the vectors of an injected provider; a batch with a vector too few, or of another size, is left null with its error."""

    def checked(texts):
        got = [list(map(float, v)) for v in provider(texts)]
        if any(len(v) != dims for v in got):
            raise ValueError(f"a vector that hasn't {dims} numbers")
        return got

    return curation.applied(df, checked, text, out, ArrayType(DoubleType()))


def translated(df: DataFrame, text: str, provider: Callable, out: str = "translation") -> DataFrame:
    """Adds the translation of foreign texts, each distinct one translated once; what fails, and the rest, stays as it is."""
    foreign = F.coalesce(wording.script_of(F.col(text)), wording.latin_language(F.col(text)))
    each = df.select(F.col(text).alias("_text")).filter(F.col("_text").isNotNull()).withColumnRenamed("_text", text).filter(foreign.isNotNull()).distinct()
    done = curation.applied(each, provider, text, "_done", single=True).select(F.col(text).alias("_text"), "_done")
    return df.join(done, F.col(text) == F.col("_text"), "left").withColumn(out, F.coalesce("_done", text)).drop("_text", "_done")


def drained(queue: DataFrame, id_col: str, column: str, provider: Callable, n: int, owner: str, terminal: str, most: int) -> DataFrame:
    """The queue after ``n`` pending rows are claimed, worked on one by one and released with their result or error."""
    rows = dml.claimed(queue, id_col, "status", n, owner).drop("error", "result")
    mine = rows.filter(F.col("owner") == owner)
    worked = curation.applied(mine, provider, column, "result", single=True)
    rest = rows.filter(F.col("owner").isNull()).withColumns({"result": F.lit(None).cast("string"), "error": F.lit(None).cast("string")})
    return dml.released(worked, "status", "attempts", "error", terminal, most).unionByName(rest)
