"""Session defaults, and the package on the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Settings that the operators rely on; all can be set at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build(cores: int | str = "*", partitions: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in (DEFAULTS | {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"} | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once, so that Python stages find it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_tessera_shipped", False):
        return
    root = Path(__file__).resolve().parent
    handle, name = tempfile.mkstemp(prefix="tessera-", suffix=".zip")
    with os.fdopen(handle, "wb") as f, zipfile.ZipFile(f, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(name)
    context._tessera_shipped = True
