"""Exports: CSV, JSON, notes, index pages and retained logs."""

from __future__ import annotations

import io
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, functions as F


def quoted(c: Column) -> Column:
    """A CSV field: quoted, quotes doubled, null empty."""
    return F.concat(F.lit('"'), F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))


def csv_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as one CSV line; lists are joined by semicolons."""
    fields = [quoted(F.array_join(c, "; ") if dict(df.dtypes)[c].startswith("array") else F.col(c)) for c in columns]
    return df.select("*", F.concat_ws(",", *fields).alias("line"))


def write_csv(df: DataFrame, path: str) -> None:
    flat = [F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')


def json_lines(df: DataFrame, columns: list[str], name: str = "json") -> DataFrame:
    return df.withColumn(name, F.to_json(F.struct(*columns)))


def note(front: dict[str, Column], title: Column, body: Column) -> Column:
    """A Markdown note: front matter, title, body."""
    lines = [F.concat(F.lit(f"{k}: "), F.coalesce(v.cast("string"), F.lit(""))) for k, v in front.items()]
    return F.concat_ws("\n", F.lit("---"), *lines, F.lit("---"), F.lit(""), F.concat(F.lit("# "), title), F.lit(""), body)


def changed_notes(notes: DataFrame, written: DataFrame, path: str, text: str) -> DataFrame:
    """Notes whose text isn't what was written before, by hash; names that leave the folder are dropped."""
    safe = notes.filter(~F.col(path).contains("..") & ~F.col(path).startswith("/")).withColumn("sha", F.sha2(text, 256))
    return safe.join(written.select(path, "sha"), [path, "sha"], "left_anti")


def index_page(df: DataFrame, keys: str, line: str) -> DataFrame:
    """(key, n, page): the lines of each key in order; a row appears under each of its keys."""
    rows = df.select(F.explode(keys).alias("key"), line)
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("page"))


def append_day(df: DataFrame, path: str, day: str) -> None:
    """Appends to a log in folders by day."""
    df.write.mode("append").partitionBy(day).json(path)


def _folder(spark, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_bytes(spark, path: str, data: bytes) -> None:
    """A file that is there whole or not at all: written beside its place, then moved over it."""
    at, fs = _folder(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    fs.delete(at, False)
    if not fs.rename(beside, at):
        raise OSError(f"can't move {beside} to {at}")


def category_zip(df: DataFrame, columns: list[str], name: str, text: str) -> bytes:
    """A category as a ZIP: a manifest in CSV and a file for each row, streamed to the driver row by row; a category is one reader's download."""
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        lines = [",".join(f'"{c}"' for c in columns)]
        for row in csv_lines(df, columns).select("line", name, text).toLocalIterator():
            lines.append(row["line"])
            z.writestr(str(row[name]).replace("/", "_"), row[text] or "")
        z.writestr("manifest.csv", "\n".join(lines))
    return held.getvalue()


def swept(spark, path: str, day: str, cutoff: str) -> list[str]:
    """Deletes the folders of a log by day that lie before the cutoff, and names them; folders of other names stay."""
    at, fs = _folder(spark, path)
    gone = []
    for f in fs.listStatus(at):
        name = f.getPath().getName()
        if f.isDirectory() and name.startswith(f"{day}=") and len(name) == len(day) + 11 and name[len(day) + 1 :] < cutoff:
            fs.delete(f.getPath(), True)
            gone.append(name)
    return sorted(gone)


def report_line(rank: Column, grade: Column, title: Column, url: Column, summary: Column, echo: Column) -> Column:
    """A line of a brief: place, grade and linked title, and the summary unless it says the title again."""
    head = F.concat(rank.cast("string"), F.lit(". **"), grade, F.lit("** ["), title, F.lit("]("), F.coalesce(url, F.lit("")), F.lit(")"))
    return F.when(echo | (F.coalesce(summary, F.lit("")) == ""), head).otherwise(F.concat(head, F.lit("\n   "), summary))
