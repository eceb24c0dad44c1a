"""Best-fit decreasing packing of tokenised documents into sequences.

Documents are tokenised where they are read and cut into pieces no longer than
a sequence.  Best-fit decreasing looks only at lengths, and there are at most
``capacity`` of them, so the histogram of lengths is all that the driver gets:
pieces of one length and bins of one remaining capacity are placed together,
the tightest open bin being found in a segment tree over remaining capacities.
The outcome is exactly that of placing the pieces one by one, longest first, in
time that depends on ``capacity`` alone.  The plan names, for each length, runs
of ranks and the bins they go to; each piece finds its own place from its rank
among the pieces of its length.

Defined cases: a null or empty text is the closing id alone; repeated rows are
packed like any other; an empty table gives an empty table; other columns are
ignored.  A document longer than a sequence is cut from its end, so that only
its first piece may be shorter than a sequence.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import durable

CAPACITY = 2048
#: Id that closes a document.
END_ID = 0
#: Pieces of one length that one window partition holds, about.
RANK_ROWS = 100_000


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """The ids of the byte-level BPE tokenizer in ``path`` (tokenizer JSON), from its merges held as ranks.

    The same vocabulary as ranks encodes several times faster than the JSON's
    own library and gives the same ids; tests compare the two.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    vocab, special = model["model"]["vocab"], {t["content"]: t["id"] for t in model.get("added_tokens", [])}
    # Byte-level BPE writes the bytes that aren't printable as characters from 256 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token not in special}
    exact = Tokenizer.from_file(path)
    split = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
    # Without a run of white space the two patterns split alike, and the first needs no look-ahead.
    plain = tiktoken.Encoding("plain", pat_str=split + r"|\s+", mergeable_ranks=ranks, special_tokens={})
    whole = tiktoken.Encoding("whole", pat_str=split + r"|\s+(?!\S)|\s+", mergeable_ranks=ranks, special_tokens={})
    runs, marks = re.compile(r"\s\s"), [m for m in special if m]

    def encode(text: str) -> list[int]:
        if any(m in text for m in marks):
            return exact.encode(text, add_special_tokens=False).ids
        return (whole if runs.search(text) else plain).encode_ordinary(text)

    return encode


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids: full ones from its end, the rest first."""
    head = n % capacity or min(n, capacity)
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def tokenized_pieces(docs: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", capacity=CAPACITY, with_ids=False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")

    def run(batches):
        encode = _encoder(tokenizer)
        for batch in batches:
            out = defaultdict(list)
            for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), END_ID], "<u4")
                for k, (start, length) in enumerate(pieces_of(len(ids), capacity)):
                    raw = ids[start : start + length].tobytes()
                    out["doc_id"].append(doc.as_py())
                    out["piece"].append(k)
                    out["start"].append(start)
                    out["length"].append(length)
                    out["ids_crc32"].append(zlib.crc32(raw))
                    if with_ids:
                        out["ids"].append(raw)
            if out:
                types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, fields)


class _Tightest:
    """Segment tree over remaining capacities 0..n: the smallest with open bins that is at least a length."""

    def __init__(self, n: int):
        self.size = 1 << (n + 1).bit_length()
        self.open = [0] * (2 * self.size)

    def add(self, at: int, count: int) -> None:
        at += self.size
        while at:
            self.open[at] += count
            at >>= 1

    def find(self, at: int) -> int | None:
        node = at + self.size
        if self.open[node]:
            return at
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.open[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, ranks, first bin, pieces a bin, offset) ordered by length and rank, and the number of bins.

    Rank ``r`` of a row goes to bin ``first bin + (r - first rank) // pieces a
    bin``, at ``offset`` plus ``length`` for each earlier one of that bin.
    """
    tree, runs, plan, bins = _Tightest(capacity), defaultdict(list), [], 0

    def release(left: int, first: int, count: int) -> None:
        if left and count:
            runs[left].append((first, count))
            tree.add(left, count)

    def place(length: int, rank: int, n: int, first: int, left: int) -> None:
        """``n`` pieces into bins from ``first`` on, each with ``left`` ids free and filled before the next is."""
        each = left // length
        plan.append((length, rank, n, first, each, capacity - left))
        full, rest = divmod(n, each)
        release(left - each * length, first, full)
        if rest:
            release(left - rest * length, first + full, 1)

    for length in sorted(histogram, reverse=True):
        rank, n = 0, histogram[length]
        while n:
            left = tree.find(length)
            if left is None:
                used = -(-n // (capacity // length))
                place(length, rank, n, bins, capacity)
                bins, n = bins + used, 0
                continue
            first, count = runs[left].pop()
            each = left // length
            used = min(count, -(-n // each))
            tree.add(left, -count)
            release(left, first + used, count - used)
            now = min(n, used * each)
            place(length, rank, now, first, left)
            rank, n = rank + now, n - now
    return np.array(sorted(plan), "i8").reshape(-1, 6), bins


def pack(docs: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset."""
    spark = docs.sparkSession
    pieces = durable(tokenized_pieces(docs, tokenizer, id_col, text_col, capacity, with_ids), "pieces")
    # At most ``capacity`` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan, _ = best_fit_plan(histogram, capacity)
    salts = max(16, -(-max(histogram.values(), default=0) // RANK_ROWS))
    cell = ["length", "salt"]
    rows = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*cell).agg(F.count("*").alias("n"))
    starts = starts.select(*cell, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    local = F.row_number().over(Window.partitionBy(*cell).orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = rows.withColumn("local", local).join(starts, cell).withColumn("rank", F.col("first") + F.col("local"))
    shared = spark.sparkContext.broadcast(plan)  # bounded by the capacity, not by the data
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    fields = ", ".join(f"{c} {pieces.schema[c].dataType.simpleString()}" for c in columns) + ", sequence_id long, offset long"

    def run(batches):
        p = shared.value
        wide = np.int64(1) << 48
        keys = p[:, 0] * wide + p[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = p[np.searchsorted(keys, length * wide + rank, "right") - 1]
            at = rank - row[:, 1]
            bin_, offset = row[:, 3] + at // row[:, 4], row[:, 5] + at % row[:, 4] * length
            yield pa.record_batch([*(batch.column(c) for c in columns), pa.array(bin_), pa.array(offset)], names=[*columns, "sequence_id", "offset"])

    return ranked.select(*columns, "rank").mapInArrow(run, fields)
