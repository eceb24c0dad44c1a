"""Suffix-array deduplication over bytes.

A sparse suffix array: of the suffixes of every text those that start at an
anchor are sorted (see ``repeats``: every 50 equal bytes hold the same anchor).
Splitters sampled from the suffixes' leading 16 bytes range-partition them into
buckets.  A bucket sorts its suffixes by multikey quicksort, whose characters
are eight bytes wide: the first 16 bytes, then a hash of the whole block around
the anchor, of which only equality matters, then the document.  Neighbours are
then compared: equal blocks of a later document are repeats.

Sixteen equal bytes are never split among buckets, so equal blocks stand in one; what
crosses the edges of blocks, where a copied passage starts or ends, is compared
window by window in a second round.

A byte is removed if a string of ``width`` bytes that covers it also starts in a
document with a smaller id.  Strings are judged on the input, and end with it.

Defined cases: ids are integers; a null text is empty; shorter texts stay whole; a null id neither
removes nor loses bytes; rows that share an id don't count as earlier than one
another; a repeat inside one document stays; an empty table gives an empty
table; other columns are ignored.  Spans may cut a UTF-8 character.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import repeats

WIDTH = 50
#: Bytes of an anchor: two of the sort's characters.
GRAM = 16
#: Documents whose suffixes the splitters are sampled from, and suffixes of each.
SAMPLE_DOCS, SAMPLE_EACH = 512, 64


def leading(raw: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first two characters of eight bytes of the suffixes at ``places``, ordered as their bytes are."""
    wide = np.lib.stride_tricks.sliding_window_view(raw, GRAM)[places]
    both = np.ascontiguousarray(wide).view(">u8").astype("u8")
    return both[:, 0], both[:, 1]


def multikey_order(*characters: np.ndarray) -> np.ndarray:
    """The order of rows by their first character, rows equal so far by the next, and so on.

    Each round sorts only rows that still stand in a run of equals.
    """
    order = np.argsort(characters[0], kind="stable")
    run = repeats.runs_of(characters[0][order])
    for column in characters[1:]:
        size = np.bincount(run) if len(run) else run
        open_ = np.flatnonzero(size[run] > 1) if len(run) else run
        if not len(open_):
            break
        rows = order[open_]
        order[open_] = rows[np.lexsort((column[rows], run[open_]))]
        run = repeats.runs_of(run, column[order])
    return order


def _sorted(blocks: dict[str, np.ndarray]) -> np.ndarray:
    return multikey_order(blocks["lead"], blocks["key"], blocks["hash"], blocks["doc"])


def bucket_of(cuts: tuple[np.ndarray, np.ndarray], lead: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How many of the ascending ``cuts`` (their two characters) stand at or before each suffix; only suffixes that agree with a cut's first ask for the second."""
    at = np.searchsorted(cuts[0], lead, "right")
    tied = np.flatnonzero(np.searchsorted(cuts[0], lead, "left") < at)
    wide = lambda a, b: np.ascontiguousarray(np.stack([a, b], 1).astype(">u8")).view("S16").ravel()
    at[tied] = np.searchsorted(wide(*cuts), wide(lead[tied], key[tied]), "right")
    return at


def sampled_splitters(docs: DataFrame, id_col: str, text_col: str, width: int, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading values, as two characters, that cut the suffixes into ``bins`` buckets or fewer, from a bounded sample of documents."""
    some = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter("doc is not null")
    # A threshold from a count lets about SAMPLE_DOCS through.
    level = min(1 << 30, -(-SAMPLE_DOCS * (1 << 30) // max(1, docs.count())))
    some = some.filter(F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) < level).limit(2 * SAMPLE_DOCS)

    def run(batches):
        for batch in batches:
            for text in batch.column("text"):
                raw = np.frombuffer(repeats.encoded(text), "u1")
                at, key = [], []
                for a, b, _, _ in repeats.segments(len(raw), width):
                    place, _, _, hashes, *_ = repeats.blocks_of(repeats.byte_values(raw[a:b]), width, GRAM)
                    least = np.argsort(hashes)[:SAMPLE_EACH]
                    at, key = [*at, place[least] + a], [*key, hashes[least]]
                at, key = np.concatenate(at), np.concatenate(key)
                if len(at):
                    least = at[np.argsort(key)[:SAMPLE_EACH]]
                    yield pa.record_batch([pa.array(x.view("i8")) for x in leading(raw, least)], names=["lead", "key"])

    rows = some.mapInArrow(run, "lead long, key long").collect()
    got = np.array([tuple(r) for r in rows], "i8").reshape(-1, 2).view("u8")
    got = got[np.lexsort((got[:, 1], got[:, 0]))]
    cuts = np.unique(got[np.arange(1, bins) * len(got) // bins], axis=0) if len(got) else got
    return cuts[:, 0].copy(), cuts[:, 1].copy()


def dedup_suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256[, spans, kept] of every document; spans are (start, end) in bytes."""
    kind = docs.schema[id_col].dataType.simpleString()
    cuts = sampled_splitters(docs, id_col, text_col, width, repeats.n_bins(docs))
    rows, spans, named = repeats.repeated(
        docs, id_col, text_col, repeats.byte_values, width, GRAM, _sorted, leading, lambda lead, key: bucket_of(cuts, lead, key)
    )
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["spans", "kept"] * with_text
    fields = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    fields += ", spans array<struct<start:long,end:long>>, kept binary" if with_text else ""
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()] + [span_type, pa.binary()] * with_text

    def make(each):
        out = [[] for _ in names]
        for doc, data, spans in each:
            runs, kept = [], data
            if len(spans["first"]):
                gone = repeats.covered(len(data), spans["first"], spans["count"])
                turn = np.flatnonzero(np.diff(np.r_[False, gone, False].astype("i1")))
                runs = list(zip(turn[::2].tolist(), turn[1::2].tolist()))
                kept = np.frombuffer(data, "u1")[~gone].tobytes()
            row = [doc, len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()]
            row += [[{"start": a, "end": b} for a, b in runs], kept] if with_text else []
            for column, x in zip(out, row):
                column.append(x)
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=names)

    got = repeats.apply_spans(rows, spans, named, make, fields)
    return got.withColumn("doc", F.col("doc").cast(kind)).withColumnRenamed("doc", id_col)
