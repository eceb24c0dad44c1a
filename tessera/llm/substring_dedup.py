"""Substring deduplication over words by a relative Lempel-Ziv parse.

The corpus is its own reference.  It is cut by its own content into reference
blocks (see ``repeats``) of at least a window of 50 words, and all of them are
indexed: key, hash, least document that holds it and the place there.  No task
holds the reference, so a document doesn't search it: its blocks meet the index by
their keys, and where a block differs from the reference, as at either end of a
copied passage, the windows of the unlike blocks meet one by one.

A document's matches come back with their sources.  Matches that follow one
another in one source are one match, as long as it can be on that course.  The
parse is greedy: where it stands it takes of the matches that cover the word the
one that reaches farthest as the next factor, else the words up to the next match
stay literal.  At a factor's boundary the following match may begin before it, by
the words that windows across the boundary need.  A match is a window long or
longer, so every factor becomes a duplicate span.

A word is removed if a window of ``width`` consecutive words that covers it also
starts in a document with a smaller id.  Windows are judged on the input.

Defined cases: ids are integers; a null text has no words; documents shorter than a window stay as
they are; a null id neither removes nor loses words; rows that share an id don't
count as earlier than one another; a repeat inside one document stays; an empty
table gives an empty table; columns besides id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import repeats

WIDTH = 50
#: Words of an anchor.
GRAM = 8


def _by_key(blocks: dict[str, np.ndarray]) -> np.ndarray:
    return np.lexsort((blocks["doc"], blocks["hash"], blocks["key"]))


def matches(first: np.ndarray, count: np.ndarray, source: np.ndarray, origin: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, source, place in the source), by start: stretches that touch on one course through one source are one."""
    course = origin - first
    by = np.lexsort((first, course, source))
    out: list[list[int]] = []
    for a, n, s, c in zip(*(x[by].tolist() for x in (first, count, source, course))):
        if out and out[-1][2:] == [s, c] and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], a + n)
        else:
            out.append([a, a + n, s, c])
    return sorted((a, b, s, a + c) for a, b, s, c in out)


def parse(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """The factors (start, end, source, place in the source) of the greedy parse over matches sorted by start."""
    out, at, k = [], 0, 0
    best: tuple[int, int, int, int] | None = None
    while True:
        while k < len(found) and found[k][0] <= at:
            if best is None or found[k][1] > best[1]:
                best = found[k]
            k += 1
        if best is not None and best[1] > at:
            a, b, source, place = best
            out.append((at, b, source, place + at - a))
            at = b
        elif k < len(found):
            at = found[k][0]
        else:
            return out


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, with_text: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept_sha256[, spans, kept_text] of every document; spans are factors (start, end, source, place) in words."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows, spans, named = repeats.repeated(docs, id_col, text_col, repeats.word_values, width, min(GRAM, width), _by_key, traced=True)
    fields = "doc long, n_words long, n_removed long, kept_sha256 string"
    fields += ", spans array<struct<start:long,end:long,source:long,place:long>>, kept_text string" if with_text else ""
    span_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "end", "source", "place")]))
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [span_type, pa.string()] * with_text
    names = ["doc", "n_words", "n_removed", "kept_sha256"] + ["spans", "kept_text"] * with_text

    def make(each):
        out = [[] for _ in names]
        for doc, data, spans in each:
            words, factors = data.split(), parse(matches(**spans)) if len(spans["first"]) else []
            kept, at = [], 0
            for a, b, _, _ in factors:
                kept += words[at:a]
                at = b
            kept += words[at:]
            whole = b" ".join(kept)
            row = [doc, len(words), len(words) - len(kept), hashlib.sha256(whole).hexdigest()]
            row += [[dict(zip(("start", "end", "source", "place"), f)) for f in factors], whole.decode()] if with_text else []
            for column, x in zip(out, row):
                column.append(x)
        return pa.table([pa.array(c, t) for c, t in zip(out, types)], names=names)

    got = repeats.apply_spans(rows, spans, named, make, fields)
    return got.withColumn("doc", F.col("doc").cast(kind)).withColumnRenamed("doc", id_col)
