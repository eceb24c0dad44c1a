"""What the two operators on repeated passages share.

A window is ``width`` consecutive tokens of one document.  Its anchor is the
``gram`` tokens of least hash inside it, so equal windows have equal anchors at
equal places.  The windows of a document that share one anchor occurrence lie
side by side; together they span a block of ``width`` tokens or a few more.  A
corpus has about ``2 / (width - gram + 2)`` blocks for each token, and blocks
are all that is dealt out at first: the anchor's key, a hash of the whole block,
the document and the place.

Blocks of one key meet in one bin.  A block whose hash an earlier document holds
too is a repeat as a whole.  Where an anchor stands in blocks that differ, as at
either end of a copied passage, the first holder of each such block sends its
windows one by one into a second round, where equal windows meet.  Both rounds
together find exactly the windows that start in an earlier document too.

Blocks and windows travel packed: one binary of arrays for each batch and bin.
Spans travel as plain rows, as many as there are.  Where they are ``traced`` a span
names the document and place that its words first stand in, and windows are told
apart by 128 bits of hash instead of 64.  A bin's share is bounded by
the number of bins, which grows with the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import durable, shuffle_partitions

#: Tokens that are hashed at once, about: bounds the memory of a task.
CHUNK = 1 << 20
#: Blocks that a task holds before it deals them out.
HELD = 1 << 19
#: Bytes of input files for each bin at most, about.
BIN_BYTES = 4 << 20
#: Windows for each bin of the second round at most, about; they are counted first.
BIN_WINDOWS = 1 << 20
#: Bytes of payload in one record batch, about.
BATCH_BYTES = 8 << 20

_MULT = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit words over all others."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(_MULT)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Powers:
    """The powers of the base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, "u8")

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", _BASE_INV)):
                p = np.full(size, base, "u8")
                p[0] = 1
                setattr(self, name, np.multiply.accumulate(p))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


class Hashed:
    """Hashes of any stretch of a token array."""

    def __init__(self, values: np.ndarray):
        up, self.down = _POWERS.upto(len(values) + 1)
        self.prefix = np.zeros(len(values) + 1, "u8")
        np.cumsum(values * up[: len(values)], out=self.prefix[1:])

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype("u8"))

    def every(self, length: int) -> np.ndarray:
        """The hash of each stretch of ``length`` tokens."""
        p = self.prefix
        return mix((p[length:] - p[:-length]) * self.down[: len(p) - length])


_BYTE_VALUES = mix(np.arange(1, 257, dtype="u8") * np.uint64(0xA0761D6478BD642F))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in ``data`` (bytes; ASCII white space divides)."""
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    turn = np.flatnonzero(gap[1:] != gap[:-1])
    return turn[::2], turn[1::2]


def word_values(data: np.ndarray) -> np.ndarray:
    start, end = word_bounds(data)
    return Hashed(byte_values(data)).span(start, end)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


_PLACE = np.uint64((1 << 24) - 1)


def blocks_of(values: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor, first window, windows, anchor hash, block hash, left and right neighbourhood of each block of one token array."""
    n = len(values)
    if n < width:
        none = np.zeros(0, "i8")
        return none, none, none, none.astype("u8"), none.astype("u8"), none.astype("u2"), none.astype("u2")
    hashed = Hashed(values)
    grams = hashed.every(gram)
    # The least hash, the leftmost of equal ones: a segment has fewer than 2**24 places.
    anchor = (_least((grams & ~_PLACE) | np.arange(len(grams), dtype="u8"), width - gram + 1) & _PLACE).astype("i8")
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    count = np.diff(np.r_[first, len(anchor)])
    at = anchor[first]
    # 16 bits of the half window on either side; 0 where the text has no such half.
    half = (width - gram + 1) // 2
    before, after = np.maximum(at - half, 0), np.minimum(at + gram + half, n)
    left = np.where(at >= half, hashed.span(before, at) % np.uint64(65535) + np.uint64(1), 0).astype("u2")
    right = np.where(at + gram + half <= n, hashed.span(at + gram, after) % np.uint64(65535) + np.uint64(1), 0).astype("u2")
    return at, first, count, grams[at], hashed.span(first, first + count - 1 + width), left, right


def segments(n: int, width: int) -> Iterator[tuple[int, int, int, int]]:
    """(from, to, keep from, keep to): overlapping stretches of a long token array; a block belongs where its anchor is kept."""
    step = 4 * CHUNK
    if n <= step + 4 * width:
        yield 0, n, 0, n
        return
    for a in range(0, n, step):
        b = min(n, a + step)
        yield max(0, a - 2 * width), min(n, b + 2 * width), a, b


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays of one length in one binary: bytes of like weight stand together, which compresses well."""
    n = len(next(iter(arrays.values())))
    raw = b"".join(np.ascontiguousarray(a).view("u1").reshape(n, -1).T.tobytes() for a in arrays.values())
    return np.array([n, len(raw)], "<i8").tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unpack(data: bytes, **kinds: str) -> dict[str, np.ndarray]:
    n, size = (int(x) for x in np.frombuffer(data, "<i8", 2))
    raw, at, out = np.frombuffer(pa.decompress(data[16:], size, "zstd"), "u1"), 0, {}
    for name, kind in kinds.items():
        wide = np.dtype(kind).itemsize
        out[name] = np.ascontiguousarray(raw[at : at + n * wide].reshape(wide, n).T).view(kind).reshape(n)
        at += n * wide
    return out


def unpacked(column: pa.ChunkedArray, **kinds: str) -> dict[str, np.ndarray]:
    parts = [unpack(x.as_py(), **kinds) for x in column]
    return {k: np.concatenate([p.pop(k) for p in parts]) if parts else np.zeros(0, t) for k, t in kinds.items()}


def dealt(bins: np.ndarray, arrays: dict[str, np.ndarray], kind: int) -> Iterator[pa.RecordBatch]:
    """One row (kind, bin, payload) for each bin that has rows, in batches of bounded size."""
    order = np.argsort(bins, kind="stable")
    cut = np.flatnonzero(np.diff(bins[order])) + 1
    rows = np.split(order, cut) if len(order) else []
    at, payload, held = [], [], 0
    for i, r in enumerate(rows):
        at.append(bins[r[0]])
        payload.append(pack(**{k: a[r] for k, a in arrays.items()}))
        held += len(payload[-1])
        if held > BATCH_BYTES or i == len(rows) - 1:
            columns = [pa.array(np.full(len(at), kind, "i4")), pa.array(np.array(at, "i4")), pa.array(payload, pa.binary())]
            yield pa.record_batch(columns, names=["kind", "bin", "payload"])
            at, payload, held = [], [], 0


DEALT = "kind int, bin int, payload binary"
SPANS, ASKED, WINDOWS = 1, 2, 3
#: doc and text_key name a row; text_key is 0 throughout unless ids repeat.  A block's hash has 48 bits: it need only tell apart blocks of one key.
BLOCK = {"lead": "<u8", "key": "<u8", "hash": "<u4", "hash2": "<u2", "doc": "<i8", "text_key": "<u8", "first": "<u4", "count": "<u2", "left": "<u2", "right": "<u2"}
WINDOW = {"hash": "<u8", "doc": "<i8", "text_key": "<u8", "first": "<u4"}
TRACED_WINDOW = {**WINDOW, "more": "<u8"}
#: Tokens or, while asked for, windows from ``first`` on.
SPAN = {"doc": "<i8", "text_key": "<u8", "first": "<u4", "count": "<u4"}
#: Spans as rows: ``bin`` is the home of the document, ``name`` its text_key, ``place`` first * 2**32 + count.
SPAN_ROWS = "kind int, bin int, doc long, name long, place long"
#: Besides, in ``traced`` spans: the least document that has the same tokens, and the first of them there.
TRACE = ", source long, origin long"


def span_table(kind: int, spans: dict[str, np.ndarray], bins: int, traced: bool) -> pa.Table:
    place = (spans["first"].astype("i8") << 32) | spans["count"].astype("i8")
    columns = [np.full(len(place), kind, "i4"), (spans["doc"] % bins).astype("i4"), spans["doc"], spans["text_key"].view("i8"), place]
    names = ["kind", "bin", "doc", "name", "place"]
    if traced:
        columns += [spans["source"].astype("i8"), spans["origin"].astype("i8")]
        names += ["source", "origin"]
    return pa.table([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)


def spans_of(table: pa.Table) -> dict[str, np.ndarray]:
    place = table["place"].to_numpy()
    out = {"doc": table["doc"].to_numpy(), "text_key": table["name"].to_numpy().view("u8"), "first": place >> 32, "count": place & 0xFFFFFFFF}
    return out | {c: table[c].to_numpy() for c in ("source", "origin") if c in table.column_names}


def n_bins(docs: DataFrame) -> int:
    """Bins for the rows of ``docs``: grows with the size of its files.  Odd, and prime as a rule, so that ids with a stride spread."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    n = max(2 * shuffle_partitions(docs.sparkSession), size // BIN_BYTES if size < 1 << 60 else 0) | 1
    while any(n % d == 0 for d in range(3, min(n, 1000), 2)):
        n += 2
    return n


def prepared(docs: DataFrame, id_col: str, text_col: str, bins: int) -> DataFrame:
    """(home, doc, text): null texts are empty; null ids have a home, but take no part."""
    doc = F.col(id_col).cast("long")
    home = F.pmod(F.coalesce(doc, F.lit(0)), F.lit(bins)).cast("int")
    return docs.select(home.alias("home"), doc.alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def ids_repeat(docs: DataFrame, id_col: str) -> bool:
    return not docs.groupBy(id_col).count().filter("count > 1").isEmpty()


def encoded(text: pa.Scalar) -> bytes:
    return text.as_buffer().to_pybytes()


def scan_blocks(docs: DataFrame, tokens_of: Callable, width: int, gram: int, named: bool, bins: int, lead_of: Callable | None = None, bin_of: Callable | None = None) -> DataFrame:
    """Packed blocks of all documents, dealt to bins.

    ``lead_of(bytes, places)`` gives the lead and key of anchors, else the key
    is the hash of the anchor; ``bin_of(lead, key)`` the bin, else the key does.
    """

    def run(batches):
        got, held = {k: [] for k in BLOCK}, 0
        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text")):
                if not doc.is_valid:
                    continue
                data = encoded(text)
                raw = np.frombuffer(data, "u1")
                tokens = tokens_of(raw)
                name = xxhash.xxh3_64_intdigest(data) if named else 0
                for a, b, keep, end in segments(len(tokens), width):
                    found = blocks_of(tokens[a:b], width, gram)
                    if (a, b) != (0, len(tokens)):
                        inside = (found[0] + a >= keep) & (found[0] + a < end)
                        found = tuple(x[inside] for x in found)
                    at, first, count, key, hash_, left, right = found
                    if not len(at):
                        continue
                    lead, key = lead_of(raw, at + a) if lead_of else (np.zeros(len(at), "u8"), key)
                    part = (lead, key, hash_.astype("u4"), (hash_ >> np.uint64(48)).astype("u2"), np.full(len(at), doc.as_py(), "i8"), np.full(len(at), name, "u8"), (first + a).astype("u4"), count.astype("u2"), left, right)
                    for k, x in zip(BLOCK, part):
                        got[k].append(x)
                    held += len(at)
                    if held > HELD:
                        yield from flush(got)
                        got, held = {k: [] for k in BLOCK}, 0
        yield from flush(got)

    def flush(got):
        if got["key"]:
            arrays = {k: np.concatenate(got.pop(k)) for k in BLOCK}  # the parts go one by one
            at = bin_of(arrays["lead"], arrays["key"]) if bin_of else (arrays["key"] % np.uint64(bins)).astype("i8")
            yield from dealt(at, arrays, 0)

    return docs.mapInArrow(run, DEALT)


def runs_of(*columns: np.ndarray) -> np.ndarray:
    """For sorted columns: the number of each row's run of equal rows."""
    new = np.zeros(len(columns[0]), "i8")
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


def head_of(run: np.ndarray) -> np.ndarray:
    """The place of the first row of each row's run: that of least document where rows are sorted by it last."""
    return np.searchsorted(run, run, "left")


def _disputed(anchor: np.ndarray, side: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Rows whose anchor and side, if it has one, another document has too."""
    by = np.lexsort((doc, side, anchor))
    run = runs_of(anchor[by], side[by])
    out = np.zeros(len(by), bool)
    if len(by):
        starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        out[by] = ((np.minimum.reduceat(doc[by], starts) < np.maximum.reduceat(doc[by], starts))[run]) & (side[by] > 0)
    return out


def compare_blocks(blocks: DataFrame, width: int, bins: int, order: Callable, traced: bool) -> DataFrame:
    """Spans of the blocks that an earlier document holds, and the blocks whose windows must be asked for.

    ``order(arrays)`` sorts a bin's blocks by lead, key, hash and document.
    """

    def run(table):
        got = unpacked(table["payload"], **BLOCK)
        got["hash"] = got["hash"].astype("u8") | (got.pop("hash2").astype("u8") << np.uint64(48))
        by = order(got)
        got = {k: x[by] for k, x in got.items()}
        anchor = runs_of(got["lead"], got["key"])
        block = runs_of(anchor, got["hash"])
        head = head_of(block)
        again = got["doc"] > got["doc"][head]
        out = {k: got[k] for k in SPAN} | {"source": got["doc"][head], "origin": got["first"][head]}
        out["count"] = out["count"].astype("u4")
        spans = {k: x[again] for k, x in out.items()}
        spans["count"] = spans["count"] + np.uint32(width - 1)
        # An anchor in unlike blocks of unlike documents that agree on one side: their first holders show their windows.
        holder = np.flatnonzero(~again)
        mixed = np.zeros(len(holder), bool)
        for side in ("left", "right"):
            mixed |= _disputed(anchor[holder], got[side][holder], got["doc"][holder])
        asked = {k: x[holder[mixed]] for k, x in out.items()}
        return pa.concat_tables([span_table(SPANS, spans, bins, traced), span_table(ASKED, asked, bins, traced)])

    return blocks.groupBy("bin").applyInArrow(run, SPAN_ROWS + TRACE * traced)


_DEALT_SCHEMA = pa.schema([("kind", pa.int32()), ("bin", pa.int32()), ("payload", pa.binary())])


def stretches(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each stretch, one after another."""
    total = int(count.sum())
    skip = np.repeat(first - np.r_[0, np.cumsum(count)[:-1]], count)
    return skip + np.arange(total)


def _of_rows(spans: dict[str, np.ndarray]) -> dict[tuple[int, int], np.ndarray]:
    """The places of each row's spans, by (doc, text_key)."""
    by = np.lexsort((spans["first"], spans["text_key"], spans["doc"]))
    run = runs_of(spans["doc"][by], spans["text_key"][by])
    parts = np.split(by, np.flatnonzero(np.diff(run)) + 1) if len(by) else []
    return {(int(spans["doc"][p[0]]), int(spans["text_key"][p[0]])): p for p in parts}


def compare_windows(docs: DataFrame, found: DataFrame, tokens_of: Callable, width: int, named: bool, bins: int, traced: bool) -> DataFrame:
    """Spans of the windows asked for that start in an earlier document too."""
    window = TRACED_WINDOW if traced else WINDOW
    asked = found.filter(f"kind = {ASKED}").withColumn("home", F.col("bin"))
    total = asked.agg(F.sum(F.col("place").bitwiseAND(0xFFFFFFFF))).first()[0] or 0
    window_bins = max(bins // 4, total // BIN_WINDOWS) + 1

    def show(left, right):
        asked = spans_of(right)
        rows, got = _of_rows(asked), {k: [] for k in window}
        docs_asked = {d for d, _ in rows}
        for doc, text in zip(left["doc"], left["text"]):
            if doc.as_py() not in docs_asked:
                continue
            data = encoded(text)
            name = xxhash.xxh3_64_intdigest(data) if named else 0
            at = rows.get((doc.as_py(), name))
            if at is None:
                continue
            place = stretches(asked["first"][at], asked["count"][at])
            tokens = tokens_of(np.frombuffer(data, "u1"))
            hashes = np.concatenate([_window_hashes(tokens, p, width) for p in np.array_split(place, 1 + len(place) // CHUNK)])
            part = [hashes, np.full(len(place), doc.as_py(), "i8"), np.full(len(place), name, "u8"), place.astype("u4")]
            if traced:
                other = mix(tokens ^ np.uint64(_MULT))
                part.append(np.concatenate([_window_hashes(other, p, width) for p in np.array_split(place, 1 + len(place) // CHUNK)]))
            for k, x in zip(window, part):
                got[k].append(x)
        arrays = {k: np.concatenate(x) if x else np.zeros(0, window[k]) for k, x in got.items()}
        at = (arrays["hash"] % np.uint64(window_bins)).astype("i8")
        return pa.Table.from_batches(list(dealt(at, arrays, WINDOWS)), _DEALT_SCHEMA)

    def meet(table):
        got = unpacked(table["payload"], **window)
        more = got.pop("more", got["hash"])
        by = np.lexsort((got["doc"], more, got["hash"]))
        got = {k: x[by] for k, x in got.items()}
        head = head_of(runs_of(got["hash"], more[by]))
        again = got["doc"] > got["doc"][head]
        source, origin = got["doc"][head][again], got["first"][head][again].astype("i8")
        doc, name, first = (got[k][again] for k in ("doc", "text_key", "first"))
        first = first.astype("i8")
        # Windows side by side become one span; a traced one ends where its source leaves its course.
        apart = (source, first - origin) if traced else ()
        by = np.lexsort((first, *reversed(apart), name, doc))
        doc, name, first, source, origin = (x[by] for x in (doc, name, first, source, origin))
        new = (doc[1:] != doc[:-1]) | (name[1:] != name[:-1]) | (first[1:] - first[:-1] > width)
        for x in apart:
            new |= x[by][1:] != x[by][:-1]
        start = np.flatnonzero(np.r_[True, new][: len(doc)])
        last = np.r_[start[1:], len(doc)][: len(start)] - 1
        spans = {"doc": doc[start], "text_key": name[start], "first": first[start], "count": first[last] + width - first[start]}
        return span_table(SPANS, spans | {"source": source[start], "origin": origin[start]}, bins, traced)

    shown = docs.groupBy("home").cogroup(asked.groupBy("home")).applyInArrow(show, DEALT)
    return shown.groupBy("bin").applyInArrow(meet, SPAN_ROWS + TRACE * traced)


def _window_hashes(tokens: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    if not len(place):
        return np.zeros(0, "u8")
    a, b = int(place[0]), int(place[-1]) + width
    if b - a <= 8 * CHUNK:
        return Hashed(tokens[a:b]).span(place - a, place - a + width)
    half = len(place) // 2
    return np.concatenate([_window_hashes(tokens, place[:half], width), _window_hashes(tokens, place[half:], width)])


def covered(n: int, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which of ``n`` tokens the spans cover."""
    step = np.zeros(n + 1, "i4")
    np.add.at(step, first, 1)
    np.add.at(step, first + count, -1)
    return np.cumsum(step[:-1]) > 0


def apply_spans(docs: DataFrame, spans: DataFrame, named: bool, make: Callable, fields: str) -> DataFrame:
    """``make(rows)`` of each bin's rows (doc, bytes, arrays of their spans): a table of results."""

    def run(left, right):
        got = spans_of(right)
        rows = _of_rows(got)
        arrays = {k: x for k, x in got.items() if k not in ("doc", "text_key")}
        none = np.zeros(0, "i8")

        def each():
            for doc, text in zip(left["doc"], left["text"]):
                data = encoded(text)
                at = rows.get((doc.as_py(), xxhash.xxh3_64_intdigest(data) if named else 0))
                some = at is not None and doc.is_valid
                yield doc.as_py(), data, {k: x[at] if some else none for k, x in arrays.items()}

        return make(each())

    homes = spans.withColumn("home", F.col("bin"))
    return docs.groupBy("home").cogroup(homes.groupBy("home")).applyInArrow(run, fields)


def repeated(
    docs: DataFrame, id_col: str, text_col: str, tokens_of: Callable, width: int, gram: int, order: Callable, lead_of=None, bin_of=None, traced: bool = False
) -> tuple[DataFrame, DataFrame, bool]:
    """The prepared rows, the spans of their repeats and whether rows are named by text too."""
    bins, named = n_bins(docs), ids_repeat(docs, id_col)
    rows = prepared(docs, id_col, text_col, bins)
    blocks = scan_blocks(rows, tokens_of, width, gram, named, bins, lead_of, bin_of)
    found = durable(compare_blocks(blocks, width, bins, order, traced), "repeats")
    spans = found.filter(f"kind = {SPANS}").unionByName(compare_windows(rows, found, tokens_of, width, named, bins, traced))
    return rows, spans, named
