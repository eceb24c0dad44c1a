"""N-gram Jaccard join by parity sketches, and the components of its links.

A document's set holds its distinct five-word shingles.  Its sketch has as many
lanes as its size band asks for; every shingle is XORed, as a 64-bit hash, into
the lane that its hash names.  A shingle that only one of two documents has can
spoil one lane, so the number of unequal lanes never exceeds the symmetric
difference of the sets: with at most ``d`` shingles apart and ``P`` lanes, at
least ``P - d`` lanes are equal.  Two sets of sizes a and b and a similarity of
3/4 or more are at most ``(a + b) / 7`` apart.

Hence the join: a document may leave out ``P - d - 1`` of its lanes and still
shares one with each partner.  All leave out first the empty lanes, then the most
frequent ones, then those with the fewest shingles, and of equals those of least
hash; since equal lanes rank alike, the rarest lane that a pair shares is kept by
both.  There are about twice as many lanes as a document keeps, so one that half
consists of passages which many documents share can leave all of them out.  A
document joins in the band of its size and, as the smaller side, in the next:
bands are a factor of 4/3 wide, so partners always meet in the band of the
larger one.

Lanes of equal hash make candidate pairs.  A pair goes on only if the parity
sketches of its sets, in which every shingle flips one bit, lie within the same
bound of each other; what is left is verified on the full sets of 64-bit
shingles.  Copies (equal sets) count as one.  Of a lane that several documents
share first only the pairs with its smallest id are verified, which settles groups
of near copies.  Once the components of those links are known, the lanes that
still hold several components are compared sketch by sketch where they lie, in
tiles; only pairs of different components and near sketches ever become rows.  So
no link between components is missed, and no group is expanded into pairs.

Defined cases: ids are integers; a null or empty text, or one of white space, has no shingles and
is its own component; with fewer than five words the sequence is one shingle;
rows that share an id are one node; null ids stay null; an empty table gives an
empty table; other columns are ignored by the report and carried by
``one_of_each``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import durable, forget
from .repeats import Hashed, byte_values, dealt, encoded, mix, n_bins, pack, runs_of, stretches, unpack, unpacked, word_bounds

SHINGLE = 5
#: Two sets link when 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
#: One in so many documents is looked at for frequent lanes; different sets of these that must share one; lanes named at most.
LOOK, FREQUENT, NAMED = 8, 3, 1 << 20
#: Members of a lane that are compared at once: a larger lane is dealt out as pairs of tiles.
TILE = 2048
#: Pairs of ids, 16 bytes each, that may be broadcast.
BROADCAST_ROWS = 1 << 20

_LOWER = np.arange(256, dtype="u1")
_LOWER[65:91] += 32
LANE = {"hash": "<u4", "hash2": "<u2", "doc": "<i8"}
#: Hashes of frequent lanes, ascending, and how frequent each is (the logarithm of its count).
Frequent = tuple[np.ndarray, np.ndarray]
_DEALT = "kind int, bin int, payload binary"


def shingles(data: bytes, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    raw = _LOWER[np.frombuffer(data, "u1")]
    start, end = word_bounds(raw)
    if not len(start):
        return np.zeros(0, "u8")
    words = Hashed(byte_values(raw)).span(start, end)
    if len(words) < width:
        return Hashed(words).span(np.array([0]), np.array([len(words)]))
    return np.unique(Hashed(words).every(width))


@functools.lru_cache(maxsize=None)
def band_start(band: int) -> int:
    return 1 if band == 0 else max(band_start(band - 1) + 1, -(-band_start(band - 1) * 4 // 3))


def band_of(size: int) -> int:
    band = 0
    while band_start(band + 1) <= size:
        band += 1
    return band


@functools.lru_cache(maxsize=None)
def lanes_of_band(band: int) -> int:
    """Twice as many as the most that two sets of the band differ by, and some: one half of them may be left out."""
    most = 2 * (band_start(band + 1) - 1) // 7
    return 2 * (most + 1) + 4


def _short(hashes: np.ndarray) -> np.ndarray:
    """The 48 bits of lane hashes that travel."""
    return hashes & np.uint64(0xFFFF0000FFFFFFFF)


def lanes_in(tokens: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of shingles of each lane that a set has in a band."""
    lanes = lanes_of_band(band)
    lane = (tokens % np.uint64(lanes)).astype("i8")
    count = np.bincount(lane, minlength=lanes)
    order = np.argsort(lane, kind="stable")
    sketch = np.zeros(lanes, "u8")
    full = np.flatnonzero(count)
    sketch[full] = np.bitwise_xor.reduceat(mix(tokens[order]), np.r_[0, np.cumsum(count[full])[:-1]])
    return _short(mix(sketch ^ mix(np.arange(lanes, dtype="u8") + np.uint64(lanes << 32)))), count


_NO_FREQUENT: Frequent = (np.zeros(0, "u8"), np.zeros(0, "u1"))


def kept_lanes(tokens: np.ndarray, band: int, apart: int, frequent: Frequent) -> np.ndarray:
    """The hashes of the ``apart + 1`` lanes that a document joins with in a band."""
    hashes, count = lanes_in(tokens, band)
    often = np.zeros(len(hashes), "i8")
    names, grade = frequent
    if len(names):
        at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
        often = np.where(names[at] == hashes, grade[at], 0).astype("i8")
    often[count == 0] = 256
    rank = np.lexsort((hashes, np.minimum(count, 3), -often))
    return hashes[rank[len(hashes) - min(len(hashes), apart + 1) :]]


_NONE = np.zeros(0, "u8")


def joins_of(n: int) -> list[tuple[int, int]]:
    """(band, most shingles apart) that a set of ``n`` joins in; none where only equal sets can link."""
    if not n:
        return []
    band, largest, out = band_of(n), 4 * n // 3, []
    apart = (n + min(largest, band_start(band + 1) - 1)) // 7
    if apart:
        out.append((band, apart))
    if largest >= band_start(band + 1):
        out.append((band + 1, (n + largest) // 7))
    return out


def signatures(tokens: np.ndarray, frequent: Frequent = _NO_FREQUENT) -> np.ndarray:
    """All lane hashes that a set joins with."""
    out = [kept_lanes(tokens, band, apart, frequent) for band, apart in joins_of(len(tokens))]
    return np.concatenate(out) if out else _NONE


def all_lanes(tokens: np.ndarray) -> np.ndarray:
    """The hashes of all lanes that hold a shingle."""
    out = [h[c > 0] for h, c in (lanes_in(tokens, band) for band, _ in joins_of(len(tokens)))]
    return np.concatenate(out) if out else _NONE


def parity_sketch(tokens: np.ndarray) -> bytes:
    """A power of two of bits, two for each shingle or more, in which each shingle has flipped one."""
    bits = 512
    while bits < 2 * len(tokens):
        bits *= 2
    return np.packbits(np.bincount((tokens & np.uint64(bits - 1)).astype("i8"), minlength=bits) & 1 == 1).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Unequal bits of two parity sketches, the longer one folded: never more than the symmetric difference."""
    x, y = np.frombuffer(a, "u1"), np.frombuffer(b, "u1")
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def packed_set(tokens: np.ndarray) -> bytes:
    """A sorted set of 64-bit shingles as the gaps between them."""
    return pack(gap=np.diff(tokens, prepend=np.uint64(0)))


def unpacked_set(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, gap="<u8")["gap"], dtype="u8")


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    """Whether two sorted sets link."""
    if 100 * min(len(a), len(b)) < threshold * max(len(a), len(b)):
        return False
    both = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * both >= threshold * (len(a) + len(b) - both)


def _set_key(tokens: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int((np.sum(mix(tokens)) ^ np.bitwise_xor.reduce(mix(~tokens)) if len(tokens) else np.uint64(0)).astype("i8"))


def _scan(docs: DataFrame) -> DataFrame:
    """(doc, n, key, sketch): size, key and parity sketch of every document's set."""

    def run(batches):
        for batch in batches:
            sets = [shingles(encoded(t)) for t in batch.column("text")]
            n = pa.array([len(s) for s in sets], pa.int64())
            key, sketch = pa.array([_set_key(s) for s in sets], pa.int64()), pa.array([parity_sketch(s) for s in sets], pa.binary())
            yield pa.record_batch([batch.column("doc"), n, key, sketch], names=["doc", "n", "key", "sketch"])

    return docs.mapInArrow(run, "doc long, n long, key long, sketch binary")


def _lanes(docs: DataFrame, bins: int, lanes_of: Callable, by_set: bool = False) -> DataFrame:
    """The lanes that ``lanes_of`` names for the sets of all documents, packed and dealt out by hash.

    They carry the document or, ``by_set``, the key of its set.
    """

    def flush(got, ids):
        if got:
            hashes = np.concatenate(got)
            doc = np.repeat(np.array(ids, "i8"), [len(x) for x in got])
            arrays = {"hash": hashes.astype("u4"), "hash2": (hashes >> np.uint64(48)).astype("u2"), "doc": doc}
            yield from dealt((hashes % np.uint64(bins)).astype("i8"), arrays, 0)

    def run(batches):
        got, ids, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text")):
                if not doc.is_valid:
                    continue
                tokens = shingles(encoded(text))
                got.append(lanes_of(tokens))
                ids.append(_set_key(tokens) if by_set else doc.as_py())
                held += len(got[-1])
                if held > 1 << 20:
                    yield from flush(got, ids)
                    got, ids, held = [], [], 0
        yield from flush(got, ids)

    return docs.mapInArrow(run, _DEALT)


def _frequent(docs: DataFrame, bins: int) -> Frequent:
    """The lanes that ``FREQUENT`` or more different sets of the documents looked at share.

    Each bin names at most its share of ``NAMED``, its most frequent ones, so what
    the driver collects never exceeds ``NAMED`` lanes, whatever the input.
    """
    some = docs.filter(F.pmod(F.xxhash64("doc", F.lit(11)), F.lit(LOOK)) == 0)
    share = max(1, NAMED // bins)

    def run(table):
        got = unpacked(table["payload"], **LANE)
        hashes = got["hash"].astype("u8") | (got["hash2"].astype("u8") << np.uint64(48))
        by = np.lexsort((got["doc"], hashes))
        hashes, sets = hashes[by], got["doc"][by]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (sets[1:] != sets[:-1])
        hashes, count = np.unique(hashes[new], return_counts=True)
        top = np.lexsort((hashes, -count))[:share]
        top = top[count[top] >= FREQUENT]
        return pa.table([pa.array(hashes[top].view("i8")), pa.array(count[top].astype("i8"))], names=["lane", "n"])

    found = _lanes(some, bins, all_lanes, by_set=True).groupBy("bin").applyInArrow(run, "lane long, n long").toArrow()
    names, count = (found[c].to_numpy() for c in ("lane", "n"))
    by = np.argsort(names.view("u8"))
    return names.view("u8")[by], np.minimum(np.log2(np.maximum(count[by], 1)) * 4, 255).astype("u1")


def _candidates(lanes: DataFrame) -> DataFrame:
    """(kind, a, b): pairs of a lane's least id a with another b (kind 0), and the members b of groups a of three or more (kind 1).

    Lanes with the same members are one group.
    """
    schema = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64())])

    def run(table):
        got = unpacked(table["payload"], **LANE)
        hashes = got["hash"].astype("u8") | (got["hash2"].astype("u8") << np.uint64(48))
        order = np.lexsort((got["doc"], hashes))
        hashes, doc = hashes[order], got["doc"][order]
        new = np.ones(len(doc), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[new], doc[new]
        lane = runs_of(hashes)
        shared = np.bincount(lane)[lane] > 1 if len(lane) else new
        lane, doc = lane[shared], doc[shared]
        if not len(lane):
            return schema.empty_table()
        first = np.flatnonzero(np.r_[True, lane[1:] != lane[:-1]])
        size = np.diff(np.r_[first, len(lane)])
        # One lane stands for all that have its members.
        _, keep = np.unique(np.add.reduceat(mix(doc.view("u8")), first) ^ mix(size.astype("u8")), return_index=True)
        members = stretches(first[keep], size[keep])
        head, doc = np.repeat(doc[first[keep]], size[keep]), doc[members]
        group = np.repeat((np.add.reduceat(mix(doc.view("u8")), np.r_[0, np.cumsum(size[keep])[:-1]])).view("i8"), size[keep])
        pairs = np.unique(np.stack([head[head < doc], doc[head < doc]]), axis=1)
        big = np.repeat(size[keep] > 2, size[keep])
        a, b = np.r_[pairs[0], group[big]], np.r_[pairs[1], doc[big]]
        kind = np.r_[np.zeros(pairs.shape[1], "i4"), np.ones(int(big.sum()), "i4")]
        return pa.table([pa.array(kind), pa.array(a), pa.array(b)], schema=schema)

    return lanes.groupBy("bin").applyInArrow(run, "kind int, a long, b long")


def _near(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose parity sketches are no further apart than a link allows."""
    side = lambda c: sets.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))

    def run(batches):
        for batch in batches:
            most = (batch.column("na").to_numpy() + batch.column("nb").to_numpy()) // 7
            apart = [sketch_distance(x.as_py(), y.as_py()) for x, y in zip(batch.column("sa"), batch.column("sb"))]
            yield batch.select(["a", "b"]).filter(pa.array(np.array(apart, "i8") <= most))

    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")
    return met.mapInArrow(run, "a long, b long").distinct()


def folded(sketches: list[bytes], size: int) -> np.ndarray:
    """Sketches folded to ``size`` bytes, a row each."""
    out = np.zeros((len(sketches), size), "u1")
    for k, s in enumerate(sketches):
        out[k] = np.bitwise_xor.reduce(np.frombuffer(s, "u1").reshape(-1, size))
    return out.view("u8")


def near_pairs(group: np.ndarray, tile: np.ndarray, whole: np.ndarray, node: np.ndarray, root: np.ndarray, n: np.ndarray, sketch: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes (a, b) of rows of one group that have unequal roots and near sketches.

    In a group that isn't ``whole`` only rows of unlike tiles meet.  Partners are
    sought among the rows of like size, ``TILE`` squared comparisons at a time.
    """
    by = np.lexsort((n, group))
    group, tile, whole, node, root, n = (x[by] for x in (group, tile, whole, node, root, n))
    sketch = [sketch[k] for k in by]
    wide = np.array([len(s) for s in sketch], "i8")
    place = group.astype("i8") << 40
    first = np.arange(1, len(n) + 1)
    count = np.searchsorted(place + n, place + 4 * n // 3, "right") - first
    flat = {}
    for size in np.unique(wide).tolist():  # sets of like size have sketches of one size or of the next
        at = np.flatnonzero((wide == size) | (wide == 2 * size))
        row = np.zeros(len(n), "i8")
        row[at] = np.arange(len(at))
        flat[size] = row, folded([sketch[k] for k in at], size)
    found = [np.zeros((2, 0), "i8")]
    ends = np.cumsum(count)
    for chunk in np.split(np.arange(len(n)), np.flatnonzero(np.diff(ends // (TILE * TILE))) + 1):
        x, y = np.repeat(chunk, count[chunk]), stretches(first[chunk], count[chunk])
        meet = (root[x] != root[y]) & (node[x] != node[y]) & (whole[x] | (tile[x] != tile[y]))
        x, y = x[meet], y[meet]
        low = np.minimum(wide[x], wide[y])
        for size in np.unique(low).tolist():
            at = np.flatnonzero(low == size)
            row, bits = flat[size]
            for part in np.array_split(at, 1 + len(at) * size // (32 << 20)):
                i, j = x[part], y[part]
                apart = np.bitwise_count(bits[row[i]] ^ bits[row[j]]).sum(axis=1, dtype="i8")
                near = apart <= (n[i] + n[j]) // 7
                found.append(np.stack([node[i[near]], node[j[near]]]))
    pairs = np.concatenate(found, axis=1)
    return tuple(np.unique(np.sort(pairs, axis=0), axis=1))


def _across(crowd: DataFrame, sets: DataFrame, bins: int) -> DataFrame:
    """The pairs (a, b) of nodes that share a lane of ``crowd`` (lane, node, root, head, m), but no root, and have near sketches.

    A lane of more than ``TILE`` members is dealt out as pairs of tiles.
    """
    # A lane's head has been tried with every other member.
    rows = crowd.filter("node != head").withColumn("k", F.ceil(F.col("m") / TILE).cast("int"))
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    rows = rows.select("lane", "node", "root", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    rows = rows.withColumn("bin", F.pmod(F.xxhash64("lane", "i", "j"), F.lit(bins)).cast("int"))
    rows = rows.join(sets.select(F.col("doc").alias("node"), "n", "sketch"), "node")

    def run(table):
        lane, i, j, tile, node, root, n = (table[c].to_numpy() for c in ("lane", "i", "j", "tile", "node", "root", "n"))
        by = np.lexsort((j, i, lane))
        group = np.zeros(len(by), "i8")
        group[by] = runs_of(lane[by], i[by], j[by])
        a, b = near_pairs(group, tile, i == j, node, root, n, table["sketch"].to_pylist())
        return pa.table([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows.groupBy("bin").applyInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, threshold: int) -> DataFrame:
    """The written pairs (a, b) that link, by the full sets of both.

    A set is made once for each document that stands in a pair.  The ids of few
    pairs go to where the texts are; more than that meet the texts in a shuffle.
    """
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct()
    if pairs.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)

    def run(batches):
        for batch in batches:
            sets = [packed_set(shingles(encoded(t))) for t in batch.column("text")]
            yield pa.record_batch([batch.column("doc"), pa.array(sets, pa.binary())], names=["doc", "tokens"])

    sets = durable(docs.join(ids, "doc").select("doc", "text").mapInArrow(run, "doc long, tokens binary"), "tokens")
    side = lambda c, name: sets.select(F.col("doc").alias(c), F.col("tokens").alias(name))

    def check(batches):
        for batch in batches:
            keep = [
                linked(unpacked_set(x.as_py()), unpacked_set(y.as_py()), threshold)
                for x, y in zip(batch.column("left"), batch.column("right"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(side("a", "left"), "a").join(side("b", "right"), "b").select("a", "b", "left", "right")
    links = durable(met.mapInArrow(check, "a long, b long").distinct(), "links")
    forget(sets)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) reaches; roots themselves are left out.

    Alternating large and small stars: each round points every node's greater
    neighbours, then its lesser ones, at the least of them.  The rounds grow
    with the logarithm of the longest path; each ends in the shared folder.
    """
    edges = durable(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        old, edges = edges, durable(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).filter("u != v").distinct(), "edges")
        forget(old)
        now = mark(edges)
        if now == before:
            roots = durable(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")), "roots")
            forget(edges)
            return roots
        before = now


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """id, n_shingles, component_id of every document.  ``threshold`` is 75 or more."""
    if threshold < 75:
        raise ValueError("lanes are dealt out for a similarity of 0.75 or more")
    kind, bins = docs.schema[id_col].dataType.simpleString(), n_bins(docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sets = durable(_scan(rows), "sets")
    # Only groups of several documents need a lookup.  Written first, so that a hot group's rows can be split in the join.
    reps = sets.filter("n > 0").groupBy("n", "key").agg(F.min("doc").alias("rep"), F.count("*").alias("c")).filter("c > 1")
    reps = durable(reps.select("n", "key", "rep"), "reps")
    member = durable(sets.select("doc", "n", "key").join(reps, ["n", "key"], "left").select("doc", "n", F.coalesce("rep", "doc").alias("rep")), "member")
    frequent = docs.sparkSession.sparkContext.broadcast(_frequent(rows, bins))  # NAMED lanes at most
    found = durable(_candidates(_lanes(rows, bins, lambda tokens: signatures(tokens, frequent.value))), "candidates")

    full = sets.filter("n > 0").select("doc", "n", "sketch")
    of = member.filter("doc is not null and n > 0").distinct()

    def of_reps(pairs: DataFrame) -> DataFrame:
        """Pairs of documents as pairs of representatives whose sizes allow a link."""
        a = of.select(F.col("doc").alias("a"), F.col("rep").alias("ra"), F.col("n").alias("na"))
        b = of.select(F.col("doc").alias("b"), F.col("rep").alias("rb"), F.col("n").alias("nb"))
        near = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * threshold
        return (
            pairs.select("a", "b").distinct().join(a, "a").join(b, "b").filter(near & (F.col("ra") != F.col("rb")))
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        )

    tried = durable(_near(of_reps(found.filter("kind = 0")), full), "tried")
    found_links = _verified(tried, rows, threshold)
    # Rows that share an id are one node: the representatives of their texts are linked.
    lead = of.groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).filter("a < z").select("doc", "a")
    links = durable(found_links.unionByName(of.join(lead, "doc").filter("rep != a").select("a", F.col("rep").alias("b"))), "links")
    roots = components(links)
    # Lanes of several documents whose members lie in several components.
    crowd = found.filter("kind = 1").select(F.col("a").alias("lane"), F.col("b").alias("doc"))
    crowd = crowd.join(of, "doc").select("lane", F.col("rep").alias("node")).distinct().join(roots, "node", "left")
    crowd = durable(crowd.withColumn("root", F.coalesce("root", "node")), "crowd")
    mixed = crowd.groupBy("lane").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("node").alias("head"), F.count("*").alias("m"))
    mixed = durable(mixed.filter("lo != hi").select("lane", "head", "m"), "mixed")
    across = durable(_across(crowd.join(mixed, "lane"), full, bins).join(tried, ["a", "b"], "left_anti"), "across")
    more = _verified(across, rows, threshold)
    done = [found, crowd, mixed, across, tried]
    if not more.isEmpty():
        done.append(roots)
        roots = components(links.unionByName(more))
    forget(*done, sets, reps, found_links, links, more)
    out = member.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select(
        F.col("doc").cast(kind).alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("root", "rep").cast(kind).alias("component_id")
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does, with all columns.

    Rows whose id is null stay; so does every row that has the id that stays.
    """
    found = jaccard_components(docs, id_col, text_col, threshold)
    gone = found.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["gone"], "left_anti")
