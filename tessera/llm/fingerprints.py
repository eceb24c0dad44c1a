"""Document fingerprints by consistent weighted sampling (DataFrame operations only).

A document is a bag of words, a word being what stands between white space,
weighed by its occurrences.  For each of ``samples`` sample numbers every word
draws, from a hash of itself and the number, ``r, c ~ Gamma(2, 1)`` and ``b ~
U(0, 1)``; with ``t = floor(ln w / r + b)`` its score is ``ln c - r (t - b + 1)``,
and the word of least score is the sample, together with its ``t``.  Two documents
agree on a sample with probability equal to the generalised Jaccard similarity of
their bags, the sum of the lesser weights over the sum of the greater ones.

The draws do not depend on the weight: versions of a text are sampled together,
and a word in several of them draws once.

Few draws can win.  The exponential of a score is at least ``(1 - e^-c) e^-r``
over the weight, and closer still for a word that occurs once, which takes no
logarithm; the least of a bag of total weight W exceeds ``BEYOND / W`` with a
probability of ``e^-BEYOND``, about that of two samples sharing their 32 bits.
Draws whose bound lies above that are left out before any logarithm is taken and
before any row is grouped; a bag whose every draw was left out has sample 0 there.

A sample is kept as 32 hash bits of (word, t).  A score is held in the upper 31
bits of a long and the sample in the lower 32, so that one ``min`` of longs for
each sample finds both, inside generated code, with partial aggregation.

Defined cases: ids are integers; null texts are empty; a text without words has the fingerprint of
the empty bag, equal to that of any other such text; rows that repeat an id are
documents of their own, ordered by text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SPACE, ranges, with_neighbours

SAMPLES = 64
#: A bag's least score lies above ln(BEYOND / weight of the bag) with a probability of e^-BEYOND.
BEYOND = 16


def _scores(rows: DataFrame, versions: int) -> DataFrame:
    """From rows (..., term, sample, bound, once, lnw0, ...): s0, s1, ..., the packed score and sample of (term, lnw0), ...; null where lnw is.

    Rows that can't be their bag's least are left out.
    """
    # Uniform numbers between 0 and 1 from 21 and from 32 bits of a hash.
    low = lambda h, at: f"(((shiftrightunsigned({h}, {at}) & 2097151L) + 0.5D) * {2.0**-21!r}D)"
    half = lambda h, at: f"(((shiftrightunsigned({h}, {at}) & 4294967295L) + 0.5D) * {2.0**-32!r}D)"
    # The partition's number keeps the optimizer from moving the filter below the hashes, where each would be computed several times.
    hashes = {"h": F.expr("xxhash64(term ^ sample)"), "g": F.expr("xxhash64(sample, term)"), "here": F.spark_partition_id()}
    factors = {"z": F.expr(f"{low('h', 0)} * {low('h', 21)}"), "y": F.expr(f"{half('g', 0)} * {half('g', 32)}"), "b": F.expr(low("h", 42)), "here": F.spark_partition_id()}
    # exp(-r s) is at least z / (s + (1 - s) z), where s is 1 - b for a word that occurs once, else 1 and a lower bound.
    stage = rows.withColumns(hashes).withColumns(factors)
    stage = stage.filter("here >= 0 and (1D - y) * z <= bound * (1D - b * once * (1D - z))")
    stage = stage.withColumns({"r": F.expr("-ln(z)"), "c": F.expr("ln(-ln(y))")})
    stage = stage.withColumns({f"t{v}": F.expr(f"floor(lnw{v} / r + b)") for v in range(versions)})
    # Scores lie well inside -512..512; 2**21 steps to one.
    packed = {
        f"s{v}": F.expr(
            f"if(lnw{v} is null, null, shiftleft(cast((greatest(least(c - r * (t{v} - b + 1D), 511D), -511D) + 512D) * 2097152D as bigint), 32)"
            f" | ((term ^ shiftleft(t{v}, 20) ^ t{v}) & 4294967295L))"
        )
        for v in range(versions)
    }
    return stage.withColumns(packed)


def fingerprints(bags: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """(keys, fp): for rows (keys, phrases) the array of samples, as longs below 2**32; phrases is an array of strings, the terms.

    ``bags`` should be dealt out by a subset of ``keys``; the aggregations then
    run where the rows are.
    """
    return version_fingerprints(bags.withColumn("phrases", F.array("phrases")), keys, 1, samples).withColumnRenamed("fp0", "fp")


def version_fingerprints(bags: DataFrame, keys: list[str], versions: int, samples: int = SAMPLES) -> DataFrame:
    """(keys, fp0, fp1, ...): as :func:`fingerprints`, for rows (keys, phrases) whose phrases hold an array of strings for each version; a null one has no fingerprint."""
    # The empty bag holds the empty phrase, which no other has.
    full = F.transform("phrases", lambda x: F.when(F.size(x) > 0, x).when(x.isNotNull(), F.array(F.lit(""))))
    totals = {f"n{v}": F.greatest(F.size(F.col("phrases")[v]), F.lit(1)) for v in range(versions)}
    terms = bags.select(*keys, *[n.alias(c) for c, n in totals.items()], F.posexplode(full).alias("version", "bag"))
    terms = terms.select(*keys, *totals, "version", F.explode("bag").alias("phrase"))
    terms = terms.select(*keys, *totals, "version", F.xxhash64("phrase").alias("term"))
    weights = [F.count_if(F.col("version") == v).alias(f"w{v}") for v in range(versions)]
    terms = terms.groupBy(*keys, "term").agg(*weights, *[F.first(n).alias(n) for n in totals])
    # A word that a version lacks has the null logarithm there.
    logs = {f"lnw{v}": F.when(F.col(f"w{v}") > 0, F.ln(F.col(f"w{v}").cast("double"))) for v in range(versions)}
    share = [F.col(f"w{v}") * float(BEYOND) / F.col(f"n{v}") for v in range(versions)]
    most = [F.col(f"w{v}") for v in range(versions)]
    bound = F.greatest(*share, F.lit(0.0)) * (1 + 1e-9)
    once = (F.greatest(*most, F.lit(0)) <= 1).cast("double")
    rows = terms.select(*keys, "term", bound.alias("bound"), once.alias("once"), *[x.alias(c) for c, x in logs.items()])
    rows = rows.withColumn("sample", F.explode(F.array(*[F.xxhash64(F.lit(k)) for k in range(samples)])))
    least = _scores(rows, versions).groupBy(*keys, "sample").agg(*[F.min(f"s{v}").alias(f"s{v}") for v in range(versions)])
    lows = [F.col(f"s{v}").bitwiseAND(F.lit(0xFFFFFFFF)).alias(f"low{v}") for v in range(versions)]
    gathered = least.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("sample", *lows))).alias("got"))
    # Samples in the order of their hashes; where one is missing, which hardly ever happens, its place is found by the hash.
    places = F.sort_array(F.array(*[F.xxhash64(F.lit(k)) for k in range(samples)]))

    def print_of(v: int) -> Column:
        found = F.col(f"got.low{v}")
        by_hash = F.map_from_arrays(F.col("got.sample"), found)
        whole = F.when(F.size("got") == samples, found).otherwise(F.transform(places, lambda k: F.try_element_at(by_hash, k)))
        return F.when(F.exists(found, lambda x: x.isNotNull()), F.transform(whole, lambda x: F.coalesce(x, F.lit(0))))

    return gathered.select(*keys, *[print_of(v).alias(f"fp{v}") for v in range(versions)])


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def as_text(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Estimated generalised Jaccard similarity: the share of equal samples."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.lit(float(samples))


def edit_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    The next document is that with the next smaller id, after the last the
    first; the edited text has the document's second half replaced with as many
    characters from the start of the next one's.  Documents are dealt into id
    ranges once, and every aggregation runs inside them.  Null ids come last.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("ord"),
        F.xxhash64(text).alias("tie"),
        text.alias("text"),
    )
    # More ranges than partitions, so that partitions get like shares of them.
    near = with_neighbours(rows, ["ord", "tie"], ranges(docs), after=False, cyclic=True)
    place = Window.partitionBy("_bucket").orderBy("_row")
    key = ["_bucket", "_row"]
    half = F.floor(F.length("text") / 2).cast("int")
    after = F.coalesce(F.lag("text").over(place), F.lit(""))
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - F.col("half")), F.substr("after", F.lit(1), F.col("half")))
    near = near.withColumn("after", after).withColumn("half", half).withColumn("edited", edited)
    # A copy from another range needs its fingerprint, but no edited text.
    both = F.array(words_of(F.col("text")), words_of(F.when(F.col("_side") == 0, F.col("edited"))))
    pair = version_fingerprints(near.select(*key, both.alias("phrases")), key, 2, samples)
    pair = pair.withColumnsRenamed({"fp0": "fp", "fp1": "edited_fp"})
    pair = pair.withColumn("next_fp", F.lag("fp").over(place))
    given = F.when(F.col("ord") != -(1 << 63), F.col("ord")).cast(docs.schema[id_col].dataType)
    facts = near.filter("_side = 0").select(*key, given.alias("id"), F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    # Both sides lie in the id ranges already: the join moves nothing.
    pair = facts.join(pair, key)
    return pair.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp"), samples).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp"), samples).alias("near_next"),
    )
