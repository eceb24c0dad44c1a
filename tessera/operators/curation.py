"""Around the models and the store: candidates, assignments, reuse, deletions, planners, profiles and winners."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from ..functions import fixed, lists, scalars, wording
from . import aggregates, graph

# ---------------------------------------------------------------- retrieval


def match_terms(keywords: Column) -> Column:
    """Keywords as terms of a full-text query: without its signs, two characters or more, joined by OR."""
    clean = F.transform(keywords, lambda k: F.trim(F.regexp_replace(k, r'["*()]', " ")))
    return F.array_join(F.filter(clean, lambda k: F.length(k) >= 2), " OR ")


def intent_categories(query: Column) -> Column:
    """Categories that the words of a query point to."""
    return F.array_compact(F.array(*[F.when(F.regexp_like(scalars.ascii_words(query), F.lit(f"(?i){p}")), F.lit(slug)) for slug, p in lists.INTENTS]))


def matching_categories(categories: DataFrame, hints: list[str], slug: str = "slug", name: str = "name", description: str = "description") -> DataFrame:
    """Categories whose slug, name or description a hint names, whole or by its first part."""
    test = F.lit(False)
    for hint in hints:
        first = hint.split("-")[0]
        test = test | (F.col(slug) == hint) | F.contains(F.col(slug), F.lit(first)) | F.contains(F.lower(name), F.lit(hint.replace("-", " ")))
        test = test | F.coalesce(F.contains(F.lower(description), F.lit(first)), F.lit(False))
    return categories.filter(test)


def united(lists_: list[DataFrame], id_col: str, rank: str, least: int, most: int) -> DataFrame:
    """(id, place): candidates of several ranked lists, earlier lists first, each id once.

    The last list is the fallback: it is drawn on only if the others hold fewer
    than ``least`` ids.  At most ``most`` stay, so each list gives ``most``.
    """
    tops = [x.orderBy(rank, id_col).limit(most).select(F.col(id_col).alias("id"), F.struct(F.lit(i).alias("list"), F.col(rank).alias("rank")).alias("at")) for i, x in enumerate(lists_)]
    rows = tops[0]
    for x in tops[1:]:
        rows = rows.unionByName(x)
    first = rows.groupBy("id").agg(F.min("at").alias("at"))
    own = F.count_if(F.col("at.list") < len(lists_) - 1).over(Window.partitionBy(F.lit(0)))  # ``most`` rows a list
    kept = first.withColumn("_own", own).filter((F.col("at.list") < len(lists_) - 1) | (F.col("_own") < least))
    place = F.row_number().over(Window.orderBy("at", "id"))
    return kept.withColumn("place", place).filter((F.col("place") <= most) | (F.col("_own") >= least)).select(F.col("id").alias(id_col), "place")


def index_entry(id_: Column, text: Column, media: Column, tags: Column, hashtags: Column, tools: Column, categories: Column) -> Column:
    """What a ranking model reads of a row: text, media types, tags, hashtags and tools, and categories (name, confidence) of 0.5 or more."""
    marks = F.array_compact(F.array(
        F.when(F.size(hashtags) > 0, F.concat(F.lit("#"), F.array_join(F.slice(hashtags, 1, 10), " #"))),
        F.when(F.size(tools) > 0, F.concat(F.lit("tools: "), F.array_join(tools, ", "))),
    ))
    sure = F.transform(F.filter(categories, lambda c: c["confidence"] >= 0.5), lambda c: F.concat(c["name"], F.lit("("), F.format_number(c["confidence"], 1), F.lit(")")))
    lines = [
        F.concat(F.lit("["), id_, F.lit("]")), F.concat(F.lit("text: "), F.substring(text, 1, 350)),
        F.when(F.size(media) > 0, F.array_join(F.transform(media, lambda m: F.concat(F.lit("media: ["), m, F.lit("]"))), "\n")),
        F.when(F.size(tags) > 0, F.concat(F.lit("ai_tags: "), F.array_join(F.slice(tags, 1, 35), ", "))),
        F.when(F.size(marks) > 0, F.array_join(marks, " | ")), F.when(F.size(sure) > 0, F.concat(F.lit("categories: "), F.array_join(sure, ", "))),
    ]
    return F.array_join(F.array_compact(F.array(*lines)), "\n")


def reranked(candidates: DataFrame, answer: Column, id_col: str) -> DataFrame:
    """Candidates that a model's answer names, by its scores; ids that no candidate has are dropped.

    ``answer`` is one JSON text with ``matches`` of id, score and reason, in whatever words around it.
    """
    found = F.from_json(F.regexp_extract(answer, r"(?s)(\{.*\})", 1), "matches array<struct<id:string,score:double,reason:string>>")
    one = candidates.sparkSession.range(1).select(F.posexplode(found["matches"]).alias("at", "m"))
    named = one.select("at", F.col("m.id").alias("_id"), "m.score", "m.reason")
    rows = candidates.join(named, F.col(id_col).cast("string") == F.col("_id"))
    return rows.orderBy(F.desc("score"), "at").drop("_id", "at")


# ---------------------------------------------------------------- assignments and reuse


def parsed_assignments(answers: DataFrame, answer: str, known: list[str]) -> DataFrame:
    """(id, category, confidence) of models' answers: known categories only, confidence held to 0.5 to 1, 0.8 where there is none."""
    schema = "array<struct<tweetId:string,assignments:array<struct<category:string,confidence:double>>>>"
    parsed = F.from_json(F.regexp_extract(answer, r"(?s)(\[.*\])", 1), schema)
    rows = answers.select(F.explode(parsed).alias("r")).select(F.col("r.tweetId").alias("id"), F.explode("r.assignments").alias("a"))
    sure = F.when(F.col("a.confidence").isNotNull(), scalars.clamp(F.col("a.confidence"), 0.5, 1.0)).otherwise(0.8)
    return rows.filter(F.col("a.category").isin(known)).select("id", F.col("a.category").alias("category"), sure.alias("confidence"))


def assigned(old: DataFrame, new: DataFrame, ids: DataFrame, categories: DataFrame) -> DataFrame:
    """Assignments (id, category_id, confidence) after new ones (key, slug, confidence) are upserted.

    ``ids`` (key, id) and ``categories`` (slug, category_id) resolve them; what they don't know is dropped.
    """
    rows = new.join(ids, "key").join(categories, "slug")
    rows = rows.groupBy("id", "category_id").agg(F.max("confidence").alias("confidence"))
    return old.join(rows, ["id", "category_id"], "left_anti").select("id", "category_id", "confidence").unionByName(rows)


def reused(items: DataFrame, id_col: str, url: str, tags: str) -> DataFrame:
    """Rows without tags take those of the first row of their URL that has some; others that were tried get the empty mark."""
    first = items.filter(F.col(tags).isNotNull() & (F.col(tags) != "{}")).groupBy(F.col(url).alias("_url")).agg(F.min_by(tags, id_col).alias("_tags"))
    rows = items.join(first, F.col(url) == F.col("_url"), "left")
    return rows.withColumn(tags, F.coalesce(tags, "_tags", F.lit("{}"))).drop("_url", "_tags")


def batches(df: DataFrame, order: str, size: int, parts: int) -> DataFrame:
    """Adds ``batch``: rows in order of a key, ``size`` at a time inside each of ``parts`` ranges."""
    ranged = df.repartitionByRange(parts, order).withColumn("_part", F.spark_partition_id())
    rn = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return ranged.withColumn("batch", F.concat_ws("-", F.col("_part"), F.floor(rn / size))).drop("_part")


def applied(df: DataFrame, function, column: str, out: str, kind="string", single: bool = False) -> DataFrame:
    """Adds the result of an injected ``function(list) -> list`` over a column, batch by batch, and ``error`` where it raises.

    A failed batch leaves its results null, to be tried again; a list of another
    length is an error.  ``single`` gives it one row at a time, so that a row that
    fails spoils no other.
    """
    columns = df.columns

    def attempt(values):
        try:
            got = list(function(values))
            if len(got) != len(values):
                raise ValueError(f"{len(got)} results for {len(values)} rows")
            return got, [None] * len(values)
        except Exception as e:  # noqa: BLE001
            return [None] * len(values), [str(e)] * len(values)

    def run(pdfs):
        for pdf in pdfs:
            values = pdf[column].tolist()
            parts = [attempt([v]) for v in values] if single else [attempt(values)]
            found, errors = [x for p in parts for x in p[0]], [x for p in parts for x in p[1]]
            yield pdf.assign(**{out: pd.Series(found, pdf.index, dtype=object), "error": errors})[[*columns, out, "error"]]

    schema = StructType([*df.schema.fields]).add(out, kind).add("error", "string")
    return df.mapInPandas(run, schema)


def suggestion_sample(df: DataFrame, enriched: Column, newest: str, id_col: str, most: int = 100) -> DataFrame:
    """The newest rows, enriched ones first, topped up with others."""
    return df.withColumn("_first", (~enriched).cast("int")).orderBy("_first", F.desc(newest), id_col).limit(most).drop("_first")


# ---------------------------------------------------------------- state


def without(parents: DataFrame, children: list[tuple[DataFrame, str]], key: str, deleted: DataFrame) -> list[DataFrame]:
    """The parents and their children after the deletion of some parents."""
    gone = deleted.select(key).distinct()
    return [parents.join(gone, key, "left_anti")] + [c.join(gone.withColumnRenamed(key, k), k, "left_anti") for c, k in children]


def decoded_rows(df: DataFrame, column: str) -> DataFrame:
    """Adds ``changed``: whether decoding references changed the column, which now holds the decoded text."""
    new = wording.references_decoded(F.col(column))
    return df.withColumn("_new", new).withColumn("changed", ~F.col("_new").eqNullSafe(F.col(column))).withColumn(column, F.col("_new")).drop("_new")


def refetch_plan(rows: DataFrame, fetched: DataFrame, key: str, text: str, note: str) -> DataFrame:
    """Rows whose fetched note has a text, and another one than they hold."""
    got = fetched.select(key, F.col(note).alias("_note")).filter(F.trim(F.coalesce("_note", F.lit(""))) != "")
    return rows.join(got, key).filter(~F.col(text).eqNullSafe(F.col("_note"))).withColumn(text, F.col("_note")).drop("_note")


def cost(reads: Column, rate: float) -> Column:
    return F.round(reads * F.lit(rate), 4)


def needs_consent(items: Column, free: int = 5) -> Column:
    """Whether a run over so many items must be confirmed; null where there is nothing to run."""
    return F.when(items > 0, items > free)


# ---------------------------------------------------------------- gathering


def escalation(posts: DataFrame, author: str, value: str, cap: int, floors: list[float]) -> DataFrame:
    """(author, floor, found, capped): what a capped search returns on each rung of a ladder of floors.

    A rung is climbed only by authors whose search on the rung below came back full.
    """
    per = posts.groupBy(author).agg(*[F.count_if(F.col(value) >= f).alias(f"n{i}") for i, f in enumerate(floors)])
    rungs, reached = [], F.lit(True)
    for i, f in enumerate(floors):
        rungs.append(F.when(reached, F.struct(F.lit(float(f)).alias("floor"), F.least(F.col(f"n{i}"), F.lit(cap)).alias("found"), (F.col(f"n{i}") >= cap).alias("capped"))))
        reached = reached & (F.col(f"n{i}") >= cap)
    return per.select(author, F.explode(F.array_compact(F.array(*rungs))).alias("r")).select(author, "r.*")


def band_splits(low: int, high: int, least: int, depth: int) -> list[tuple[int, int, int]]:
    """(from, to, depth): a band of minutes and the halves that a full answer splits it into, as deep and as narrow as allowed."""
    out, open_ = [], [(low, high)]
    for d in range(depth + 1):
        out += [(a, b, d) for a, b in open_]
        open_ = [x for a, b in open_ if b - a >= 2 * least for x in ((a, a + (b - a) // 2), (a + (b - a) // 2, b))]
    return out


def within_budget(calls: DataFrame, order: list[Column], seconds: str, budget: float, keys: list[str]) -> DataFrame:
    """Adds ``done``: the calls of each run that start before its wall-clock budget is spent."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return calls.withColumn("done", F.coalesce(F.sum(seconds).over(w), F.lit(0.0)) < budget)


def frontier(df: DataFrame, keys: list[str], time: str, least: int = 12) -> DataFrame:
    """(keys, low, high): the times a third and two thirds into each group of ``least`` rows or more."""
    got = df.groupBy(*keys).agg(F.array_sort(F.collect_list(time)).alias("t")).filter(F.size("t") >= least)
    at = lambda share: F.element_at("t", (F.floor(F.size("t") * share / 3) + 1).cast("int"))
    return got.select(*keys, at(1).alias("low"), at(2).alias("high")).filter("low < high")


def api_shape(rows: DataFrame, since: Column, until: Column) -> tuple[DataFrame, DataFrame]:
    """Rows (handle, tweet_id, text, created, name) as an API's data and users: complete ones inside the window, users once, by first row."""
    handle = F.trim(F.regexp_replace(F.coalesce("handle", F.lit("")), "^@+", ""))
    rows = rows.withColumn("handle", handle).filter("handle != '' and coalesce(tweet_id, '') != '' and coalesce(text, '') != ''")
    rows = rows.filter(F.col("created").isNull() | F.col("created").between(F.date_trunc("day", since), until))
    data = rows.select(F.col("tweet_id").alias("id"), "text", F.col("handle").alias("author_id"), F.col("created").alias("created_at"))
    users = rows.groupBy("handle").agg(F.min_by(F.coalesce("name", "handle"), "tweet_id").alias("name"))
    return data, users.select(F.col("handle").alias("id"), F.col("handle").alias("username"), "name")


def cited(rows: DataFrame, citations: DataFrame, id_col: str, url: str) -> DataFrame:
    """Rows whose id one of the citations names."""
    ids = citations.select(F.regexp_extract(url, r"(?:status|i)/([0-9]+)", 1).alias(id_col)).filter(f"{id_col} != ''").distinct()
    return rows.join(ids, id_col, "left_semi")


# ---------------------------------------------------------------- profile


def is_origin(tag: Column) -> Column:
    """The tag of a row that a brief has put before the reader."""
    return (F.regexp_replace(F.lower(F.trim(tag)), r"\s+", "") == "origin:brief-surfaced") | (wording.topic_slug(tag) == "origin-brief-surfaced")


def negative_of(tag: Column) -> Column:
    """What a negative tag turns against; null for other tags."""
    low = F.lower(F.trim(tag))
    out = F.lit(None).cast("string")
    for p in reversed(lists.NEGATIVE_PREFIXES):
        out = F.when(low.startswith(p), wording.topic_slug(F.substr(F.trim(tag), F.lit(len(p) + 1)))).otherwise(out)
    return F.when(out != "", out)


def topics_of(tags: Column) -> Column:
    """Distinct topics of a row's tags, without origins and negatives."""
    plain = F.filter(tags, lambda t: ~is_origin(t) & negative_of(t).isNull())
    return F.array_distinct(F.filter(F.transform(plain, wording.topic_slug), lambda t: t != ""))


def canonical_topic(topic: Column) -> Column:
    key = F.regexp_replace(wording.topic_slug(topic), "^embedding-cluster-", "")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in lists.TOPIC_ALIASES.items() for x in kv]), key), key)


def profile_topics(rows: DataFrame, id_col: str, tags: str, weight: Column, segment: str) -> DataFrame:
    """(topic, weight, n, segment): canonical topics of a profile.

    Rows that a brief has put before the reader would confirm themselves: they
    give no topics.  Excluded topics are left out.
    """
    rows = rows.filter(~F.exists(tags, is_origin)).withColumn("_w", weight)
    each = rows.select("_w", segment, F.explode(topics_of(F.col(tags))).alias("topic")).withColumn("topic", canonical_topic(F.col("topic")))
    each = each.filter(~F.col("topic").isin(lists.EXCLUDED_TOPICS))
    return aggregates.weighted_buckets(each, "topic", "_w", segment)


def profile_fault(mode: Column, updated: Column, started: Column, slack: int = 2) -> Column:
    """Why a profile can't be used: of another basis, without a time, or older than the run."""
    return (
        F.when(~mode.eqNullSafe(F.lit("brief-relevant-only")), "profile-contaminated")
        .when(updated.isNull() | (F.unix_timestamp(updated) < F.unix_timestamp(started) - slack), "profile-stale")
    )


def theme(topic: Column) -> Column:
    """The name that an overview gives a topic; null for topics it skips."""
    t = F.lower(F.trim(topic))
    words = F.filter(F.split(F.replace(t, F.lit("_"), F.lit("-")), "-"), lambda w: w != "")
    title = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), " ")
    named = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in lists.THEMES.items() for x in kv]), t), title)
    return F.when(~t.isin(lists.SKIPPED_TOPICS), named)


def stories(df: DataFrame, key: Column, order: list[Column], url: str, most: int) -> DataFrame:
    """The best row of each key, in order, those with a URL numbered from 1, ``most`` of them."""
    w = Window.partitionBy("_key").orderBy(*order)
    rows = df.withColumn("_key", key).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    rows = rows.filter(F.coalesce(F.col(url), F.lit("")) != "").orderBy(*order).limit(most)
    return rows.withColumn("ref", F.row_number().over(Window.orderBy(*order))).drop("_key", "_rn")


def context_tags(names: Column) -> Column:
    """(tag, category) pairs of the names of context annotations, in order, each once."""
    rules = [F.when(F.exists(names, _like(p)), F.struct(F.lit(t).alias("tag"), F.lit(c).alias("category"))) for t, c, p in lists.CONTEXT_RULES]
    return F.array_compact(F.array(*rules))


def _like(pattern: str):
    return lambda n: F.regexp_like(scalars.ascii_words(n), F.lit(f"(?i){pattern}"))


def post_format(text: Column, id_: Column, conversation: Column, refs: Column) -> Column:
    """thread, quote, reply or single."""
    thread = F.coalesce(conversation != id_, F.lit(False)) | F.regexp_like(text, F.lit(r"(?i)(^|\s)(thread|🧵)($|\s|:)")) | F.regexp_like(text, F.lit(r"(^|\s)[0-9]{1,2}\s*/\s*[0-9]{1,2}($|\s)"))
    return F.when(thread, "thread").when(F.array_contains(refs, "quoted"), "quote").when(F.array_contains(refs, "replied_to"), "reply").otherwise("single")


def merged_tags(*tags: Column) -> Column:
    """Tags of several lists, in order, those equal but for case once."""
    return scalars.distinct_ignoring_case(F.flatten(F.array(*tags)))


# ---------------------------------------------------------------- events and winners


def identity(url: Column, source: Column, post: Column, id_: Column) -> Column:
    """What an item is known by: its URL, else its source and id; null without either."""
    s = F.lower(F.coalesce(source, F.lit("")))
    given = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""
    return F.when(given(url), F.concat(F.lit("url:"), url)).when(given(post), F.concat(s, F.lit(":tweet_id:"), post)).when(given(id_), F.concat(s, F.lit(":id:"), id_))


def merged_by_identity(df: DataFrame, group: str, name: str) -> DataFrame:
    """(group, merged): groups joined where items of one identity stand in several, named by the least."""
    named = df.filter(F.col(name).isNotNull()).select(F.col(group).alias("g"), F.col(name).alias("i")).distinct()
    edges = named.join(named.groupBy("i").agg(F.min("g").alias("a")), "i").filter("a != g").select("a", F.col("g").alias("b"))
    return graph.connected(df.select(F.col(group).alias("id")).distinct(), edges).select(F.col("id").alias(group), F.col("group").alias("merged"))


def event_winners(df: DataFrame, group: str, order: list[Column], score: str, url: str, top_gate: float) -> DataFrame:
    """One winner an event, placed by the event's best score; losers name the URL they lost to."""
    w = Window.partitionBy(group).orderBy(*order)
    best = F.max(score).over(Window.partitionBy(group))
    rows = df.withColumn("rank", F.row_number().over(w)).withColumn("lost_to", F.first(url).over(w)).withColumn("_best", best)
    first = F.col("rank") == 1
    rows = rows.withColumn("slot", F.when(first & (F.col("_best") >= top_gate), "top").when(first, "also"))
    return rows.withColumn("lost_to", F.when(~first, F.col("lost_to"))).drop("_best")


def top_signals(signals: Column, n: int = 2) -> Column:
    """The ``n`` entries of a map of numbers that are farthest from zero."""
    ranked = F.array_sort(F.transform(F.map_entries(signals), lambda e: F.struct((-F.abs(e["value"])).alias("far"), e["key"].alias("name"), e["value"].alias("score"))))
    return F.transform(F.slice(ranked, 1, n), lambda e: F.struct(e["name"].alias("name"), F.round(e["score"], 4).alias("score")))


def fitted(pool: DataFrame, deltas: DataFrame, id_col: str, index: str) -> DataFrame:
    """The pool with each item's delta, found by index, else by id, else 0."""
    by_index = deltas.select(F.col(index).alias("_at"), F.col("delta").alias("_a")).filter("_at is not null")
    by_id = deltas.groupBy(F.col(id_col).alias("_id")).agg(F.max_by("delta", index).alias("_b"))
    rows = pool.join(by_index, F.col(index) == F.col("_at"), "left").join(by_id, F.col(id_col) == F.col("_id"), "left")
    return rows.withColumn("delta", F.coalesce("_a", "_b", F.lit(0.0))).drop("_at", "_a", "_id", "_b")


def sampled(df: DataFrame, id_col: str, seed: int, n: int) -> DataFrame:
    """``n`` rows, the same for the same seed."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(seed))), id_col).limit(n)


def newest_ids(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """Rows by ids read as numbers, the greatest first; ids may exceed 64 bits."""
    return df.orderBy(F.desc(F.col(id_col).cast("decimal(38,0)"))).limit(n)


def relevant_segment(categories: Column, formats: Column) -> Column:
    """Whether a row is relevant to a brief, by categories or by the flags of its format."""
    hit = F.arrays_overlap(categories, scalars.words_in(fixed.RELEVANT_CATEGORIES)) | F.arrays_overlap(formats, scalars.words_in(["is_launch", "is_benchmark", "has_code"]))
    return F.when(hit, "brief-relevant").otherwise("everything-else")
