"""Queries of scoring, selection, aggregation, state and evaluation."""

from pyspark.sql import Window, functions as F

from ..functions import fixed, scalars
from ..operators import aggregates as agg, delta, dml, evaluate as ev, planning, scoring, windows
from .registry import query

# ---------------------------------------------------------------- scoring

#: Orders as a scored pool: the author is the customer, the score comes from the price.
POOL = """pool AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey % 40 END AS author,
    least(100, CAST(floor(o_totalprice / 4000) AS BIGINT)) AS score, o_orderpriority AS topic, o_orderstatus AS source FROM orders)"""


def _pool(t):
    return t("orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 17 != 0, F.col("o_custkey") % 40).alias("author"),
        F.least(F.lit(100), F.floor(F.col("o_totalprice") / 4000)).alias("score"), F.col("o_orderpriority").alias("topic"),
        F.col("o_orderstatus").alias("source"),
    )


def _order():
    return [F.desc("score"), F.asc("id")]


@query(f"""WITH {POOL}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rn FROM pool)
    SELECT id, CASE WHEN score >= 90 AND rn > 2 THEN 89 WHEN score >= 100 AND rn > 1 THEN 99 ELSE score END AS final FROM r""")
def forced_distribution(t):
    return windows.forced_distribution(_pool(t), "score", _order(), key="id").select("id", F.col("final").cast("long").alias("final"))


SLOTS = """e AS (SELECT *, score >= 50 AS fit FROM pool), {kept},
    h AS (SELECT *, kept AND score >= 58 AS high, sum(CAST(kept AND score >= 58 AS INT)) OVER (ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS nh FROM k),
    p AS (SELECT *, high AND nh <= 5 AS top FROM h),
    q AS (SELECT *, kept AND NOT top AS oth, sum(CAST(kept AND NOT top AS INT)) OVER (ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) AS na FROM p)
    SELECT id, CASE WHEN top THEN 'top' WHEN oth AND na <= 3 THEN 'also' END AS slot,
      CASE WHEN top OR (oth AND na <= 3) THEN NULL WHEN fit AND NOT kept THEN 'author_cap' ELSE 'below_gate_or_cap' END AS dropped FROM q"""


@query("WITH " + POOL + ", " + SLOTS.format(kept="k AS (SELECT *, fit AS kept FROM e)"))
def gated_slots(t):
    return windows.gated_slots(_pool(t), "score", _order(), 58, 50, 5, 3, key="id").select("id", "slot", "dropped")


@query("WITH " + POOL + ", " + SLOTS.format(kept="""k AS (SELECT *, fit AND (author IS NULL
    OR sum(CAST(fit AS INT)) OVER (PARTITION BY author ORDER BY score DESC, id ROWS UNBOUNDED PRECEDING) <= 1) AS kept FROM e)"""))
def author_cap(t):
    return windows.gated_slots(_pool(t), "score", _order(), 58, 50, 5, 3, "author", 1, key="id").select("id", "slot", "dropped")


@query("""SELECT user_id, CAST(round_even(least(6 * log10(1 + n), CASE WHEN user_id % 2 = 0 THEN 15 ELSE 10 END), 0) AS INT) AS points
    FROM (SELECT user_id, sum(value) AS n FROM events GROUP BY user_id)""")
def engagement_points(t):
    n = t("events").groupBy("user_id").agg(F.sum("value").alias("n"))
    return n.select("user_id", scoring.engagement_points(F.col("n"), F.col("user_id") % 2 == 0).alias("points"))


@query("""SELECT o_orderkey, CAST(round_even(greatest(0, least(14, 8 * log10(greatest(o_totalprice / 100, 1) / 50))), 0) AS INT) AS points FROM orders""")
def crowd_points(t):
    return t("orders").select("o_orderkey", scoring.crowd_points(F.col("o_totalprice") / 100).alias("points"))


@query("""SELECT user_id, round(CASE WHEN s <= 0 THEN 0 ELSE greatest(0, least(1, (s / n + 3.8416 / (2 * n)
      - 1.96 * sqrt((s / n * (1 - s / n) + 3.8416 / (4 * n)) / n)) / (1 + 3.8416 / n))) END, 9) AS wilson
    FROM (SELECT user_id, CAST(count(*) FILTER (event_type = 'purchase') AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY user_id)""")
def wilson_bounds(t):
    n = t("events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("s"), F.count("*").alias("n"))
    return n.select("user_id", F.round(scalars.wilson(F.col("s"), F.col("n")), 9).alias("wilson"))


@query(f"""WITH {POOL} SELECT id, CASE {" ".join(f"WHEN score >= {x} THEN '{g}'" for x, g in fixed.GRADES)} ELSE 'D' END AS grade FROM pool""")
def grades(t):
    return _pool(t).select("id", scalars.grade(F.col("score")).alias("grade"))


def _case(column, values):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" if isinstance(v, str) else f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " END"


LABELS = ["Launch", "how-to", "deep dive!", "benchmark", "ad", "???", "field-report", "take", "news"]
ACTIONS = ["now", "Reference", "background", "", "use-now", "zzz"]


def _labelled(t):
    """Documents with labels, drawn from the id in the spellings that models use."""
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.floor(F.col("doc_id") / by), F.lit(len(values))) + 1).cast("int"))
    return t("documents").select(
        "doc_id", "source", "n_chars", pick(LABELS, 1).alias("content_type"), pick(ACTIONS, 2).alias("actionability"),
        pick(["solid", "vague", "Mixed", "x"], 3).alias("substance"), pick(["core", "related", "off-topic", None], 5).alias("on_topic"),
    )


def _list(values):
    return "[" + ", ".join("NULL" if v is None else f"'{v}'" for v in values) + "]"


def _norm(column, known, synonyms, default):
    v = f"regexp_replace(replace(lower(trim({column})), '-', '_'), '[^a-z0-9_]', '', 'g')"
    return f"coalesce(CASE WHEN {v} IN ({', '.join(repr(k) for k in known)}) THEN {v} END, {_case(v, synonyms)}, '{default}')"


LABEL_SQL = f"""raw AS (SELECT doc_id, source, n_chars, {_list(LABELS)}[doc_id % 9 + 1] AS ct, {_list(ACTIONS)}[(doc_id // 2) % 6 + 1] AS ac,
      {_list(["solid", "vague", "Mixed", "x"])}[(doc_id // 3) % 4 + 1] AS su, {_list(["core", "related", "off-topic", None])}[(doc_id // 5) % 4 + 1] AS ot FROM documents),
    lab AS (SELECT doc_id, source, n_chars, {_norm("ct", fixed.BASE, fixed.CONTENT_SYNONYMS, "opinion")} AS content_type,
      {_norm("ac", fixed.ACTIONABILITIES, fixed.ACTION_SYNONYMS, "context_only")} AS actionability,
      {_norm("su", fixed.SUBSTANCE, fixed.SUBSTANCE_SYNONYMS, "mixed")} AS substance, {_norm("ot", fixed.OFF_TOPIC, fixed.TOPIC_SYNONYMS, "adjacent")} AS on_topic FROM raw)"""


@query(f"WITH {LABEL_SQL} SELECT doc_id, content_type, actionability, substance, on_topic FROM lab")
def normalized_labels(t):
    return scoring.labelled(_labelled(t)).select("doc_id", "content_type", "actionability", "substance", "on_topic")


BASE_SQL = _case("content_type || '|' || actionability", {f"{c}|{a}": v for c, row in fixed.BASE.items() for a, v in zip(fixed.ACTIONABILITIES, row)})
SCORED_SQL = f"""{LABEL_SQL}, pts AS (SELECT *, {BASE_SQL} AS base, {_case("substance", fixed.SUBSTANCE)} AS sp,
      CAST(round_even(least(6 * log10(1 + n_chars / 10.0), CASE WHEN doc_id % 3 = 0 THEN 15 ELSE 10 END), 0) AS INT) AS ep,
      CASE WHEN on_topic = 'off' THEN 0 WHEN source = 'src1' THEN 8 WHEN source = 'src2' THEN 6 ELSE 0 END AS ap,
      CAST(round_even(greatest(-12, least(12, (doc_id % 40) - 20.5)), 0) AS INT) AS fp,
      CASE WHEN doc_id % 200 <= 24 THEN 10 WHEN doc_id % 200 <= 72 THEN 6 WHEN doc_id % 200 <= 168 THEN 3 ELSE 0 END AS rp,
      CASE doc_id % 4 WHEN 0 THEN 4 WHEN 1 THEN 2 ELSE 0 END AS mp, {_case("on_topic", fixed.OFF_TOPIC)} AS tp FROM lab),
    tot AS (SELECT *, base + sp + ep + ap + fp + rp + mp - tp AS total FROM pts),
    fin AS (SELECT *, greatest(0, least(100, CASE WHEN doc_id % 2 = 0 AND doc_id % 3 <> 0 AND n_chars / 10.0 < 100 THEN least(total, 45) ELSE total END)) AS final FROM tot)"""


def _scored(t):
    rows = scoring.labelled(_labelled(t)).withColumns({
        "engagement": F.col("n_chars") / 10.0, "known": F.col("doc_id") % 3 == 0, "leader": F.col("source") == "src1",
        "tracked": F.col("source") == "src2", "fit": F.col("doc_id") % 40 - 20.5, "hours": F.col("doc_id") % 200,
        "kind": F.when(F.col("doc_id") % 4 == 0, "video").when(F.col("doc_id") % 4 == 1, "photo"), "is_x": F.col("doc_id") % 2 == 0,
    })
    return scoring.scored(rows)


@query(f"WITH {SCORED_SQL} SELECT doc_id, final, base, sp AS substance_points, ep AS engagement_points, fp AS fit_points, rp AS recency_points FROM fin")
def score_pool(t):
    return _scored(t).select("doc_id", "final", "base", "substance_points", "engagement_points", "fit_points", "recency_points")


@query(f"""WITH {SCORED_SQL}, r AS (SELECT doc_id, source, final, n_chars, row_number() OVER (ORDER BY final DESC, n_chars DESC, doc_id) AS rn FROM fin),
    d AS (SELECT doc_id, source, n_chars, rn, CASE WHEN final >= 90 AND rn > 2 THEN 89 WHEN final >= 100 AND rn > 1 THEN 99 ELSE final END AS final FROM r),
    e AS (SELECT *, final >= 50 AS fit FROM d), k AS (SELECT *, fit AND sum(CAST(fit AS INT)) OVER (PARTITION BY source ORDER BY rn ROWS UNBOUNDED PRECEDING) <= 2 AS kept FROM e),
    h AS (SELECT *, sum(CAST(kept AND final >= 58 AS INT)) OVER (ORDER BY rn ROWS UNBOUNDED PRECEDING) AS nh FROM k),
    p AS (SELECT *, kept AND final >= 58 AND nh <= 5 AS top FROM h),
    q AS (SELECT *, sum(CAST(kept AND NOT top AS INT)) OVER (ORDER BY rn ROWS UNBOUNDED PRECEDING) AS na FROM p)
    SELECT doc_id, final, CASE WHEN top THEN 'top' WHEN kept AND na <= 2 THEN 'also' END AS slot FROM q WHERE top OR (kept AND na <= 2)""")
def select_brief(t):
    order = [F.desc("_score"), F.desc("n_chars"), F.asc("doc_id")]
    # The order is that of the score before the distribution; what the distribution lowers stays in place.
    rows = _scored(t).withColumn("_score", F.col("final"))
    got = scoring.selected(rows, order, "source", key="doc_id")
    return got.filter("slot is not null").select("doc_id", "final", "slot")


@query("""SELECT p_partkey, round(greatest(0, least(100, CASE WHEN p_size < 5 THEN least(x, 70) ELSE x END)), 6) AS score FROM (
    SELECT p_partkey, p_size, p_size * 1.5 + (p_partkey % 7) + least(p_retailprice / 100, 15) + CASE WHEN p_partkey % 10 = 0 THEN 10 WHEN p_partkey % 10 = 1 THEN 8 ELSE 0 END AS x FROM part)""")
def legacy_scores(t):
    k = F.col("p_partkey")
    score = scoring.legacy_score(F.col("p_size") * 1.5, k % 7, F.col("p_retailprice") / 100, k % 10 == 1, k % 10 == 0, F.col("p_size") < 5)
    return t("part").select("p_partkey", F.round(score, 6).alias("score"))


@query("""SELECT event_id, round(CASE WHEN event_id % 5 = 0 THEN k ELSE (k + (value / 100 - avg(CASE WHEN event_id % 5 <> 0 THEN value / 100 END) OVER ())) / 2 END, 6) AS fused
    FROM (SELECT event_id, value, (0.42 * (event_id % 10) / 10 + 0.28 * (user_id % 4) / 4 + 0.08 - 0.18) * 30 AS k FROM events)""")
def fused_affinity(t):
    keyword = scoring.keyword_affinity(F.col("event_id") % 10 / 10, F.col("user_id") % 4 / 4, F.lit(0.0), F.lit(0.0), F.lit(True))
    embed = F.when(F.col("event_id") % 5 != 0, F.col("value") / 100)
    rows = t("events").select("event_id", keyword.alias("k"), embed.alias("e"))
    rows = rows.crossJoin(rows.agg(F.avg("e").alias("mean")))  # one row
    return rows.select("event_id", F.round(scoring.fused(F.col("k"), F.col("e"), F.col("mean")), 6).alias("fused"))


# ---------------------------------------------------------------- aggregates


@query("""SELECT count(*) AS total, count(*) FILTER (lang = 'en') AS english, count(*) FILTER (n_chars > 2000) AS long, count(*) FILTER (source IS NULL) AS without_source FROM documents""")
def corpus_stats(t):
    return agg.corpus_stats(t("documents"), {"english": F.col("lang") == "en", "long": F.col("n_chars") > 2000, "without_source": F.col("source").isNull()})


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def source_counts(t):
    return t("documents").groupBy("source").agg(F.count("*").alias("n"))


@query("SELECT n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name")
def category_counts(t):
    return agg.counts_with_zero(t("nation"), t("supplier"), "n_nationkey", "s_nationkey", "n_name")


@query("SELECT n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name ORDER BY n DESC, n_name LIMIT 5")
def top_categories(t):
    return agg.counts_with_zero(t("nation"), t("supplier"), "n_nationkey", "s_nationkey", "n_name", 5)


@query("""WITH e AS (SELECT user_id, event_type, CASE WHEN event_id % 3 = 0 THEN 1.0 ELSE 0.3 END AS w FROM events),
    p AS (SELECT user_id, event_type, sum(w) AS w, count(*) AS n FROM e GROUP BY ALL)
    SELECT user_id, floor(sum(w) * 1000 + 0.5) / 1000 AS weight, CAST(sum(n) AS BIGINT) AS n, arg_min(event_type, (-round(w, 6), event_type)) AS segment FROM p GROUP BY user_id""")
def weighted_buckets(t):
    rows = t("events").withColumn("w", F.when(F.col("event_id") % 3 == 0, 1.0).otherwise(0.3))
    return agg.weighted_buckets(rows, "user_id", "w", "event_type")


@query("""WITH r AS (SELECT o_orderkey AS id, o_totalprice AS score, unnest(list_distinct([o_orderpriority, o_orderstatus])) AS theme FROM orders),
    b AS (SELECT theme, count(*) AS n, round(sum(score), 2) AS salience FROM r GROUP BY theme ORDER BY n DESC, sum(score) DESC, theme LIMIT 8),
    o AS (SELECT * FROM r JOIN b USING (theme) QUALIFY row_number() OVER (PARTITION BY id ORDER BY theme) = 1),
    x AS (SELECT theme, id FROM o QUALIFY row_number() OVER (PARTITION BY theme ORDER BY o.score DESC, id) <= 3)
    SELECT theme, n, salience, coalesce((SELECT list(id ORDER BY s DESC, id) FROM (SELECT x.id, o.score AS s FROM x JOIN o ON o.id = x.id AND o.theme = x.theme WHERE x.theme = b.theme)), []) AS examples FROM b""")
def theme_histogram(t):
    rows = t("orders").withColumn("themes", F.array("o_orderpriority", "o_orderstatus"))
    got = agg.theme_histogram(rows, "themes", "o_totalprice", "o_orderkey")
    return got.select("theme", "n", F.round("salience", 2).alias("salience"), "examples")


@query("""SELECT user_id, n, total FROM (SELECT user_id, count(*) AS n, round(sum(value), 4) AS total FROM events WHERE event_type = 'purchase'
    GROUP BY user_id ORDER BY n DESC, sum(value) DESC, user_id LIMIT 8) WHERE n >= 2""")
def loud_authors(t):
    got = agg.loud(t("events").filter("event_type = 'purchase'"), "user_id", "value")
    return got.select("user_id", "n", F.round("total", 4).alias("total"))


@query("SELECT coalesce(event_type, '?') AS kind, count(*) AS n FROM events GROUP BY 1")
def content_mix(t):
    return agg.mix(t("events"), "event_type")


@query("""SELECT CASE WHEN r LIKE 'topic_dup%' THEN 'topic_dup' ELSE r END AS reason, count(*) AS n FROM (SELECT CASE event_id % 4 WHEN 0 THEN 'kept'
    WHEN 1 THEN 'topic_dup:' || user_id WHEN 2 THEN 'below_gate' ELSE 'author_cap' END AS r FROM events) GROUP BY 1""")
def funnel(t):
    k = F.col("event_id") % 4
    reason = F.when(k == 1, F.concat(F.lit("topic_dup:"), "user_id")).when(k == 2, "below_gate").when(k == 3, "author_cap")
    return agg.funnel(t("events").withColumn("reason", reason), "reason")


@query(f"""WITH {POOL}, g(quick, top) AS (VALUES (40.0, 50.0), (50.0, 60.0), (20.0, 90.0))
    SELECT CAST(quick AS DOUBLE) AS quick, CAST(top AS DOUBLE) AS top, count(*) FILTER (score >= top) AS n_top, count(DISTINCT topic) FILTER (score >= top) AS topics,
      count(*) FILTER (score >= quick AND score < top) AS n_quick FROM pool, g GROUP BY ALL""")
def what_if_bands(t):
    return agg.what_if(_pool(t), "score", "topic", [(40, 50), (50, 60), (20, 90)])


@query("SELECT user_id FROM events GROUP BY user_id HAVING max(CASE WHEN user_id % 5 = 0 THEN 0 ELSE value END) = 0")
def silent_sources(t):
    rows = t("events").withColumn("score", F.when(F.col("user_id") % 5 == 0, 0.0).otherwise(F.col("value")))
    return agg.silent_sources(rows, "user_id", "score")


@query(f"""WITH {POOL}, g AS (SELECT source AS topic, count(*) AS n FROM pool WHERE score >= 50 GROUP BY 1), s AS (SELECT topic, n, n / sum(n) OVER () AS share FROM g ORDER BY n DESC, topic LIMIT 1)
    SELECT topic, n, round(share, 6) AS share FROM s WHERE n >= 5 AND share >= 0.3""")
def starving_topics(t):
    got = agg.starving_topics(_pool(t).withColumn("topic", F.col("source")), "topic", "score", 50, 5, 0.3)
    return got.select("topic", "n", F.round("share", 6).alias("share"))


@query("SELECT p_type, count(*) AS n FROM part GROUP BY p_type HAVING count(*) > 1")
def repeated_values(t):
    return agg.repeated_values(t("part"), "p_type")


@query("SELECT user_id, count(*) AS n, count(*) >= 70 AS truncated FROM events GROUP BY user_id")
def truncated_handles(t):
    return agg.truncated(t("events"), "user_id", 70)


TIERS = """c AS (SELECT user_id, CAST(floor AS DOUBLE) AS floor, count(*) FILTER (value >= floor) AS n FROM events, (VALUES (10.0), (50.0), (90.0)) f(floor) WHERE event_type <> 'error' GROUP BY ALL)"""


@query(f"WITH {TIERS} SELECT user_id, floor, n FROM c")
def tier_counts(t):
    return agg.tier_counts(t("events"), "user_id", "value", [10, 50, 90], F.col("event_type") == "error")


@query(f"WITH {TIERS} SELECT floor, CAST(sum(n) AS BIGINT) AS rows, count(DISTINCT user_id) AS authors, CAST(greatest(ceil(sum(n) / 40), ceil(count(DISTINCT user_id) / 8)) AS BIGINT) AS calls FROM c GROUP BY floor")
def cost_floor(t):
    return agg.cost_floor(agg.tier_counts(t("events"), "user_id", "value", [10, 50, 90], F.col("event_type") == "error"), "user_id", 40, 8)


@query("""SELECT min(l_quantity) AS least, quantile_cont(l_extendedprice, 0.25) AS p25, quantile_cont(l_extendedprice, 0.5) AS median,
    quantile_cont(l_extendedprice, 0.75) AS p75, round(avg(l_extendedprice), 4) AS mean, max(l_extendedprice) AS most FROM lineitem""".replace("min(l_quantity)", "min(l_extendedprice)"))
def price_quartiles(t):
    got = agg.quartiles(t("lineitem"), "l_extendedprice")
    return got.withColumn("mean", F.round("mean", 4))


@query("SELECT CAST(least(floor(value / 10), 9) AS BIGINT) AS bucket, count(*) AS n FROM events GROUP BY 1")
def value_histogram(t):
    return agg.histogram(t("events"), "value", 10.0)


@query("""SELECT l_returnflag, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS deviation, max(l_quantity) - min(l_quantity) AS span FROM lineitem GROUP BY 1""")
def term_spread(t):
    got = agg.spread(t("lineitem"), ["l_returnflag"], "l_quantity")
    return got.select("l_returnflag", F.round("mean", 6).alias("mean"), F.round("deviation", 6).alias("deviation"), "span")


@query("SELECT c_mktsegment, count(*) FILTER (c_acctbal > 0) AS n_positive, count(*) FILTER (c_acctbal < 0) AS n_negative FROM customer GROUP BY 1")
def sign_counts(t):
    return agg.signs(t("customer"), ["c_mktsegment"], "c_acctbal")


@query("""SELECT event_type, count(*) AS fetched, count(*) FILTER (user_id % 3 <> 0) AS net_new, count(*) FILTER (user_id % 3 = 0) AS overlap,
    list_sort(list(event_id ORDER BY event_id) FILTER (user_id % 3 <> 0))[1:5] AS samples FROM events GROUP BY 1""")
def source_probe(t):
    return agg.probe(t("events"), ["event_type"], F.col("user_id") % 3 == 0, "event_id")


@query("""SELECT CAST(sum(user_id) AS BIGINT) AS user_id, bool_or(value > 99) AS high, list_sort(list_distinct(list(event_type))) AS kinds FROM events""")
def merged_stats(t):
    rows = t("events").select("user_id", (F.col("value") > 99).alias("high"), F.array("event_type").alias("kinds"))
    return agg.merged_stats(rows, ["user_id"], ["high"], ["kinds"])


@query("""SELECT CASE WHEN text IS NULL THEN 'malformed' WHEN length(text) < 400 THEN 'short' WHEN lang <> 'en' THEN 'window' ELSE 'passed' END AS stage, count(*) AS n FROM documents GROUP BY 1""")
def guard_counts(t):
    return agg.guard_counts(t("documents"), [("malformed", F.col("text").isNull()), ("short", F.length("text") < 400), ("window", F.col("lang") != "en")])


# ---------------------------------------------------------------- runs and state


@query("""WITH k AS (SELECT event_id, user_id, ts, event_type IN ('view', 'click') AS known FROM events),
    i AS (SELECT *, sum(CAST(NOT known AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM k),
    r AS (SELECT *, CASE WHEN known THEN sum(CAST(known AS INT)) OVER (PARTITION BY user_id, island ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) ELSE 0 END AS run FROM i),
    h AS (SELECT *, sum(CAST(run >= 3 AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS hit FROM r)
    SELECT event_id, CAST(run AS BIGINT) AS run, run >= 3 AND hit = 1 AS stop FROM h""")
def known_runs(t):
    got = windows.known_run(t("events"), F.col("event_type").isin("view", "click"), ["ts", "event_id"], ["user_id"], 3)
    return got.select("event_id", F.col("run").cast("long").alias("run"), "stop")


@query("""WITH s AS (SELECT *, sum(CAST(event_type IN ('purchase', 'signup') AS INT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS since FROM events)
    SELECT event_id, CAST(sum(CAST(event_type = 'error' AS INT)) OVER (PARTITION BY user_id, since ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS streak FROM s""")
def error_streaks(t):
    got = windows.streak(t("events"), F.col("event_type") == "error", F.col("event_type").isin("purchase", "signup"), ["ts", "event_id"], ["user_id"])
    return got.select("event_id", F.col("streak").cast("long").alias("streak"))


@query("""WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) FILTER (user_id % 50 = 0) AS n FROM events GROUP BY ALL)
    SELECT event_type, CAST(day AS VARCHAR) AS day, count(*) OVER w = 3 AND sum(n) OVER w = 0 AS silent FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def silent_days(t):
    days = t("events").groupBy("event_type", F.col("ts").cast("date").alias("day")).agg(F.count_if(F.col("user_id") % 50 == 0).alias("n"))
    return windows.silent_days(days, "n", "day", ["event_type"], 3).select("event_type", F.col("day").cast("string").alias("day"), "silent")


@query("""SELECT user_id, arg_max(event_type = 'error', (value, event_id)) AS capped FROM events GROUP BY user_id""")
def best_response(t):
    return t("events").groupBy("user_id").agg(F.max_by(F.col("event_type") == "error", F.struct("value", "event_id")).alias("capped"))


UPSERT = """old AS (SELECT doc_id, 1 AS p, lang, n_chars FROM documents WHERE doc_id % 3 <> 0),
    new AS (SELECT doc_id, 1 + CAST(doc_id % 2 AS INT) AS p, lang, CASE WHEN doc_id % 5 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents WHERE doc_id % 4 <> 0),
    c AS (SELECT new.*, CASE WHEN old.doc_id IS NULL THEN 'created' WHEN old.p > new.p THEN 'skipped'
      WHEN old.p = new.p AND old.lang IS NOT DISTINCT FROM new.lang AND old.n_chars IS NOT DISTINCT FROM new.n_chars THEN 'skipped' ELSE 'updated' END AS action
      FROM new LEFT JOIN old USING (doc_id))"""


def _halves(t):
    docs = t("documents")
    old = docs.filter("doc_id % 3 != 0").select("doc_id", F.lit(1).alias("p"), "lang", "n_chars")
    n = F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    new = docs.filter("doc_id % 4 != 0").select("doc_id", (1 + F.col("doc_id") % 2).cast("int").alias("p"), "lang", n.alias("n_chars"))
    return old, new


@query(f"WITH {UPSERT} SELECT doc_id, action FROM c")
def upsert_actions(t):
    old, new = _halves(t)
    return dml.classify_upsert(new, old, "doc_id", "p", ["lang", "n_chars"]).select("doc_id", "action")


@query(f"WITH {UPSERT} SELECT doc_id, p, lang, n_chars FROM c WHERE action <> 'skipped' UNION ALL SELECT * FROM old WHERE doc_id NOT IN (SELECT doc_id FROM c WHERE action <> 'skipped')")
def upsert_table(t):
    old, new = _halves(t)
    return dml.upsert(old, new, "doc_id", "p", ["lang", "n_chars"])


@query("SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, event_id) = 1")
def preferred_rows(t):
    return dml.preferred(t("events"), "user_id", [F.when(F.col("event_type") == "purchase", 0).otherwise(1), F.asc("event_id")]).select("user_id", "event_id")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def compacted_log(t):
    return dml.latest(t("events"), ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-20' - 3")
def kept_days(t):
    rows = t("events").withColumn("day", F.col("ts").cast("date"))
    return dml.kept_days(rows, "day", "2024-01-20", 3).select("event_id")


@query("SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-25'")
def kept_since(t):
    return dml.kept_since(t("events").withColumn("day", F.col("ts").cast("date")), "day", "2024-01-25").select("event_id")


@query("SELECT event_id FROM events QUALIFY dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC) <= 8")
def last_snapshots(t):
    return dml.snapshots(t("events").withColumn("day", F.col("ts").cast("date")), "day").select("event_id")


QUEUE = """q AS (SELECT event_id AS id, CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'leasing' WHEN 'error' THEN 'error' ELSE 'done' END AS status,
    CAST(user_id % 4 AS INT) AS attempts, ts AS leased, CASE WHEN event_id % 3 = 0 THEN 'timeout' WHEN event_id % 7 = 0 THEN 'not found' END AS error FROM events)"""


def _queue(t):
    kind = F.col("event_type")
    status = F.when(kind == "view", "pending").when(kind == "click", "leasing").when(kind == "error", "error").otherwise("done")
    error = F.when(F.col("event_id") % 3 == 0, "timeout").when(F.col("event_id") % 7 == 0, "not found")
    return t("events").select(F.col("event_id").alias("id"), status.alias("status"), (F.col("user_id") % 4).cast("int").alias("attempts"), F.col("ts").alias("leased"), error.alias("error"))


@query(f"""WITH {QUEUE}, r AS (SELECT id, CASE WHEN status = 'leasing' AND leased < TIMESTAMP '2024-01-15' THEN 'pending' ELSE status END AS status FROM q),
    c AS (SELECT id FROM r WHERE status = 'pending' ORDER BY id LIMIT 25)
    SELECT id, CASE WHEN id IN (SELECT id FROM c) THEN 'leasing' ELSE status END AS status, CASE WHEN id IN (SELECT id FROM c) THEN 'w1' END AS owner FROM r""")
def lease_claims(t):
    cutoff = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return dml.claimed(dml.reclaimed(_queue(t), "status", "leased", cutoff), "id", "status", 25, "w1").select("id", "status", "owner")


@query(f"""WITH {QUEUE} SELECT id, CASE WHEN status <> 'leasing' THEN status WHEN error IS NULL THEN 'done' WHEN error = 'not found' OR attempts + 1 >= 3 THEN 'error' ELSE 'pending' END AS status,
    CASE WHEN status = 'leasing' AND error IS NOT NULL THEN attempts + 1 ELSE attempts END AS attempts FROM q""")
def lease_releases(t):
    return dml.released(_queue(t), "status", "attempts", "error", "not found", 3).select("id", "status", "attempts")


@query(f"""WITH {QUEUE} SELECT doc_id, CASE WHEN n_chars > 3000 THEN 'has_result' WHEN status IN ('pending', 'leasing', 'done') THEN status
    WHEN status = 'error' AND attempts >= 2 THEN 'gave_up' ELSE 'enqueue' END AS decision FROM documents LEFT JOIN q ON q.id = doc_id * 3""")
def enqueue_decisions(t):
    items = t("documents").select("doc_id", "n_chars", (F.col("doc_id") * 3).alias("id"))
    return dml.enqueue_decision(items, _queue(t), "id", F.col("n_chars") > 3000, 2).select("doc_id", "decision")


@query("""WITH d AS (SELECT doc_id, coalesce(doc_id % 3, 0) AS third FROM documents) SELECT doc_id FROM d WHERE third <> 0
    UNION ALL SELECT doc_id FROM d WHERE third <> 1 AND doc_id NOT IN (SELECT doc_id FROM d WHERE third <> 0)""")
def inserted_if_absent(t):
    """Two thirds of all documents, then two thirds of which half are there."""
    docs, third = t("documents").select("doc_id"), F.coalesce(F.pmod("doc_id", F.lit(3)), F.lit(0))
    return dml.inserted_if_absent(docs.filter(third != 0), docs.filter(third != 1), "doc_id")


@query("""SELECT s_suppkey, s_nationkey, s_name FROM supplier WHERE s_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey % 5 = 0)
    UNION ALL SELECT s_suppkey, s_nationkey, upper(s_name) FROM supplier WHERE s_suppkey % 5 = 0""")
def replaced_children(t):
    s = t("supplier").select("s_suppkey", "s_nationkey", "s_name")
    return dml.replaced_children(s, s.filter("s_suppkey % 5 = 0").withColumn("s_name", F.upper("s_name")), "s_nationkey")


# ---------------------------------------------------------------- time

PT = "CAST(timezone('America/Los_Angeles', timezone('UTC', ts)) AS DATE)"


@query(f"SELECT CAST({PT} AS VARCHAR) AS day, count(*) AS n FROM events GROUP BY 1")
def pt_day_counts(t):
    return t("events").groupBy(scalars.pt_day(F.col("ts").cast("timestamp")).cast("string").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT CAST(epoch(time_bucket(INTERVAL '6 hours', ts)) AS BIGINT) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def tumbling_windows(t):
    rows = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    got = rows.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return got.select(F.unix_timestamp("w.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""SELECT (CAST(floor(epoch(ts)) AS BIGINT) // 3600 - k) * 3600 AS start, count(*) AS n FROM events, range(0, 4) r(k) GROUP BY ALL""")
def sliding_windows(t):
    rows = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.groupBy(F.window("ts", "4 hours", "1 hour").alias("w")).agg(F.count("*").alias("n")).select(F.unix_timestamp("w.start").alias("start"), "n")


@query("""WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL '8 hours' THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
    SELECT user_id, epoch_us(min(ts)) AS start, count(*) AS n FROM s GROUP BY user_id, session""")
def session_windows(t):
    rows = t("events").withColumn("ts", F.col("ts").cast("timestamp"))
    got = rows.groupBy("user_id", F.session_window("ts", "8 hours").alias("w")).agg(F.count("*").alias("n"))
    return got.select("user_id", F.unix_micros("w.start").alias("start"), "n")


@query(f"SELECT event_id FROM events QUALIFY row_number() OVER (PARTITION BY {PT}, user_id, event_type ORDER BY ts, event_id) = 1")
def first_seen_in_day(t):
    rows = t("events").withColumn("day", scalars.pt_day(F.col("ts").cast("timestamp")))
    w = Window.partitionBy("day", "user_id", "event_type").orderBy("ts", "event_id")
    return rows.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("event_id")


@query("""SELECT k AS part, epoch(TIMESTAMP '2024-01-01') + k * 43200 AS since, epoch(TIMESTAMP '2024-01-01') + (k + 1) * 43200 AS until FROM range(0, 4) r(k)""".replace("epoch(TIMESTAMP '2024-01-01')", "CAST(epoch(TIMESTAMP '2024-01-01') AS BIGINT)"))
def day_splits(t):
    one = t("region").limit(1)
    parts = planning.day_splits(F.lit("2024-01-01").cast("timestamp"), F.lit("2024-01-03").cast("timestamp"), 4)
    rows = one.select(F.posexplode(parts).alias("part", "w"))
    return rows.select(F.col("part").cast("long").alias("part"), F.unix_timestamp("w.since").alias("since"), F.unix_timestamp("w.until").alias("until"))


@query("SELECT event_id, CAST(floor(epoch(ts + INTERVAL '14 days')) AS BIGINT) AS matures, ts + INTERVAL '14 days' <= TIMESTAMP '2024-02-01' AS mature FROM events")
def maturity(t):
    due = F.col("ts").cast("timestamp") + F.expr("INTERVAL 14 DAYS")
    return t("events").select("event_id", F.unix_timestamp(due).alias("matures"), (due <= F.lit("2024-02-01").cast("timestamp")).alias("mature"))


# ---------------------------------------------------------------- evaluation

EVAL = "ev AS (SELECT doc_id, quality = 1 AS y, n_chars AS s FROM labels JOIN documents USING (doc_id))"


def _eval(t):
    return t("labels").join(t("documents"), "doc_id").select("doc_id", (F.col("quality") == 1).alias("y"), F.col("n_chars").alias("s"))


@query(f"WITH {EVAL} SELECT avg(CAST(y AS DOUBLE)) AS precision FROM (SELECT y FROM ev ORDER BY s DESC, doc_id LIMIT 50)")
def precision_at_k(t):
    return ev.precision_at(_eval(t), F.col("y"), [F.desc("s"), F.asc("doc_id")], 50)


@query(f"""WITH {EVAL}, r AS (SELECT y, row_number() OVER (ORDER BY s DESC, doc_id) AS rn FROM ev QUALIFY rn <= 50), p AS (SELECT count(*) FILTER (y) AS p FROM ev)
    SELECT round((SELECT sum(CAST(y AS INT) / log2(rn + 1)) FROM r) / (SELECT sum(1 / log2(i + 1)) FROM range(1, 51) t(i) WHERE i <= p), 9) AS ndcg FROM p""")
def ndcg_at_k(t):
    return ev.ndcg_at(_eval(t), F.col("y"), [F.desc("s"), F.asc("doc_id")], 50).select(F.round("ndcg", 9).alias("ndcg"))


@query(f"""WITH {EVAL} SELECT round(avg(CASE WHEN a.s > b.s THEN 1.0 WHEN a.s = b.s THEN 0.5 ELSE 0 END), 9) AS auc FROM ev a, ev b WHERE a.y AND NOT b.y""")
def auc_score(t):
    return ev.auc(_eval(t), F.col("y"), F.col("s")).select(F.round("auc", 9).alias("auc"))


@query(f"""WITH {EVAL}, c AS (SELECT s, count(*) FILTER (y) AS p, count(*) FILTER (NOT y) AS n FROM ev GROUP BY s)
    SELECT CAST(s AS DOUBLE) AS threshold, round(sum(p) OVER w / sum(p) OVER (), 9) AS tpr, round(sum(n) OVER w / sum(n) OVER (), 9) AS fpr FROM c WINDOW w AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)""")
def roc_points(t):
    return ev.roc(_eval(t), F.col("y"), F.col("s")).select("threshold", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


@query("SELECT CASE WHEN event_type IN ('purchase', 'signup') THEN 'positive' WHEN event_type = 'error' THEN 'negative' ELSE 'unlabelled' END AS class, count(*) AS n FROM events GROUP BY 1")
def label_classes(t):
    return ev.label_counts(t("events"), "event_type", ["purchase", "signup"], ["error"], ["random"])


@query(f"""WITH {EVAL} SELECT CAST(g AS DOUBLE) AS gate, count(*) AS n, count(*) FILTER (y) AS positives, round(avg(CAST(y AS DOUBLE)), 9) AS precision
    FROM ev, (VALUES (500.0), (1000.0), (2000.0), (4000.0)) v(g) WHERE s >= g GROUP BY g""")
def gate_sweep(t):
    return ev.sweep(_eval(t), "s", F.col("y"), [500, 1000, 2000, 4000]).withColumn("precision", F.round("precision", 9))


@query("SELECT CAST(b AS DOUBLE) AS baseline, count(*) FILTER (c_acctbal < 0 AND c_acctbal + b >= 0) AS flips FROM customer, (VALUES (100.0), (500.0), (2000.0)) v(b) GROUP BY b")
def baseline_flips(t):
    return ev.flips(t("customer"), "c_acctbal", [100, 500, 2000])


@query("""WITH t AS (SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20), r AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS a, row_number() OVER (ORDER BY doc_id) AS b FROM t)
    SELECT (SELECT count(*) FROM r x SEMI JOIN r y USING (doc_id)) = count(*) AS same_set, bool_and(a = b) AS identical FROM r""")
def selection_parity(t):
    top = t("documents").orderBy(F.desc("n_chars"), "doc_id").limit(20)
    a = top.withColumn("at", F.row_number().over(Window.orderBy(F.desc("n_chars"), "doc_id")))
    b = top.withColumn("at", F.row_number().over(Window.orderBy("doc_id")))
    return ev.parity(a, b, "doc_id", "at")


@query("""SELECT a.p_partkey AS p, a.p_retailprice - b.p_retailprice <= 50 AND a.p_retailprice >= 1000 AS near FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1""")
def near_pairs(t):
    part = t("part").select("p_partkey", "p_retailprice")
    a = part.select(F.col("p_partkey").alias("p"), F.col("p_retailprice").alias("x"))
    b = part.select((F.col("p_partkey") - 1).alias("p"), F.col("p_retailprice").alias("y"))
    return ev.near_pairs(a, b, "p", "x", "y", 50.0, 1000.0).select("p", "near")


@query("""WITH b AS (SELECT CAST(ts AS DATE) AS day, event_type AS g, 'u' || user_id AS u, max(value) AS v FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-10', DATE '2024-01-11') GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY v DESC, g, u) AS r FROM b), top AS (SELECT * FROM r WHERE r <= 40),
    t AS (SELECT g, u, r FROM top WHERE day = DATE '2024-01-11'), y AS (SELECT g, u, r FROM top WHERE day = DATE '2024-01-10'),
    e AS (SELECT t.g, t.u, t.r, y.r AS yr FROM t JOIN y ON t.g = y.g AND t.u = y.u),
    rt AS (SELECT g, u, r, row_number() OVER (PARTITION BY g ORDER BY r) AS n FROM t WHERE (g, u) NOT IN (SELECT (g, u) FROM e)),
    ry AS (SELECT g, u AS yu, r AS yr, row_number() OVER (PARTITION BY g ORDER BY r) AS n FROM y WHERE (g, u) NOT IN (SELECT (g, u) FROM e)),
    a AS (SELECT g, coalesce(u, yu) AS u, r, yr FROM rt FULL JOIN ry USING (g, n) UNION ALL SELECT * FROM e)
    SELECT g AS event, u AS url, CASE WHEN yr IS NULL THEN 'new' WHEN r IS NULL THEN 'resolved' WHEN r = yr THEN 'unchanged' ELSE 'moved' END AS status FROM a""")
def brief_delta(t):
    day = F.col("ts").cast("date").cast("string")
    rows = t("events").filter(day.isin("2024-01-10", "2024-01-11")).groupBy(day.alias("day"), F.col("event_type").alias("g"), F.concat(F.lit("u"), "user_id").alias("u")).agg(F.max("value").alias("v"))
    top = rows.withColumn("r", F.row_number().over(Window.partitionBy("day").orderBy(F.desc("v"), "g", "u"))).filter("r <= 40").withColumn("m", F.lit("x"))
    return delta.brief_delta(top.filter("day = '2024-01-11'"), top.filter("day = '2024-01-10'"), "g", "u", "r", "m")


@query("SELECT doc_id, sha256('{\"doc_id\":' || doc_id || ',\"lang\":\"' || lang || '\"}') AS mark FROM documents")
def fingerprints_of_rows(t):
    rows = t("documents").select("doc_id", "lang", "n_chars")
    return rows.select("doc_id", delta.fingerprint(rows, ["n_chars"]).alias("mark"))


# ---------------------------------------------------------------- plans


@query("""SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN 'solo-' || c_custkey ELSE 'chunk-' || ((row_number() OVER (PARTITION BY c_acctbal > 9000 ORDER BY c_custkey) - 1) // 10) END AS chunk FROM customer""")
def handle_chunks(t):
    return planning.chunks(t("customer"), "c_custkey", 10, F.col("c_acctbal") > 9000).select("c_custkey", "chunk")


@query("SELECT n_nationkey, n_nationkey % 3 AS lane FROM nation WHERE (n_nationkey - 7 * 6 + 25 * 7) % 25 < 6")
def rotation_lanes(t):
    return planning.lanes(planning.rotation(t("nation"), "n_nationkey", 7, 6, 25), "n_nationkey", 3).select("n_nationkey", "lane")


@query()
def filled_chunks(t):
    rows = t("customer").select("c_custkey", "c_mktsegment", F.greatest("c_acctbal", F.lit(0.0)).alias("expected"))
    return planning.filled(rows, "c_custkey", "expected", 20000.0, 8, "c_mktsegment")


@query()
def diversified_pool(t):
    rows = t("embeddings").select(F.col("label").alias("pool"), "vec_id", (F.col("vec_id") % 97 / 97).alias("rel"), (F.col("vec_id") % 7).alias("who"), "embedding")
    return planning.diversified(rows, "pool", "vec_id", "rel", "who", "embedding", 5)
