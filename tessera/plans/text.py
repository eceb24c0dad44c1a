"""Queries of the text layer: search, vectors, URLs, sketches, events, enrichment."""

from pyspark.sql import Window, functions as F

from ..functions import fixed, scalars
from ..operators import dedup, profile, search, windows
from .registry import query

QUERY = "the nation of idiot clown"
TERMS = ["nation", "idiot", "clown"]


def _words(values):
    return ", ".join(f"'{v}'" for v in values)


TOKENS = "list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda w: w <> '')"

BM25 = f"""
    d AS (SELECT doc_id, text, source, {TOKENS} AS w FROM documents),
    c AS (SELECT *, len(w) AS dl, {", ".join(f"len(list_filter(w, lambda x: x = '{x}')) AS tf{i}" for i, x in enumerate(TERMS))} FROM d),
    s AS (SELECT count(*) AS n, avg(dl) AS a, {", ".join(f"count(*) FILTER (tf{i} > 0) AS df{i}" for i in range(3))} FROM c),
    b AS (SELECT doc_id, text, source, {" + ".join(f"greatest(ln((n - df{i} + 0.5) / (df{i} + 0.5)), 1e-6) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * dl / a))" for i in range(3))} AS rank
        FROM c, s WHERE tf0 + tf1 + tf2 > 0)"""


@query(f"WITH {BM25} SELECT doc_id, round(rank, 6) AS rank FROM b ORDER BY b.rank DESC, doc_id LIMIT 50")
def bm25_topk(t):
    hits = search.bm25(t("documents"), "doc_id", "text", TERMS).orderBy(F.desc("rank"), "doc_id").limit(50)
    return hits.select("doc_id", F.round("rank", 6).alias("rank"))


@query(f"""WITH d AS (SELECT doc_id, unnest({TOKENS}) AS term FROM documents)
    SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM d GROUP BY term HAVING count(DISTINCT doc_id) >= 20""")
def postings_terms(t):
    index = search.postings(t("documents"), "doc_id", "text")
    return index.groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df")).filter("df >= 20")


@query(f"""SELECT conv_id, turn, array_to_string(list_distinct_ordered[1:16], ' ') AS tokens FROM (
      SELECT conv_id, turn, list_filter(w, lambda x, i: length(x) >= 2 AND x NOT IN ({_words(fixed.SEARCH_STOP_WORDS)}) AND list_position(w, x) = i) AS list_distinct_ordered
      FROM (SELECT conv_id, turn, string_split_regex(lower(text), '[^a-z0-9]+') AS w FROM conversations))""")
def query_tokens(t):
    return t("conversations").select("conv_id", "turn", F.array_join(scalars.query_tokens(F.col("text")), " ").alias("tokens"))


@query(f"""SELECT conv_id, turn, array_to_string(list_filter(string_split_regex(regexp_replace(lower(text), '[^a-z0-9\\s]', ' ', 'g'), '\\s+'),
    lambda x: length(x) >= 2 AND x NOT IN ({_words(fixed.KEYWORD_STOP_WORDS)}))[1:10], ' ') AS keywords FROM conversations""")
def keywords(t):
    return t("conversations").select("conv_id", "turn", F.array_join(scalars.keywords(F.col("text")), " ").alias("keywords"))


@query(f"""SELECT doc_id FROM documents WHERE len(list_filter({TOKENS}, lambda w: starts_with(w, 'clo'))) > 0
    AND len(list_filter({TOKENS}, lambda w: starts_with(w, 'the'))) > 0""")
def prefix_search(t):
    return search.prefix_search(t("documents"), "text", ["clo", "the"]).select("doc_id")


LEXICAL = f"""least(1.0, ({" + ".join(f"CAST(contains(lower(coalesce(text, '')), '{x}') AS INT)" for x in TERMS)}) / 3.0
    + CASE WHEN contains(lower(coalesce(text, '')), '{QUERY}') THEN 0.2 ELSE 0 END)"""


@query(f"SELECT doc_id, round({LEXICAL}, 6) AS lexical FROM documents")
def lexical_scores(t):
    return t("documents").select("doc_id", F.round(search.lexical(F.col("text"), QUERY, TERMS), 6).alias("lexical"))


@query(f"""WITH {BM25}, h AS (SELECT doc_id, text, source FROM b ORDER BY rank DESC, doc_id LIMIT 80),
    s AS (SELECT doc_id, {LEXICAL} AS lexical, CASE WHEN source = 'src1' THEN 1.0 ELSE 0.3 END AS source_score FROM h)
    SELECT doc_id, round(0.42 + 0.17 * lexical + 0.03 * source_score, 6) AS score, round(lexical, 6) AS lexical FROM s
    ORDER BY 0.42 + 0.17 * lexical + 0.03 * source_score DESC, doc_id LIMIT 20""".replace("    s AS (SELECT count", "    s0 AS (SELECT count").replace("FROM c, s WHERE", "FROM c, s0 WHERE"))
def hybrid_search(t):
    got = search.hybrid(t("documents"), "doc_id", "text", QUERY, F.col("source") == "src1")
    return got.select("doc_id", F.round("score", 6).alias("score"), F.round("lexical", 6).alias("lexical"))


def _vector(t):
    """The query vector: that of the first row."""
    return [float(x) for x in t("embeddings").orderBy("vec_id").limit(1).first()["embedding"]]


Q = "q AS (SELECT CAST(embedding AS DOUBLE[]) AS qv FROM embeddings ORDER BY vec_id LIMIT 1)"
COS = "list_dot_product(CAST(embedding AS DOUBLE[]), qv) / (sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) * sqrt(list_dot_product(qv, qv)))"


@query(f"WITH {Q} SELECT vec_id, round({COS}, 6) AS score FROM embeddings, q ORDER BY {COS} DESC, vec_id LIMIT 25")
def knn_cosine(t):
    return search.knn(t("embeddings"), "vec_id", "embedding", _vector(t), 25).select("vec_id", F.round("score", 6).alias("score"))


@query(f"""WITH {Q} SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), qv), 6) AS distance,
    round(1 / (1 + list_distance(CAST(embedding AS DOUBLE[]), qv)), 6) AS score FROM embeddings, q
    ORDER BY list_distance(CAST(embedding AS DOUBLE[]), qv), vec_id LIMIT 25""")
def knn_l2(t):
    got = search.knn(t("embeddings"), "vec_id", "embedding", _vector(t), 25, "l2")
    return got.select("vec_id", F.round("distance", 6).alias("distance"), F.round("score", 6).alias("score"))


@query("""SELECT vec_id, round(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x / sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))))), 5) AS total
    FROM embeddings""")
def normalized_vectors(t):
    unit = search.normalized(F.col("embedding"))
    return t("embeddings").select("vec_id", F.round(F.aggregate(unit, F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


@query(f"""WITH {Q}, n AS (SELECT vec_id, {COS} AS score, label FROM embeddings, q ORDER BY score DESC, vec_id LIMIT 50),
    w AS (SELECT *, CASE label % 3 WHEN 0 THEN 1.0 WHEN 1 THEN 0.3 ELSE 0 END AS w FROM n),
    b AS (SELECT * FROM w WHERE w > 0 ORDER BY score DESC, vec_id LIMIT 5)
    SELECT round(sum(score * w) / sum(w), 6) AS affinity, count(*) AS n FROM b""")
def weighted_affinity(t):
    near = search.knn(t("embeddings"), "vec_id", "embedding", _vector(t), 50).join(t("embeddings").select("vec_id", "label"), "vec_id")
    weight = F.when(F.col("label") % 3 == 0, 1.0).when(F.col("label") % 3 == 1, 0.3).otherwise(0.0)
    return search.weighted_affinity(near, weight).select(F.round("affinity", 6).alias("affinity"), "n")


@query(f"""SELECT doc_id, {" + ".join(f"CAST(list_contains(string_split_regex(lower(text), '[^a-z0-9]+'), '{x}') AS INT) * {2**i}" for i, x in enumerate(TERMS))} AS bits FROM documents""")
def keyword_vectors(t):
    v = search.keyword_vector(F.col("text"), TERMS)
    return t("documents").select("doc_id", F.aggregate(F.transform(v, lambda x, i: x * F.pow(F.lit(2.0), i)), F.lit(0.0), lambda s, x: s + x).cast("int").alias("bits"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings WHERE label % 2 = 0)")
def missing_vectors(t):
    vectors = t("embeddings").select(F.col("vec_id").alias("doc_id"), F.when(F.col("label") % 2 == 0, "m1").otherwise("m2").alias("model"))
    return search.without_vector(t("documents"), vectors, "doc_id", "m1").select("doc_id")


@query()
def kmeans_clusters(t):
    rows = t("embeddings")
    return profile.kmeans(rows, "vec_id", "embedding", profile.clusters_for(rows.count())).withColumn("cluster", F.col("cluster").cast("int"))


HOST = "regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]+)', 1)), '^www\\.', '')"
CANONICAL = f"""(SELECT page_id, url, 'https://' || {HOST} || regexp_replace(regexp_extract(url, '^[^/]*//[^/?#]*([^?#]*)', 1), '/+$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_sort(kept), '&') ELSE '' END AS canonical
    FROM (SELECT page_id, url, list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT starts_with(lower(string_split(p, '=')[1]), 'utm_') AND lower(string_split(p, '=')[1]) NOT IN ({_words(fixed.TRACKING_PARAMETERS)})) AS kept FROM pages))"""


@query(f"SELECT page_id, canonical, sha256(canonical) AS url_hash, row_number() OVER (PARTITION BY canonical ORDER BY page_id) AS rank FROM {CANONICAL}")
def canonical_urls(t):
    rows = dedup.by_url(t("pages"), "url", [F.asc("page_id")])
    return rows.select("page_id", "canonical", "url_hash", F.col("rank").cast("long").alias("rank"))


@query()
def minhash_signatures(t):
    """The signatures of all documents over their whole texts."""
    rows = dedup.signatures(t("documents").select("doc_id", "text"), "text", 8).filter("signature is not null")
    return rows.select("doc_id", F.array_join(F.transform("signature", lambda x: x.cast("string")), ".").alias("signature"))


@query()
def minhash_pairs(t):
    """Documents whose whole texts are alike, every pair of them."""
    return dedup.similar_pairs(dedup.signatures(t("documents").select("doc_id", "text"), "text"), "doc_id")


@query()
def seen_before(t):
    titles = t("pages").select("page_id", "url", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))
    rows = dedup.signatures(dedup.by_url(titles, "url", [F.asc("page_id")]), "title")
    rows = rows.withColumn("day", F.pmod(F.floor(F.col("page_id") / 2), F.lit(5)))
    return dedup.check_seen(rows.filter("page_id % 2 = 1"), rows.filter("page_id % 2 = 0"), "page_id", "day", "url_hash", "signature")


SIGNIFICANT = f"""(SELECT doc_id, list_filter(regexp_extract_all(regexp_replace(regexp_replace(lower(coalesce(text, '')), 'https?://\\S+', ' ', 'g'), '@\\w+', ' ', 'g'), '([a-z0-9]+)', 1),
    lambda w: w NOT IN ({_words(fixed.EVENT_STOP_WORDS)}) AND NOT regexp_full_match(w, '[0-9]+')) AS w FROM documents)"""
GRAMS = f"""grams AS (SELECT DISTINCT doc_id, w[i] AS a, w[i + 1] AS b FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM {SIGNIFICANT})),
    g AS (SELECT *, a IN ({_words(fixed.GENERIC_WORDS)}) AS ga, b IN ({_words(fixed.GENERIC_WORDS)}) AS gb FROM grams),
    kept AS (SELECT doc_id, a || ' ' || b AS gram, NOT ga AND NOT gb AS strong FROM g
        WHERE NOT (ga AND gb) AND (NOT ga OR length(b) >= 3) AND (NOT gb OR length(a) >= 3))"""


@query(f"WITH {GRAMS} SELECT doc_id, count(*) AS n, count(*) FILTER (strong) AS strong FROM kept GROUP BY doc_id")
def event_bigrams(t):
    rows = t("documents").select("doc_id", F.explode(scalars.distinctive_bigrams(F.coalesce("text", F.lit("")))).alias("g"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if("g.strong").alias("strong"))


@query()
def event_groups(t):
    """Events by the bigrams of whole texts, strong and weak."""
    return dedup.event_groups(t("documents"), "doc_id", "text")


@query("""WITH k AS (SELECT doc_id, n_chars, lower(substr(text, 1, 80)) AS k, 'u' || doc_id AS url FROM documents)
    SELECT doc_id, row_number() OVER w AS rank, CASE WHEN row_number() OVER w > 1 THEN first_value(url) OVER w END AS lost_to
    FROM k WINDOW w AS (PARTITION BY k ORDER BY n_chars DESC, doc_id)""")
def event_winners(t):
    rows = t("documents").select("doc_id", "n_chars", F.lower(F.substring("text", 1, 80)).alias("k"), F.concat(F.lit("u"), "doc_id").alias("url"))
    got = windows.winners(rows, "k", [F.desc("n_chars"), F.asc("doc_id")], "url")
    return got.select("doc_id", F.col("rank").cast("long").alias("rank"), "lost_to")


@query("""SELECT doc_id, len(regexp_extract_all(text, '#(\\w+)', 1)) AS raw_tags, len(regexp_extract_all(text, '(https?://[^\\s)\\]]+)', 1)) AS raw_urls
    FROM documents""")
def raw_entities(t):
    n = lambda p: F.size(F.regexp_extract_all("text", F.lit(p), F.lit(1))).cast("long")
    return t("documents").select("doc_id", n(r"#(\w+)").alias("raw_tags"), n(r"(https?://[^\s)\]]+)").alias("raw_urls"))


@query()
def text_entities(t):
    rows = profile.entities(t("documents"), "text")
    return rows.select("doc_id", "hashtags", "mentions", "urls", "domains")


@query(f"""WITH e AS (SELECT doc_id, regexp_matches(text, '(?i)' || '{fixed.CODE_PATTERN}') AS has_code,
      regexp_matches(text, '(?i){fixed.LAUNCH_PATTERN}') AS is_launch, regexp_matches(text, '(?i){fixed.BENCHMARK_PATTERN}') AS is_benchmark,
      {", ".join(f"regexp_matches(text, '(?i){p}') AS r{i}" for i, (_, _, p) in enumerate(fixed.TOPIC_RULES))} FROM documents)
    SELECT doc_id, has_code, is_launch, is_benchmark,
      CASE WHEN has_code OR is_launch OR is_benchmark OR {" OR ".join(f"r{i}" for i, (_, c, _) in enumerate(fixed.TOPIC_RULES) if c in fixed.RELEVANT_CATEGORIES)}
        THEN 'brief-relevant' ELSE 'everything-else' END AS segment,
      {" + ".join(f"CAST(r{i} AS BIGINT)" for i in range(len(fixed.TOPIC_RULES)))} AS topics FROM e""")
def enriched_documents(t):
    rows = profile.enriched(t("documents"), "text")
    matched = F.size("rules").cast("long")
    return rows.select("doc_id", "has_code", "is_launch", "is_benchmark", "segment", matched.alias("topics"))


@query(f"""SELECT page_id, CASE WHEN h LIKE '%.example.com' THEN 'com' WHEN h LIKE '%.example.org' THEN 'org' END AS tool
    FROM (SELECT page_id, {HOST} AS h FROM pages)""")
def tool_by_host(t):
    pages = t("pages").select("page_id", scalars.host_of(F.col("url")).alias("host"))
    return profile.tools_of_hosts(pages, "host", {"example.com": "com", "example.org": "org"}).select("page_id", "tool")


@query("""SELECT conv_id, turn, len(w) < 4 OR length(array_to_string(w, ' ')) < 15 AS fragment FROM (SELECT conv_id, turn,
      list_filter(string_split_regex(regexp_replace(regexp_replace(regexp_replace(text, '(?i)https?://\\S+', ' ', 'g'), '^(?:\\s*@\\w+)+\\s*', ' '), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+'),
        lambda x: regexp_matches(x, '[\\p{L}\\p{N}]')) AS w FROM conversations)""")
def bare_fragments(t):
    return t("conversations").select("conv_id", "turn", scalars.is_bare_fragment(F.col("text")).alias("fragment"))


@query("""SELECT DISTINCT trim(regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM part""")
def part_slugs(t):
    return t("part").select(scalars.slug(F.col("p_name")).alias("slug")).distinct()


@query("""SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) AS place, count(*) AS n FROM documents GROUP BY source""")
def sources_line(t):
    n = t("documents").groupBy("source").agg(F.count("*").alias("n"))
    return n.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "source")).cast("long"))
