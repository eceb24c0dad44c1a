"""Queries of the relational layer: filters, joins, sets, pages, exports."""

from pyspark.sql import Window, functions as F

from ..functions import scalars
from ..operators import graph, relational as rel, windows
from ..sources import readers, sinks
from .registry import query


@query("""SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en' AND lower(text) LIKE '%the%'
    ORDER BY n_chars DESC, doc_id LIMIT 20 OFFSET 20""")
def list_documents_page(t):
    rows = rel.filtered(t("documents"), equals={"lang": "en"}, contains=("the", ["text"]))
    return rel.page(rows.select("doc_id", "lang", "source", "n_chars"), [F.desc("n_chars"), F.asc("doc_id")], 2, 20)


@query("""SELECT doc_id, source FROM documents WHERE source IN ('src1', 'src2') AND lang = 'fr' AND n_chars > 500""")
def documents_by_filter(t):
    return rel.filtered(t("documents"), equals={"lang": "fr"}, isin={"source": ["src1", "src2"]}, where=F.col("n_chars") > 500).select("doc_id", "source")


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'moron') OR contains(lower(source), 'moron')
    OR contains(lower(text), 'license') OR contains(lower(source), 'license')""")
def keyword_filter(t):
    return t("documents").filter(rel.any_contains(["moron", "License"], ["text", "source"])).select("doc_id")


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey = 7 OR c_name = 'Customer#000000009'")
def by_either_id(t):
    return t("customer").filter((F.col("c_custkey") == 7) | (F.col("c_name") == "Customer#000000009")).select("c_custkey", "c_name")


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(text) BETWEEN 270 AND 600 AND instr(text, 'idiot') = 0")
def length_band(t):
    n = F.length("text")
    return t("documents").filter(n.between(270, 600) & (F.instr("text", "idiot") == 0)).select("doc_id", n.cast("long").alias("n"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 100 ORDER BY o_orderkey LIMIT 50")
def keyset_page(t):
    return rel.page_after(t("orders").select("o_orderkey"), "o_orderkey", 100, 50)


@query("""SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-06 12:00:00'""")
def time_window(t):
    return rel.in_window(t("events"), F.col("ts"), "2024-01-05 00:00:00", "2024-01-06 12:00:00").select("event_id", "user_id")


@query("SELECT event_id FROM events WHERE value >= 90 OR user_id IN (1, 2, 3)")
def floor_or_known(t):
    return rel.floor_or_known(t("events"), "value", 90.0, "user_id", [1, 2, 3]).select("event_id")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def uncategorized_docs(t):
    return rel.with_none(t("documents"), t("labels"), "doc_id").select("doc_id", "lang")


@query("SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)")
def labelled_toxic_docs(t):
    return rel.with_any(t("documents"), t("labels"), "doc_id", F.col("toxic") == 1).select("doc_id", "lang")


@query("""SELECT conv_id, sha256(string_agg(text, chr(1) ORDER BY turn)) AS digest, count(*) AS n
    FROM conversations GROUP BY conv_id""")
def conversation_texts(t):
    rows = t("conversations")
    joined = rel.joined_texts(rows, "conv_id", "text", "turn")
    n = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    return joined.join(n, "conv_id").select("conv_id", F.sha2("text", 256).alias("digest"), "n")


@query("SELECT conv_id, role, text FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1")
def first_turn_per_conv(t):
    return rel.first_of(t("conversations"), ["conv_id"], [F.asc("turn")]).select("conv_id", "role", "text")


@query("""SELECT n_nationkey, n_name, coalesce(string_agg(s_name, ',' ORDER BY s_acctbal DESC, s_suppkey), '') AS suppliers
    FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY ALL""")
def nested_suppliers(t):
    child = t("supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    rows = rel.nested(t("nation"), child, "n_nationkey", [F.desc("s_acctbal"), F.asc("s_suppkey")], ["s_suppkey", "s_name"], "items")
    return rows.select("n_nationkey", "n_name", F.array_join(F.transform("items", lambda x: x["s_name"]), ",").alias("suppliers"))


@query("""SELECT c_custkey, n_name, r_name, count(o_orderkey) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS spent
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""")
def customers_with_orders(t):
    spent = t("orders").groupBy("o_custkey").agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("spent"))
    # nation and region are fixed dimensions of 25 and 5 rows.
    places = t("nation").join(F.broadcast(t("region")), F.col("r_regionkey") == F.col("n_regionkey"))
    rows = t("customer").join(spent, F.col("o_custkey") == F.col("c_custkey"), "left").join(F.broadcast(places), F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.select("c_custkey", "n_name", "r_name", F.coalesce("orders", F.lit(0)).alias("orders"), F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"))


@query("""WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS p FROM documents WHERE lang = 'en' QUALIFY p <= 30),
    b AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS p FROM documents QUALIFY p <= 30),
    u AS (SELECT doc_id, 0 AS l, p FROM a UNION ALL SELECT doc_id, 1, p FROM b)
    SELECT doc_id, row_number() OVER (ORDER BY min(l * 1000000 + p), doc_id) AS position FROM u GROUP BY doc_id""")
def ordered_union(t):
    number = lambda *o: F.row_number().over(Window.orderBy(*o))
    docs = t("documents").select("doc_id", "lang", "n_chars")
    a = docs.filter("lang = 'en'").orderBy(F.desc("n_chars"), "doc_id").limit(30).withColumn("p", number(F.desc("n_chars"), "doc_id"))
    b = docs.orderBy("doc_id").limit(30).withColumn("p", number("doc_id"))
    return rel.ordered_union(a, b, key="doc_id", position="p").select("doc_id", F.col("position").cast("long").alias("position"))


@query("""SELECT user_id, max(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY user_id
    UNION ALL SELECT user_id, max(event_id) FROM events e WHERE event_type = 'click'
    AND NOT EXISTS (SELECT 1 FROM events v WHERE v.user_id = e.user_id AND v.event_type = 'view') GROUP BY user_id""")
def merged_prefer_new(t):
    last = lambda kind: t("events").filter(F.col("event_type") == kind).groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return rel.merged(last("click"), last("view"), "user_id")


@query("""WITH a AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 80),
    b AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view' AND value > 80),
    c AS (SELECT (SELECT count(*) FROM a JOIN b USING (user_id)) AS overlap, (SELECT count(*) FROM a ANTI JOIN b USING (user_id)) AS only_left,
        (SELECT count(*) FROM b ANTI JOIN a USING (user_id)) AS only_right)
    SELECT overlap, only_left, only_right, overlap / (overlap + only_left + only_right) AS jaccard FROM c""")
def set_overlap(t):
    some = lambda kind: t("events").filter((F.col("event_type") == kind) & (F.col("value") > 80))
    return rel.overlap(some("purchase"), some("view"), "user_id")


@query("""(SELECT DISTINCT user_id, 'missing' AS side FROM events WHERE event_type = 'error' AND value > 95
      AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 95))
    UNION ALL (SELECT DISTINCT user_id, 'extra' FROM events WHERE event_type = 'signup' AND value > 95
      AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 95))""")
def missing_and_extra(t):
    some = lambda kind: t("events").filter((F.col("event_type") == kind) & (F.col("value") > 95))
    return rel.missing_and_extra(some("error"), some("signup"), "user_id")


@query("""SELECT doc_id, '"' || doc_id || '","' || replace(source, '"', '""') || '","' || replace(coalesce(text, ''), '"', '""') || '"' AS line
    FROM documents""")
def csv_lines(t):
    return sinks.csv_lines(t("documents"), ["doc_id", "source", "text"]).select("doc_id", "line")


@query("""SELECT lang AS "key", count(*) AS n, string_agg(line, chr(10) ORDER BY line) AS page
    FROM (SELECT lang, '- ' || source || '/' || doc_id AS line FROM documents) GROUP BY lang""")
def index_pages(t):
    docs = t("documents").select(F.array("lang").alias("keys"), F.concat(F.lit("- "), "source", F.lit("/"), "doc_id").alias("line"))
    return sinks.index_page(docs, "keys", "line")


@query("""SELECT doc_id, sha256('---' || chr(10) || 'id: ' || doc_id || chr(10) || 'source: ' || source || chr(10) || '---' || chr(10) || chr(10)
    || '# ' || substr(text, 1, 30) || chr(10) || chr(10) || text) AS sha FROM documents""")
def notes(t):
    body = sinks.note({"id": F.col("doc_id"), "source": F.col("source")}, F.substring("text", 1, 30), F.col("text"))
    return t("documents").select("doc_id", F.sha2(body, 256).alias("sha"))


@query("""SELECT CAST(conv_id * 100 + turn AS VARCHAR) AS id, text, 'u' || conv_id AS handle, upper(role) AS name
    FROM conversations""")
def api_pages(t):
    """Pages in the shape of an API's answers, made from the table and read again."""
    row = F.struct(
        (F.col("conv_id") * 100 + F.col("turn")).cast("string").alias("id"), "text", F.col("role").alias("author_id"),
        F.lit("2024-01-01").alias("created_at"),
    )
    user = F.struct(F.col("role").alias("id"), F.concat(F.lit("u"), "conv_id").alias("username"), F.upper("role").alias("name"))
    # A conversation's turns are one page.
    pages = t("conversations").groupBy("conv_id").agg(F.collect_list(row).alias("data"), F.collect_set(user).alias("users"))
    pages = pages.select(F.to_json(F.struct("data", F.struct("users").alias("includes"))).alias("json"))
    return readers.api_page(pages, "json").select("id", "text", "handle", "name")


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>', ' ', 'g'),
    '(?s)<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text, regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1) AS title FROM pages""".replace("\\\\", "\\"))
def page_texts(t):
    html = F.col("html")
    return t("pages").select("page_id", scalars.stripped_tags(html).alias("text"), F.regexp_extract(html, r"(?s)<title[^>]*>(.*?)</title>", 1).alias("title"))


@query("""SELECT n_name, n, round((400 + least(n, 50) * 4) * cos(2 * pi() * (rn - 1) / c), 3) AS x,
      round((400 + least(n, 50) * 4) * sin(2 * pi() * (rn - 1) / c), 3) AS y
    FROM (SELECT n_name, count(s_suppkey) AS n, row_number() OVER (ORDER BY count(s_suppkey) DESC, n_name) AS rn, count(*) OVER () AS c
      FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name)""")
def map_nodes(t):
    counts = t("supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    rows = t("nation").join(counts, "n_nationkey", "left").select("n_name", F.coalesce("n", F.lit(0)).alias("n"))
    return graph.map_nodes(rows, "n_name", "n")


@query("SELECT doc_id, CASE WHEN length(text) > 80 THEN substr(text, 1, 77) || '...' ELSE text END AS label FROM documents ORDER BY n_chars DESC, doc_id LIMIT 66")
def map_labels(t):
    return t("documents").orderBy(F.desc("n_chars"), "doc_id").limit(66).select("doc_id", graph.clipped(F.col("text")).alias("label"))


@query("""SELECT doc_id, round(1 - (row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) / count(*) OVER (), 9) AS position_score
    FROM (SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 80)""")
def positional_scores(t):
    top = t("documents").orderBy(F.desc("n_chars"), "doc_id").limit(80)
    rows = windows.positional(top, [F.desc("n_chars"), F.asc("doc_id")])
    return rows.select("doc_id", F.round("position_score", 9).alias("position_score"))
