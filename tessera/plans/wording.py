"""Queries of wording: slugs, names, references, cuts, Markdown, echoes, scripts, languages."""

from pyspark.sql import functions as F

from ..functions import lists, wording as w
from .registry import query

GIVEN = "p_name || ' & ' || p_brand || ' #' || p_size"


@query(f"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(s)), '[^a-z0-9\\s-]', '', 'g'), '\\s+', '-', 'g'), '-+', '-', 'g'), '^-|-$', '', 'g') AS category,
      regexp_replace(regexp_replace(replace(lower(trim(s)), '&', 'and'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS note,
      regexp_replace(regexp_replace(replace(lower(s), '&', ' and '), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS topic
    FROM (SELECT p_partkey, {GIVEN} AS s FROM part)""")
def slug_variants(t):
    s = F.concat_ws("", "p_name", F.lit(" & "), "p_brand", F.lit(" #"), "p_size")
    return t("part").select("p_partkey", w.category_slug(s).alias("category"), w.note_slug(s).alias("note"), w.topic_slug(F.concat(F.lit("#"), s)).alias("topic"))


@query("""SELECT c_custkey, CASE WHEN rn = 1 THEN s ELSE s || '-' || (rn - 1) END AS slug FROM (SELECT c_custkey, lower(c_mktsegment) AS s,
    row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS rn FROM customer)""")
def unique_slugs(t):
    rows = t("customer").select("c_custkey", w.note_slug(F.col("c_mktsegment")).alias("s"))
    return w.unique_slugs(rows, "s", [F.asc("c_custkey")], "slug").select("c_custkey", "slug")


CLEAN = """trim(regexp_replace(trim(regexp_replace(regexp_replace({0}, '[<>:"/\\\\|?*\\n\\r]', '', 'g'), '\\s+', ' ', 'g')), '^\\.+|\\.+$', '', 'g'))"""


@query(f"""SELECT page_id, {CLEAN.format("url || '...'")} AS file, 'unknown-date - @' || CASE WHEN page_id % 3 = 0 THEN 'unknown' ELSE {CLEAN.format("regexp_extract(url, '//([^/]+)', 1)")} END
    || ' - ' || page_id || '.md' AS note FROM pages""")
def file_names(t):
    host = F.when(F.col("page_id") % 3 != 0, F.regexp_extract("url", "//([^/]+)", 1))
    name = w.note_name(F.lit(None).cast("string"), host, F.col("page_id").cast("string"))
    return t("pages").select("page_id", w.file_name(F.concat("url", F.lit("..."))).alias("file"), name.alias("note"))


@query("""SELECT page_id, chr(CAST(page_id % 5000 + 200 AS INT)) || '<' || chr(CAST(page_id % 90 + 33 AS INT)) || '&#0;&lt;' || CASE WHEN page_id % 2 = 0 THEN '😀' ELSE '&#xD800;' END AS text FROM pages""")
def decoded_references(t):
    k = F.col("page_id")
    raw = F.concat(F.lit("&#"), (k % 5000 + 200).cast("string"), F.lit(";&lt;&#x"), F.hex(k % 90 + 33), F.lit(";&#0;&amp;lt;"), F.when(k % 2 == 0, "&#x1F600;").otherwise("&#xD800;"))
    return t("pages").select("page_id", w.references_decoded(raw).alias("text"))


STRIP = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"
RSTRIP = "regexp_replace({0}, '\\s+$', '')"


@query(f"""WITH s AS (SELECT doc_id, {STRIP.format("coalesce(text, '')")} AS t FROM documents), c AS (SELECT *, length(regexp_extract(substr(t, 1, 280), '(?s)^(.*[.!?](?:\\s|$))', 1)) AS se,
      length(regexp_extract(substr(t, 1, 280), '(?s)^(.*)\\n', 1)) AS li, length(regexp_extract(substr(t, 1, 280), '(?s)^(.*) ', 1)) AS wo FROM s),
    a AS (SELECT *, CASE WHEN se >= 140 OR li >= 140 THEN greatest(CASE WHEN se >= 140 THEN se ELSE 0 END, CASE WHEN li >= 140 THEN li ELSE 0 END) WHEN wo >= 140 THEN wo ELSE 280 END AS n FROM c)
    SELECT doc_id, CASE WHEN length(t) <= 280 THEN t ELSE {RSTRIP.format("substr(t, 1, n)")} || ' …' END AS cut FROM a""")
def natural_cuts(t):
    return t("documents").select("doc_id", w.natural_cut(F.col("text")).alias("cut"))


LEAD = "(?i)^(?:🚨|⚡️?|breaking|just in|new|update|exclusive|alert|news)\\s*[:\\-—]?\\s*"


@query(f"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split_regex(regexp_replace({STRIP.format(f"regexp_replace('News: ' || coalesce(text, ''), '{LEAD}', '')")},
        '([.!?。！？])\\s', '\\1' || chr(10), 'g'), '\\n'), lambda p: {STRIP.format("p")}), lambda p: p <> '') AS p FROM documents),
    g AS (SELECT doc_id, regexp_replace(CASE WHEN len(p) = 0 THEN '' ELSE list_reduce(p, lambda a, x: CASE WHEN length(a) < 40 THEN a || ' ' || x ELSE a END) END, '[:\\-—, ]+$', '') AS g FROM s),
    c AS (SELECT doc_id, g, {RSTRIP.format("substr(g, 1, 90)")} AS c FROM g)
    SELECT doc_id, CASE WHEN length(g) <= 90 THEN g ELSE regexp_replace(CASE WHEN length(regexp_extract(c, '(?s)^(.*) ', 1)) > 45 THEN {RSTRIP.format("regexp_extract(c, '(?s)^(.*) ', 1)")} ELSE c END,
      '[:\\-—,;]+$', '') || '…' END AS label FROM c""")
def labels_of_texts(t):
    return t("documents").select("doc_id", w.word_clip(w.gist(F.concat(F.lit("News: "), F.coalesce("text", F.lit(""))))).alias("label"))


@query("""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace('# ' || coalesce(text, '') || chr(10) || '12. _end_', '([\\\\*_~|`>])', '\\\\\\1', 'g'), '(?m)^([^\\S\\n]*)([#-])', '\\1\\\\\\2', 'g'),
    '(?m)^([^\\S\\n]*)([0-9]+)\\.([^\\S\\n])', '\\1\\2\\\\.\\3', 'g') AS shown FROM documents""")
def escaped_markdown(t):
    body = F.concat(F.lit("# "), F.coalesce("text", F.lit("")), F.lit("\n12. _end_"))
    return t("documents").select("doc_id", w.escaped_markdown(body).alias("shown"))


PAIR = "(?s)\\*\\*(.+?)\\*\\*|__(.+?)__|\\*(.+?)\\*|_(.+?)_"


def _rounds(x, n):
    return x if n == 0 else f"regexp_replace({_rounds(x, n - 1)}, '{PAIR}', '\\1\\2\\3\\4', 'g')"


@query(f"""SELECT p_partkey, {STRIP.format(f"regexp_replace(regexp_replace({_rounds('s', 5)}, '[*]{{2,}}|_{{2,}}', '', 'g'), '[ \\t]{{2,}}', ' ', 'g')")} AS plain
    FROM (SELECT p_partkey, '***' || p_name || '*** __' || p_brand || '__ a_b **' || p_type || ' *x* ***' AS s FROM part)""")
def plain_emphasis(t):
    s = F.concat(F.lit("***"), "p_name", F.lit("*** __"), "p_brand", F.lit("__ a_b **"), "p_type", F.lit(" *x* ***"))
    return t("part").select("p_partkey", w.plain_emphasis(s).alias("plain"))


@query("""WITH p AS (SELECT page_id, regexp_extract_all(lower(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)), '([a-z0-9]+)', 1) AS t,
      regexp_extract_all(lower(regexp_extract(html, '(?s)<p>(.*?)</p>', 1)), '([a-z0-9]+)', 1) AS s FROM pages),
    d AS (SELECT *, list_distinct(s) AS ds, len(list_filter(list_distinct(s), lambda x: list_contains(t, x))) AS shared FROM p)
    SELECT page_id, CASE WHEN len(s) = 0 THEN true WHEN len(t) = 0 THEN false WHEN contains(array_to_string(t, ' '), array_to_string(s, ' ')) OR contains(array_to_string(s, ' '), array_to_string(t, ' ')) THEN true
      ELSE (len(ds) <= 4 AND shared = len(ds)) OR shared / len(ds) > 0.4 END AS echo FROM d""")
def headline_echoes(t):
    title, first = F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1), F.regexp_extract("html", "(?s)<p>(.*?)</p>", 1)
    return t("pages").select("page_id", w.echoes(title, first).alias("echo"))


FOREIGN = ["", " こんにちは", " 안녕하세요", " 你好世界", " привет", " مرحبا", " שלום", " สวัสดี", " नमस्ते", " é你"]
TOK = "list_filter(string_split_regex(lower(regexp_replace(text, 'https?://\\S+|[@#]\\w+', ' ', 'g')), '[^a-zà-öø-ÿœ''’]+'), lambda x: x <> '')"


def _sql_words(words):
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in words) + "]"


@query(f"""WITH d AS (SELECT doc_id, text || {_sql_words(FOREIGN)}[doc_id % 10 + 1] AS f, {TOK} AS t FROM documents),
    c AS (SELECT *, {", ".join(f"len(list_filter(t, lambda x: list_contains({_sql_words(ws)}, x))) AS h{i}" for i, ws in enumerate(lists.LANGUAGES.values()))},
      len(list_filter(t, lambda x: list_contains({_sql_words(lists.ENGLISH_WORDS)}, x))) AS en FROM d),
    b AS (SELECT *, greatest(h0, h1, h2, h3, h4) AS best FROM c)
    SELECT doc_id, CASE {" ".join(f"WHEN len(regexp_extract_all(f, '[{c}]')) >= 3 THEN '{n}'" for n, c in lists.SCRIPTS)} END AS script,
      CASE WHEN len(t) >= 6 AND best >= 4 AND best > 2 * en AND best / len(t) >= 0.12 THEN CASE {" ".join(f"WHEN h{i} = best THEN '{n}'" for i, n in enumerate(lists.LANGUAGES))} END END AS language FROM b""")
def scripts_and_languages(t):
    more = F.element_at(F.array(*[F.lit(x) for x in FOREIGN]), (F.col("doc_id") % 10 + 1).cast("int"))
    return t("documents").select("doc_id", w.script_of(F.concat("text", more)).alias("script"), w.latin_language(F.col("text")).alias("language"))


@query("""SELECT event_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS since, CAST(epoch(date_trunc('day', ts + INTERVAL '30 hours')) AS BIGINT) + 86400 AS until FROM events""")
def widened_windows(t):
    ts = F.col("ts").cast("timestamp")
    b = w.day_bounds(ts, ts + F.expr("INTERVAL 30 HOURS"))
    return t("events").select("event_id", F.unix_timestamp(b["since"]).alias("since"), F.unix_timestamp(b["until"]).alias("until"))


@query("""SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL""")
def merged_counters(t):
    """Counters of two halves of the events, merged as maps and taken apart again."""
    per = t("events").groupBy("user_id", (F.col("event_id") % 2).alias("half"), "event_type").agg(F.count("*").alias("n"))
    maps = per.groupBy("user_id", "half").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    none = F.create_map().cast("map<string,bigint>")
    a, b = (maps.filter(f"half = {h}").select("user_id", F.col("m").alias(f"m{h}")) for h in (0, 1))
    both = a.join(b, "user_id", "full").select("user_id", w.merged_counts(F.coalesce("m0", none), F.coalesce("m1", none)).alias("m"))
    return both.select("user_id", F.explode("m").alias("event_type", "n"))


HOSTS = ["github.com", "gist.github.com", "mygithub.com", "hub.docker.com", "x.hub.docker.com", "blog.openai.com", "example.org", "t.me", "aws.amazon.com", "notion.so"]


@query(f"""WITH h AS (SELECT page_id, {_sql_words(HOSTS)}[page_id % 10 + 1] AS h FROM pages),
    k(i, d, tool) AS (VALUES {", ".join(f"({i}, '{d}', '{x}')" for i, (d, x) in enumerate(lists.TOOL_DOMAINS.items()))})
    SELECT page_id, coalesce((SELECT tool FROM k WHERE d = h), (SELECT arg_min(tool, i) FROM k WHERE ends_with(h, d))) AS tool FROM h""")
def tools_by_domain(t):
    host = F.element_at(F.array(*[F.lit(x) for x in HOSTS]), (F.col("page_id") % 10 + 1).cast("int"))
    return t("pages").select("page_id", w.tool_of_host(host).alias("tool"))
