"""Queries of the checks beside a model's labels, first guesses, misses and gold bars."""

from pyspark.sql import functions as F

from ..functions import fixed, lists
from ..operators import backstops as b, evaluate as ev, scoring
from .ranking import SCORED_SQL, _labelled, _scored
from .registry import query
from .wording import _sql_words as _list

SOURCES = ["x", "reddit", "github", "hackernews", "Reddit"]
FORUMS = ["LocalLLaMA", "pics", "MachineLearning", "news"]
TITLES = ["model release", "the clown show?", "notes", "is this iptv-tool any good for a long evening at home?"]
EXTRAS = ["", " $ABC airdrop", " [free api credits] now", " back us on kickstarter", " $NVDA up 5%", " 【必見】 漢字漢字漢字漢字", " DM me, link in bio 🔥", " btc price web3"]


def _pick(values, by=1):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(F.floor(F.col("doc_id") / by), F.lit(len(values))) + 1).cast("int"))


def _items(t):
    """Documents as items of several sources; every second one is short, so that thin and bare ones are among them."""
    body = F.when(F.col("doc_id") % 2 == 0, F.coalesce("text", F.lit(""))).otherwise(F.concat(F.lit("so true "), "lang"))
    rows = t("documents").select("doc_id", _pick(SOURCES).alias("source"), _pick(FORUMS, 5).alias("f"), _pick(TITLES, 3).alias("title"), F.concat(body, _pick(EXTRAS, 7)).alias("body"))
    post = F.when(F.col("source") == "x", F.col("body"))
    return rows.select("doc_id", "source", F.concat(F.lit("https://www.reddit.com/r/"), "f", F.lit("/"), "doc_id").alias("url"), "title", F.col("body").alias("summary"), post.alias("tweet_text"))


def _sql_pick(values, by=1):
    return f"{_list(values)}[(doc_id // {by}) % {len(values)} + 1]"


ITEMS = f"""i0 AS (SELECT doc_id, {_sql_pick(SOURCES)} AS source, lower({_sql_pick(FORUMS, 5)}) AS f, {_sql_pick(TITLES, 3)} AS title,
      CASE WHEN doc_id % 2 = 0 THEN coalesce(text, '') ELSE 'so true ' || lang END || {_sql_pick(EXTRAS, 7)} AS body FROM documents),
    items AS (SELECT *, source = 'github' AS repo, lower(source) = 'reddit' AND list_contains({_list(lists.CURATED_FORUMS)}, f) AS curated,
      CASE WHEN source = 'x' THEN body ELSE title END AS item, CASE WHEN source = 'github' THEN trim(trim(title) || ' ' || trim(body)) WHEN source = 'x' THEN body ELSE title END AS topic FROM i0)"""


def _substance(c):
    plain = f"regexp_replace(regexp_replace(regexp_replace({c}, '(?i)https?://\\S+', ' ', 'g'), '^(?:\\s*@\\w+)+\\s*', ' '), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')"
    return f"list_filter(string_split_regex({plain}, '\\s+'), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]'))"


def _has(tokens, words):
    return f"len(list_filter({tokens}, lambda x: list_contains({_list(words)}, x))) > 0"


def _stems(tokens):
    return f"len(list_filter({tokens}, lambda x: regexp_matches(x, '^(?:{'|'.join(lists.TOPIC_STEMS)})'))) > 0"


def _contains(text, parts):
    return "(" + " OR ".join(f"contains({text}, '{p}')" for p in parts) + ")"


PHRASES = "|".join(p.replace("-", "\\-") for p in lists.OFF_TOPIC_REPOS)
TOPIC = f"""CASE WHEN {_has("tok", lists.OFF_TOPIC_WORDS)} THEN 'python:offtopic-marker' WHEN repo AND regexp_matches(topic, '(?i)(?:^|[^A-Za-z0-9])(?:{PHRASES})(?:$|[^A-Za-z0-9])') THEN 'github-offtopic-repo-marker'
    WHEN {_has("tok", lists.TOPIC_TOKENS)} OR {_stems("tok")} THEN NULL WHEN curated THEN 'source-curated-vouch' ELSE 'python:no-tech-tokens' END"""
BARE = "(len({0}) < 4 OR length(array_to_string({0}, ' ')) < 15)"
FRAGMENT = f"CASE WHEN curated THEN trim(item) = '' WHEN repo THEN {BARE.format('tw')} ELSE {BARE.format('iw')} END"
THIN = """(lower(source) = 'reddit' AND (length(trim(body)) < 110 OR (length(trim(title)) < 22 AND length(trim(body)) < 170))
    AND NOT (ends_with(trim(title), '?') AND (length(trim(title)) >= 40 OR length(trim(body)) >= 150)))"""
SIGNS = " + ".join(f"CAST(contains(low, '{x}') AS INT)" for x in lists.CRYPTO_WORDS)
SIGNS += f" + CAST({_contains('low', lists.COINS)} AND (contains(full_, '$') OR contains(low, 'price') OR contains(full_, '%')) AS INT) + CAST({_contains('full_', lists.CANDLES)} AS INT)"
JUNK = f"""CASE WHEN curated THEN NULL WHEN (regexp_matches(full_, '{lists.CASHTAG}') AND signs >= 1) OR signs >= 2 THEN 'crypto-ticker'
    WHEN regexp_matches(full_, '{lists.BRACKET_BAIT}') OR (regexp_matches(full_, '{lists.DM_BAIT}') AND (regexp_matches(full_, '{lists.LINK_BAIT}') OR contains(low, 't.co/'))
      AND ({_contains('full_', lists.HYPE_SIGNS)} OR regexp_matches(full_, '{lists.HYPE_CAPITALS}'))) THEN 'scam-grant'
    WHEN ({_contains('low', lists.CROWDFUNDING)} OR regexp_matches(full_, '{lists.RAISED}')) AND (NOT known OR {_contains('low', lists.CRYPTO_WORDS)}) THEN 'kickstarter-promo'
    WHEN letters - latin > latin AND NOT known AND regexp_matches(full_, '{lists.CLICKBAIT}') THEN 'foreign-clickbait' END"""
CHECKS = f"""{ITEMS}, w AS (SELECT *, list_transform({_substance("topic")}, lambda x: lower(x)) AS tok, {_substance("topic")} AS tw, {_substance("item")} AS iw,
      trim(CASE WHEN source = 'x' AND trim(body) <> '' THEN trim(body) ELSE trim(title || ' ' || body) END) AS full_ FROM items),
    v AS (SELECT *, lower(full_) AS low, regexp_extract_all(lower(full_), '([a-z0-9]+)', 1) AS an, len(regexp_extract_all(full_, '\\p{{L}}')) AS letters,
      len(regexp_extract_all(full_, '[A-Za-zªµºÀ-ÖØ-öø-ɏḀ-ỿ]')) AS latin FROM w),
    z AS (SELECT *, {SIGNS} AS signs, {_has("an", lists.MODEL_WORDS)} OR {_has("an", lists.TOPIC_TOKENS)} OR {_stems("an")} AS known FROM v),
    checks AS (SELECT doc_id, {TOPIC} AS topic_reason, {FRAGMENT} AS fragment, {THIN} AS thin, {JUNK} AS junk FROM z)"""


@query(f"WITH {CHECKS} SELECT doc_id, topic_reason, fragment, thin, junk FROM checks")
def label_checks(t):
    rows = b.checked(_items(t).join(scoring.labelled(_labelled(t)).drop("source", "n_chars"), "doc_id"))
    return rows.select("doc_id", "topic_reason", "fragment", "thin", "junk")


@query(f"""WITH {CHECKS}, {SCORED_SQL.split(", pts AS")[0]}, l AS (SELECT doc_id, n_chars, CASE WHEN fragment THEN 'reply_fragment' ELSE content_type END AS content_type,
      CASE WHEN thin AND actionability NOT IN ('context_only', 'none') THEN 'context_only' ELSE actionability END AS actionability, substance,
      CASE WHEN coalesce(topic_reason, '') NOT IN ('', 'source-curated-vouch') OR junk IS NOT NULL THEN 'off' ELSE on_topic END AS on_topic, junk, lab.source FROM lab JOIN checks USING (doc_id)),
    {SCORED_SQL.split("pts AS")[1].join(["pts AS", ""]).replace("FROM lab)", "FROM l)", 1)}
    SELECT doc_id, CASE WHEN junk IS NOT NULL THEN least(final, 49) ELSE final END AS final, on_topic, content_type FROM fin""")
def checked_scores(t):
    rows = _items(t).withColumnRenamed("source", "from").join(scoring.labelled(_labelled(t)).withColumnRenamed("source", "who"), "doc_id").withColumnRenamed("from", "source")
    rows = rows.withColumns({
        "engagement": F.col("n_chars") / 10.0, "known": F.col("doc_id") % 3 == 0, "leader": F.col("who") == "src1", "tracked": F.col("who") == "src2",
        "fit": F.col("doc_id") % 40 - 20.5, "hours": F.col("doc_id") % 200, "is_x": F.col("doc_id") % 2 == 0,
        "kind": F.when(F.col("doc_id") % 4 == 0, "video").when(F.col("doc_id") % 4 == 1, "photo"),
    })
    return b.scored(rows).select("doc_id", "final", "on_topic", "content_type")


@query("""SELECT event_id, CASE WHEN s <> '' THEN s IN ('x', 'twitter') ELSE event_id % 2 = 0 AND event_id % 3 <> 0 AND event_id % 7 <> 0 END AS is_x
    FROM (SELECT event_id, ['x', 'Twitter', '', 'hackernews', ''][event_id % 5 + 1] AS raw, lower(raw) AS s FROM events)""")
def posts_by_source(t):
    k = F.col("event_id")
    source = F.element_at(F.array(*[F.lit(x) for x in ["x", "Twitter", "", "hackernews", ""]]), (k % 5 + 1).cast("int"))
    got = b.is_x(source, F.when(k % 2 == 0, "post"), F.lit(None).cast("string"), F.when(k % 3 == 0, "title"), F.when(k % 7 == 0, k))
    return t("events").select("event_id", got.alias("is_x"))


TAGS = [["ai-ml"], ["politics"], ["ai-ml", "news"], ["crypto-web3", "ai-resources"], [], ["cooking"]]
GUESS = " ".join(f"WHEN {_contains('low', [x.replace(chr(39), chr(39) * 2) for x in words])} THEN '{name}'" for name, words in lists.FIRST_GUESS)


@query(f"""WITH d AS (SELECT doc_id, lower(coalesce(text, '') || ['', ' now available', ' how to', ' sota', ' buy now'][doc_id % 5 + 1]) AS low,
      [{", ".join(_list(x) for x in TAGS)}][doc_id % 6 + 1] AS tags FROM documents), c AS (SELECT *, len(list_filter(string_split_regex(low, '\\s+'), lambda x: x <> '')) AS n FROM d),
    k AS (SELECT *, CASE {GUESS} WHEN n > 12 THEN 'field_report' ELSE 'opinion' END AS kind FROM c)
    SELECT doc_id, kind AS content_type, CASE WHEN kind IN ('launch', 'tutorial', 'benchmark') THEN 'actionable_now' WHEN kind IN ('analysis', 'field_report') THEN 'reference' ELSE 'context_only' END AS actionability,
      CASE WHEN n > 14 THEN 'concrete' WHEN n > 6 THEN 'mixed' ELSE 'vague' END AS substance,
      CASE WHEN {_has("tags", lists.PRODUCTIVE_TAGS)} THEN 'core' WHEN {_has("tags", lists.EXCLUDED_TAGS)} THEN 'off' ELSE 'adjacent' END AS on_topic FROM k""")
def first_guesses(t):
    text = F.concat(F.coalesce("text", F.lit("")), _pick(["", " now available", " how to", " sota", " buy now"]))
    return t("documents").select("doc_id", b.first_guess(text, _tags()).alias("g")).select("doc_id", "g.*")


def _tags():
    return _pick_array(TAGS)


def _pick_array(values):
    sets = F.array(*[F.array(*[F.lit(x) for x in v]).cast("array<string>") for v in values])
    return F.element_at(sets, (F.col("doc_id") % len(values) + 1).cast("int"))


@query(f"""WITH d AS (SELECT doc_id, [{", ".join(_list(x) for x in TAGS)}][doc_id % 6 + 1] AS tags FROM documents), c AS (SELECT doc_id, {_has("tags", lists.PRODUCTIVE_TAGS)} AS g, {_has("tags", lists.EXCLUDED_TAGS)} AS x,
      {_has("tags", lists.COIN_TAGS)} AND {_has("tags", lists.STRONG_TAGS)} AS s FROM d)
    SELECT doc_id, CASE WHEN s OR (g AND NOT x) THEN 'positive' WHEN x AND NOT g THEN 'hard_neg' WHEN g AND x THEN 'mixed' ELSE 'neither' END AS class FROM c""")
def tag_classes(t):
    return t("documents").select("doc_id", b.tag_class(_tags()).alias("class"))


@query(f"""WITH {SCORED_SQL}, m AS (SELECT * FROM fin WHERE final < 58) SELECT count(*) AS missed, count(*) FILTER (doc_id % 2 = 0 AND doc_id % 3 <> 0 AND n_chars / 10.0 < 100) AS low_reach_capped,
    count(*) FILTER (fp < 0) AS pf_negative, count(*) FILTER (base < 52) AS low_base, count(*) FILTER (tp > 0) AS off_pen FROM m""")
def miss_causes(t):
    low = (F.col("doc_id") % 2 == 0) & (F.col("doc_id") % 3 != 0) & (F.col("n_chars") / 10.0 < fixed.LOW_REACH_FLOOR)
    return b.miss_causes(_scored(t).withColumn("low_reach", low), fixed.TOP_GATE)


GOLD = """g AS (SELECT CASE WHEN quality = 1 AND toxic = 0 THEN 'known_good' WHEN toxic = 1 THEN 'known_bad' ELSE 'neutral' END AS l, least(100, n_chars / 100.0) AS s FROM labels JOIN documents USING (doc_id))"""


@query(f"""WITH {GOLD}, r AS (SELECT count(*) AS n, count(*) FILTER (l = 'known_good') AS ng, count(*) FILTER (l = 'known_bad') AS nb, count(*) FILTER (l = 'neutral') AS nn,
      count(*) FILTER (l = 'known_bad' AND s >= 58) = 0 AS b1, count(*) FILTER (l = 'known_good' AND s < 50) = 0 AS b2, count(*) FILTER (l = 'neutral' AND s >= 58) = 0 AS b3,
      NOT coalesce(max(CASE WHEN l = 'known_bad' THEN s END) > coalesce(min(CASE WHEN l = 'known_good' THEN s END), 0), false) AS b4 FROM g)
    SELECT b1 AS no_bad_top, b2 AS good_clears, b3 AS no_neutral_top, b4 AS no_inversion, n >= 10 AND ng > 0 AND nb > 0 AND nn > 0 AS floor, b1 AND b2 AND b3 AND b4 AND floor AS passed FROM r""")
def gold_bars(t):
    rows = t("labels").join(t("documents"), "doc_id")
    label = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "known_good").when(F.col("toxic") == 1, "known_bad").otherwise("neutral")
    rows = rows.select(label.alias("l"), F.least(F.lit(100.0), F.col("n_chars") / 100.0).alias("s"))
    return b.gold_bars(rows, "l", "s", fixed.TOP_GATE, fixed.ALSO_GATE)


@query("""WITH ev AS (SELECT quality = 1 AS y, n_chars AS s FROM labels JOIN documents USING (doc_id))
    SELECT CAST(tg AS DOUBLE) AS top, CAST(ag AS DOUBLE) AS also, count(*) FILTER (s >= tg) AS n_top, count(*) FILTER (s >= ag AND s < tg) AS n_also, count(*) FILTER (s >= tg AND y) AS good_top
    FROM ev, (VALUES (1000), (2000), (3000), (4000), (5000), (6000), (7000)) a(tg), (VALUES (200), (400), (600), (800), (1000)) c(ag) GROUP BY ALL""")
def gate_pairs(t):
    rows = t("labels").join(t("documents"), "doc_id").select((F.col("quality") == 1).alias("y"), F.col("n_chars").alias("s"))
    return ev.gate_pairs(rows, "s", F.col("y"), [1000, 2000, 3000, 4000, 5000, 6000, 7000], [200, 400, 600, 800, 1000])
