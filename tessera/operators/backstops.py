"""Checks beside the model's labels: fragments, topic, thin threads, junk; first guesses of labels; the full selection."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, lists, scalars
from . import dedup, scoring, windows


def _any(text: Column, parts: list[str]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(p)) for p in parts])


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def item_text(df: DataFrame) -> Column:
    """The first of post, title and summary that isn't empty."""
    return F.coalesce(*[F.when(_blank(F.col(c)) != "", F.col(c)) for c in ("tweet_text", "title", "summary") if c in df.columns], F.lit(""))


def is_x(source: Column, post: Column, handle: Column, title: Column, points: Column) -> Column:
    """A post by its source; without one, by the shape of a post that isn't a story."""
    s = F.lower(_blank(source))
    shaped = ((_blank(post) != "") | (_blank(handle) != "")) & (_blank(title) == "") & points.isNull()
    return F.when(s != "", s.isin("x", "twitter")).otherwise(shaped)


def is_repo(source: Column) -> Column:
    return F.lower(_blank(source)).isin("github", "github-trending")


def is_curated(source: Column, url: Column) -> Column:
    forum = F.lower(F.regexp_extract(_blank(url), r"(?i)reddit\.com/r/([A-Za-z0-9_]+)", 1))
    return (F.lower(_blank(source)) == "reddit") & forum.isin(lists.CURATED_FORUMS)


def topic_text(df: DataFrame) -> Column:
    """What a topic is read from: name and description of a repository, else the item's text."""
    return F.when(is_repo(F.col("source")), F.trim(F.concat_ws(" ", F.trim(_blank(F.col("title"))), F.trim(_blank(F.col("summary")))))).otherwise(item_text(df))


def _on_topic(tokens: Column) -> Column:
    stem = "^(?:" + "|".join(lists.TOPIC_STEMS) + ")"
    return F.arrays_overlap(tokens, scalars.words_in(lists.TOPIC_TOKENS)) | F.exists(tokens, lambda w: F.regexp_like(w, F.lit(stem)))


def topic_check(text: Column, repo: Column, curated: Column) -> Column:
    """Why a text is off topic, or that its forum vouches for it; null where its words are on topic.  The order is fixed."""
    tokens = F.transform(scalars.substance_words(text), F.lower)
    phrases = "|".join(p.replace("-", r"\-") for p in lists.OFF_TOPIC_REPOS)
    return (
        F.when(F.arrays_overlap(tokens, scalars.words_in(lists.OFF_TOPIC_WORDS)), "python:offtopic-marker")
        .when(repo & F.regexp_like(text, F.lit(rf"(?i)(?<![A-Za-z0-9])(?:{phrases})(?![A-Za-z0-9])")), "github-offtopic-repo-marker")
        .when(_on_topic(tokens), None).when(curated, "source-curated-vouch").otherwise("python:no-tech-tokens")
    )


def is_fragment(text: Column, described: Column, repo: Column, curated: Column) -> Column:
    """A bare fragment; in a curated forum only an empty text, of a repository by its description."""
    return F.when(curated, F.trim(text) == "").when(repo, scalars.is_bare_fragment(described)).otherwise(scalars.is_bare_fragment(text))


def is_thin_thread(source: Column, title: Column, body: Column) -> Column:
    """A forum thread with hardly a body, or a vague title over a short one, unless it is a developed question."""
    t, b = F.trim(_blank(title)), F.trim(_blank(body))
    n, m = F.length(t), F.length(b)
    thin = (m < lists.THIN_BODY) | ((n < lists.VAGUE_TITLE) & (m < lists.SOFT_BODY))
    question = t.endswith("?") & ((n >= lists.RESCUE_TITLE) | (m >= lists.RESCUE_BODY))
    return (F.lower(_blank(source)) == "reddit") & thin & ~question


def junk(text: Column) -> Column:
    """Which kind of junk a text is: each needs a second sign beside the first; null where it is none."""
    low = F.lower(text)
    words = F.regexp_extract_all(low, F.lit("([a-z0-9]+)"), F.lit(1))
    models = F.arrays_overlap(words, scalars.words_in(lists.MODEL_WORDS)) | _on_topic(words)
    priced = _any(low, lists.COINS) & (F.contains(text, F.lit("$")) | F.contains(low, F.lit("price")) | F.contains(text, F.lit("%")))
    signs = sum([F.contains(low, F.lit(w)).cast("int") for w in lists.CRYPTO_WORDS], F.lit(0)) + priced.cast("int") + _any(text, lists.CANDLES).cast("int")
    like = lambda p: F.regexp_like(text, F.lit(p))
    hype = _any(text, lists.HYPE_SIGNS) | like(lists.HYPE_CAPITALS)
    bait = like(lists.DM_BAIT) & (like(lists.LINK_BAIT) | F.contains(low, F.lit("t.co/")))
    funding = _any(low, lists.CROWDFUNDING) | like(lists.RAISED)
    latin = F.regexp_count(text, F.lit(r"[\p{L}&&[\x{0}-\x{24F}\x{1E00}-\x{1EFF}]]"))
    foreign = F.regexp_count(text, F.lit(r"\p{L}")) - latin > latin
    return (
        F.when((like(lists.CASHTAG) & (signs >= 1)) | (signs >= 2), "crypto-ticker")
        .when(like(lists.BRACKET_BAIT) | (bait & hype), "scam-grant")
        .when(funding & (~models | _any(low, lists.CRYPTO_WORDS)), "kickstarter-promo")
        .when(foreign & ~models & like(lists.CLICKBAIT), "foreign-clickbait")
    )


def checked(df: DataFrame) -> DataFrame:
    """Labelled rows (source, url, title, summary, tweet_text and the four labels) after all four checks.

    Adds what overrode a label (``topic_reason``, ``fragment``, ``thin``,
    ``junk``); labels are only ever lowered.
    """
    curated, repo = is_curated(F.col("source"), F.col("url")), is_repo(F.col("source"))
    body = F.when(F.trim(_blank(F.col("tweet_text"))) != "", F.trim("tweet_text")).otherwise(F.trim(F.concat_ws(" ", _blank(F.col("title")), _blank(F.col("summary")))))
    df = df.withColumns({"_item": item_text(df), "_topic": topic_text(df), "_body": body})
    df = df.withColumns({
        "topic_reason": topic_check(F.col("_topic"), repo, curated), "fragment": is_fragment(F.col("_item"), F.col("_topic"), repo, curated),
        "thin": is_thin_thread(F.col("source"), F.col("title"), F.col("summary")), "junk": F.when(~curated, junk(F.col("_body"))),
    })
    off = (F.col("topic_reason").isNotNull() & (F.col("topic_reason") != "source-curated-vouch")) | F.col("junk").isNotNull()
    lowered = F.col("thin") & ~F.col("actionability").isin("context_only", "none")
    return df.withColumns({
        "on_topic": F.when(off, "off").otherwise(F.col("on_topic")),
        "content_type": F.when(F.col("fragment"), "reply_fragment").otherwise(F.col("content_type")),
        "actionability": F.when(lowered, "context_only").otherwise(F.col("actionability")),
    }).drop("_item", "_topic", "_body")


def scored(df: DataFrame, also_gate: int = fixed.ALSO_GATE) -> DataFrame:
    """The score over checked rows; junk ends below the gate whatever else it earns."""
    rows = scoring.scored(checked(df), also_gate)
    return rows.withColumn("final", F.when(F.col("junk").isNotNull(), F.least("final", F.lit(also_gate - 1))).otherwise(F.col("final")))


def brief(df: DataFrame, id_col: str, order: list[Column], author: str, text: str, **options) -> DataFrame:
    """The whole selection over scored rows: fragments dropped, one winner an event, distribution, cap, gates, slots."""
    rows = df.filter(~scalars.is_bare_fragment(F.col(text)))
    rows = rows.join(dedup.event_groups(rows, id_col, text).withColumnRenamed("group", "event"), id_col)
    won = windows.winners(rows, "event", order, id_col).filter("rank = 1").drop("rank", "lost_to")
    return scoring.selected(won, order, author, **options)


def first_guess(text: Column, tags: Column) -> Column:
    """Labels by phrases and lengths, for rows without a model's: a struct of the four."""
    low = F.lower(_blank(text))
    n = F.size(F.filter(F.split(low, r"\s+"), lambda w: w != ""))
    kind = F.when(n > 12, "field_report").otherwise("opinion")
    for name, phrases in reversed(lists.FIRST_GUESS):
        kind = F.when(_any(low, phrases), name).otherwise(kind)
    action = F.when(kind.isin("launch", "tutorial", "benchmark"), "actionable_now").when(kind.isin("analysis", "field_report"), "reference").otherwise("context_only")
    substance = F.when(n > 14, "concrete").when(n > 6, "mixed").otherwise("vague")
    has = lambda words: F.arrays_overlap(tags, scalars.words_in(words))
    topic = F.when(has(lists.PRODUCTIVE_TAGS), "core").when(has(lists.EXCLUDED_TAGS), "off").otherwise("adjacent")
    return F.struct(kind.alias("content_type"), action.alias("actionability"), substance.alias("substance"), topic.alias("on_topic"))


def tag_class(tags: Column) -> Column:
    """What a row's tags make of it in an evaluation."""
    has = lambda words: F.arrays_overlap(tags, scalars.words_in(words))
    good, bad = has(lists.PRODUCTIVE_TAGS), has(lists.EXCLUDED_TAGS)
    return (
        F.when(has(lists.COIN_TAGS) & has(lists.STRONG_TAGS), "positive").when(good & ~bad, "positive")
        .when(bad & ~good, "hard_neg").when(good & bad, "mixed").otherwise("neither")
    )


def miss_causes(df: DataFrame, gate: float) -> DataFrame:
    """Of scored rows below the gate, how many each cause held there; a row may have several."""
    miss = df.filter(F.col("final") < gate)
    return miss.agg(
        F.count("*").alias("missed"), F.count_if("low_reach").alias("low_reach_capped"), F.count_if(F.col("fit_points") < 0).alias("pf_negative"),
        F.count_if(F.col("base") < gate - 6).alias("low_base"), F.count_if(F.col("topic_penalty") > 0).alias("off_pen"),
    )


def gold_bars(df: DataFrame, label: str, final: str, top_gate: float, also_gate: float, least: int = 10) -> DataFrame:
    """The four bars of a labelled set, and whether it is large enough to say anything."""
    kind, s = F.col(label), F.col(final)
    row = df.agg(
        F.count("*").alias("n"), F.count_if(kind == "known_good").alias("good"), F.count_if(kind == "known_bad").alias("bad"), F.count_if(kind == "neutral").alias("neutral"),
        F.count_if((kind == "known_bad") & (s >= top_gate)).alias("b1"), F.count_if((kind == "known_good") & (s < also_gate)).alias("b2"),
        F.count_if((kind == "neutral") & (s >= top_gate)).alias("b3"), F.max(F.when(kind == "known_bad", s)).alias("worst"), F.min(F.when(kind == "known_good", s)).alias("weakest"),
    )
    floor = (F.col("n") >= least) & (F.col("good") >= 1) & (F.col("bad") >= 1) & (F.col("neutral") >= 1)
    inversion = F.coalesce(F.col("worst") > F.coalesce("weakest", F.lit(0.0)), F.lit(False))
    row = row.select((F.col("b1") == 0).alias("no_bad_top"), (F.col("b2") == 0).alias("good_clears"), (F.col("b3") == 0).alias("no_neutral_top"), (~inversion).alias("no_inversion"), floor.alias("floor"))
    return row.withColumn("passed", F.col("no_bad_top") & F.col("good_clears") & F.col("no_neutral_top") & F.col("no_inversion") & F.col("floor"))
