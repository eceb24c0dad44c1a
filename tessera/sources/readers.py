"""Records from JSON exports, API pages, feeds, HTML lists and model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import scalars

PAGE = """struct<data: array<struct<id: string, text: string, author_id: string, created_at: string, attachments: struct<media_keys: array<string>>>>,
includes: struct<users: array<struct<id: string, username: string, name: string>>, media: array<struct<media_key: string, type: string, url: string, preview_image_url: string>>>,
meta: struct<result_count: int, next_token: string>>""".replace("\n", " ")

ROW = "struct<id: string, url: string, text: string, full_text: string, handle: string, author: string, username: string, likes: string, like_count: string, created_at: string, date: string>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bookmarks(df: DataFrame, json: str) -> DataFrame:
    """One record per bookmark of an export in any known layout: {bookmarks: []}, a bare array, or an array under another key."""
    item = "struct<id: string, tweetId: string, text: string, full_text: string, authorHandle: string, screen_name: string, createdAt: string, media: string, hashtags: string>"
    c = F.col(json)
    wrapped = F.from_json(c, f"struct<bookmarks: array<{item}>, data: array<{item}>, tweets: array<{item}>, items: array<{item}>>")
    rows = F.when(F.ltrim(c).startswith("["), F.from_json(c, f"array<{item}>")).otherwise(
        F.coalesce(wrapped["bookmarks"], wrapped["data"], wrapped["tweets"], wrapped["items"])
    )
    out = df.select(F.explode(rows).alias("b"))
    return out.select(
        F.coalesce("b.tweetId", "b.id").alias("id"), F.coalesce("b.full_text", "b.text").alias("text"),
        F.coalesce("b.authorHandle", "b.screen_name").alias("handle"), F.col("b.createdAt").alias("created_at"),
        split_list(F.col("b.media")).alias("media"), split_list(F.col("b.hashtags")).alias("hashtags"),
    )


def split_list(text: Column) -> Column:
    """A comma-separated list without empty parts."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def zipped_media(urls: Column, kinds: Column) -> Column:
    """URLs with the kind at the same place, photo where there is none."""
    return F.transform(urls, lambda u, i: F.struct(u.alias("url"), F.coalesce(F.get(kinds, i), F.lit("photo")).alias("type")))


def api_page(df: DataFrame, json: str) -> DataFrame:
    """(id, text, handle, name, created_at, media) of an API page's rows, users and media joined inside the page."""
    p = df.select(F.from_json(F.col(json), PAGE).alias("p"))
    rows = p.select(F.posexplode("p.data").alias("pos", "t"), "p.includes")
    user = F.filter(F.coalesce("includes.users", F.array()), lambda u: u["id"] == F.col("t.author_id"))
    user = F.get(user, F.lit(0))
    keys = F.coalesce("t.attachments.media_keys", F.array())
    media = F.filter(F.coalesce("includes.media", F.array()), lambda m: F.array_contains(keys, m["media_key"]))
    return rows.select(
        F.col("t.id").alias("id"), F.col("t.text").alias("text"), user["username"].alias("handle"), user["name"].alias("name"),
        F.col("t.created_at").alias("created_at"),
        F.transform(media, lambda m: F.struct(m["type"].alias("type"), F.coalesce(m["url"], m["preview_image_url"]).alias("url"))).alias("media"),
    )


def full_text(note: Column, title: Column, content: Column, blocks: Column, legacy: Column) -> Column:
    """The longest form of a post that there is: note, article, its first eight blocks, or the plain text."""
    article = F.nullif(F.concat_ws("\n\n", title, content), F.lit(""))
    first = F.nullif(F.array_join(F.slice(blocks, 1, 8), "\n\n"), F.lit(""))
    return F.coalesce(F.nullif(note, F.lit("")), article, first, legacy)


def body_text(text: Column, note: Column) -> Column:
    """The note where there is one, behind the mentions that the text starts with; references decoded once."""
    lead = F.regexp_extract(text, r"^((?:@\w+\s+)+)", 1)
    whole = F.when(F.coalesce(note, F.lit("")) != "", F.when(note.startswith(lead), note).otherwise(F.concat(lead, note))).otherwise(text)
    return scalars.decoded_entities(whole)


def feed_entries(df: DataFrame, xml: str) -> DataFrame:
    """(title, link, author, summary, ok) of the entries of Atom texts; an entry without a title or link isn't ok."""
    parts = F.regexp_extract_all(F.col(xml), F.lit(r"(?s)(<entry\b.*?(?:</entry>|$))"), F.lit(1))
    e = df.select(F.explode(parts).alias("e"))
    one = lambda p: F.regexp_extract("e", p, 1)
    clean = lambda c: F.trim(scalars.stripped_tags(scalars.decoded_entities(F.regexp_replace(c, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))))
    link = F.coalesce(F.nullif(one(r'<link[^>]*rel="alternate"[^>]*href="([^"]*)"'), F.lit("")), F.nullif(one(r'<link[^>]*href="([^"]*)"'), F.lit("")))
    title = clean(one(r"(?s)<title[^>]*>(.*?)</title>"))
    return e.select(
        title.alias("title"), link.alias("link"), clean(one(r"(?s)<author>.*?<name>(.*?)</name>")).alias("author"),
        F.substring(clean(one(r"(?s)<(?:content|summary)[^>]*>(.*?)</(?:content|summary)>")), 1, 600).alias("summary"),
        ((title != "") & link.isNotNull() & F.col("e").endswith("</entry>")).alias("ok"),
    )


def trending(df: DataFrame, html: str) -> DataFrame:
    """(repo, stars, today) of the article blocks of a trending list."""
    e = df.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(r"(?s)(<article\b.*?</article>)"), F.lit(1))).alias("e"))
    repo = F.regexp_extract("e", r'href="/([\w.-]+/[\w.-]+)"', 1)
    return e.select(
        repo.alias("repo"), scalars.count_of(F.regexp_extract("e", r'/stargazers"[^>]*>\s*([\d.,kmb]+)', 1)).alias("stars"),
        scalars.count_of(F.regexp_extract("e", r"([\d.,kmb]+)\s+stars today", 1)).alias("today"),
    ).filter("repo != ''")


def answer_rows(df: DataFrame, answer: str) -> DataFrame:
    """Rows that a model's answer holds: fenced JSON, the text itself, its outermost list or object; the first that parses."""
    a = F.col(answer)
    forms = [F.regexp_extract(a, r"(?s)```(?:json)?\s*(.*?)```", 1), F.trim(a), F.regexp_extract(a, r"(?s)(\[.*\])", 1), F.regexp_extract(a, r"(?s)(\{.*\})", 1)]
    wrapped = f"struct<posts: array<{ROW}>, results: array<{ROW}>, data: array<{ROW}>, tweets: array<{ROW}>, items: array<{ROW}>>"

    def parse(c: Column) -> Column:
        inner = F.from_json(c, wrapped)
        inner = F.coalesce(inner["posts"], inner["results"], inner["data"], inner["tweets"], inner["items"])
        got = F.when(c.startswith("["), F.from_json(c, f"array<{ROW}>")).otherwise(inner)
        return F.when(F.size(F.filter(got, lambda r: F.coalesce(r["id"], r["url"], r["text"]).isNotNull())) > 0, got)

    return df.select("*", F.explode(F.coalesce(*[parse(c) for c in forms])).alias("row"))


def candidate(row: Column) -> Column:
    """A loosely typed row as a candidate: aliases in order, id and handle from the URL where they are missing."""
    from_url = lambda p: F.nullif(F.regexp_extract(F.coalesce(row["url"], F.lit("")), p, 1), F.lit(""))
    handle = F.coalesce(row["handle"], row["author"], row["username"], from_url(r"(?:x|twitter)\.com/(\w+)/status"))
    return F.struct(
        F.coalesce(F.nullif(F.regexp_extract(F.coalesce(row["id"], F.lit("")), r"^(\d+)$", 1), F.lit("")), from_url(r"status/(\d+)")).alias("id"),
        F.lower(F.regexp_replace(handle, "^@", "")).alias("handle"), F.coalesce(row["text"], row["full_text"]).alias("text"),
        scalars.count_of(F.coalesce(row["likes"], row["like_count"])).alias("likes"),
        scalars.any_time(F.coalesce(row["created_at"], row["date"])).alias("created_at"),
    )


def list_file(spark: SparkSession, path: str) -> DataFrame:
    """(name, alias) of a list's lines: comments and blanks left out, lower case, an entry with a space is an alias."""
    lines = spark.read.text(path).select(F.lower(F.trim(F.regexp_replace("value", "#.*$", ""))).alias("name")).filter("name != ''")
    return lines.select(F.regexp_replace("name", "^@", "").alias("name"), F.col("name").contains(" ").alias("alias")).distinct()


def first_text(sources: list[DataFrame], id_col: str = "id", text: str = "text") -> DataFrame:
    """id → text over several sources, the first source that has the id."""
    rows = None
    for i, s in enumerate(sources):
        part = s.select(id_col, text, F.lit(i).alias("_p"))
        rows = part if rows is None else rows.unionByName(part)
    w = Window.partitionBy(id_col).orderBy("_p", text)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(id_col, text)


TWEET = "struct<__typename: string, rest_id: string, legacy: struct<full_text: string, user_id_str: string>>"
ENTRY = f"""struct<content: struct<entryType: string, cursorType: string, value: string,
itemContent: struct<tweet_results: struct<result: struct<__typename: string, rest_id: string, legacy: struct<full_text: string, user_id_str: string>, tweet: {TWEET}>>>>>""".replace("\n", " ")
TIMELINE = f"struct<data: struct<bookmark_timeline_v2: struct<timeline: struct<instructions: array<struct<type: string, entries: array<{ENTRY}>>>>>>>"


def timeline_page(df: DataFrame, json: str, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Posts (keep, id, text, author_id) of timeline pages, unwrapped where their visibility is limited, and each page's bottom cursor (keep, cursor)."""
    steps = F.from_json(F.col(json), TIMELINE)["data"]["bookmark_timeline_v2"]["timeline"]["instructions"]
    steps = F.filter(F.coalesce(steps, F.array().cast(f"array<struct<type: string, entries: array<{ENTRY}>>>")), lambda i: i["type"] == "TimelineAddEntries")
    entries = df.select(*keep, F.explode(F.flatten(F.transform(steps, lambda i: F.coalesce(i["entries"], F.array().cast(f"array<{ENTRY}>"))))).alias("e"))
    c, result = F.col("e.content"), F.col("e.content.itemContent.tweet_results.result")
    limited = (result["__typename"] == "TweetWithVisibilityResults") & result["tweet"].isNotNull()
    pick = lambda f: F.when(limited, f(result["tweet"])).otherwise(f(result))
    posts = entries.filter(c["entryType"] == "TimelineTimelineItem").select(
        *keep, pick(lambda r: r["rest_id"]).alias("id"), pick(lambda r: r["legacy"]["full_text"]).alias("text"), pick(lambda r: r["legacy"]["user_id_str"]).alias("author_id")
    )
    bottom = entries.filter((c["entryType"] == "TimelineTimelineCursor") & (c["cursorType"] == "Bottom")).select(*keep, c["value"].alias("cursor"))
    return posts.filter("id is not null"), bottom


def timeline_candidates(posts: DataFrame, users: DataFrame) -> DataFrame:
    """Posts (id, text, note, author_id, created_at) with their authors (id, username, name), as candidates."""
    u = users.select(F.col("id").alias("author_id"), F.col("username").alias("handle"), "name")
    rows = posts.join(u, "author_id", "left")
    url = F.when(F.col("handle").isNotNull(), F.concat(F.lit("https://x.com/"), "handle", F.lit("/status/"), F.col("id")))
    return rows.select("id", F.lit("x").alias("source"), F.coalesce(F.nullif("note", F.lit("")), "text", F.lit("")).alias("text"), "handle", "name", url.alias("url"), "created_at")


def stored_entities(df: DataFrame, json: str) -> DataFrame:
    """Adds the entities that a stored post's JSON holds, in either of its shapes: hashtags, urls, mentions, kind, media."""
    listed = lambda path, kind: F.coalesce(*[F.from_json(F.get_json_object(json, p), f"array<{kind}>") for p in (f"$.{path}", f"$.legacy.{path}")], F.array().cast(f"array<{kind}>"))
    given = lambda *paths: F.coalesce(*[F.get_json_object(json, f"$.{p}") for p in paths])
    named = lambda rows, f: F.filter(F.transform(rows, f), lambda x: x.isNotNull() & (x != ""))
    urls = named(listed("entities.urls", "struct<expanded_url: string, url: string>"), lambda u: F.coalesce(u["expanded_url"], u["url"]))
    media = F.array_distinct(named(listed("entities.media", "struct<type: string>"), lambda m: m["type"]))
    more = F.array_distinct(named(listed("extended_entities.media", "struct<type: string>"), lambda m: m["type"]))
    thread, reply, quote = given("self_thread", "legacy.self_thread"), given("in_reply_to_tweet_id", "legacy.in_reply_to_status_id_str"), given("quoted_tweet_id_str", "legacy.quoted_status_id_str", "quoted_status_id_str")
    return df.withColumns({
        "hashtags": named(listed("entities.hashtags", "struct<tag: string, text: string>"), lambda h: F.lower(F.coalesce(h["tag"], h["text"]))),
        "urls": F.filter(urls, lambda u: ~u.contains("twitter.com") & ~u.contains("t.co/") & ~u.contains("x.com/")),
        "mentions": named(listed("entities.user_mentions", "struct<screen_name: string, username: string>"), lambda m: F.lower(F.coalesce(m["screen_name"], m["username"]))),
        "kind": F.when(thread.isNotNull(), "thread").when(reply.isNotNull(), "reply").when(quote.isNotNull(), "quote").otherwise("original"),
        "media": F.when(F.size(media) > 0, media).otherwise(more),
    })
