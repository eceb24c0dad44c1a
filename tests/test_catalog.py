"""Every catalog query against its SQL on the small tables, and operators on fixtures of known outcome."""

import os
import random
import re
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.functions import fixed, scalars
from tessera.operators import aggregates, dedup, evaluate, graph, planning, profile, ranges, scoring, search, windows
from tessera.plans import catalog
from tessera.sources import readers, sinks
from tessera.streaming import operators as stream, paged

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages".split() + ["benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v if v is None or isinstance(v, (int, str, bool)) else str(v)


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got = catalog.queries()[name](spark, DATA)
    want = db.sql(catalog.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert table(got.collect(), got.columns) == table(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_runs(spark, name):
    assert catalog.queries()[name](spark, DATA).count() >= 0


def one(spark, column, **values):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]).select(column.alias("x")).first()["x"]


def test_wilson_facts(spark):
    w = scalars.wilson(F.col("s"), F.col("n"))
    assert round(one(spark, w, s=3, n=3), 4) == 0.4385 and round(one(spark, w, s=200, n=200), 4) == 0.9812
    with pytest.raises(Exception, match="more successes"):
        one(spark, w, s=4, n=3)


def test_url_variants_fold(spark):
    urls = ["https://www.a.com/p/?utm_source=x&b=2&a=1#f", "http://a.com/p?a=1&b=2", "a.com/p/?b=2&a=1&fbclid=9", "HTTPS://A.com/p?a=1&b=2&ref=z", "https://a.com/p?b=2&a=1"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select(scalars.canonical_url(F.col("u")).alias("c"))
    assert {r.c for r in df.collect()} == {"https://a.com/p?a=1&b=2"}
    assert one(spark, scalars.canonical_url(F.col("u")), u="https://mobile.twitter.com/x/status/1?s=20") == "https://x.com/x/status/1"


def test_minhash_is_fnv(spark):
    def fnv(text):
        h = 2166136261
        for c in text:
            h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
        return h

    df = dedup.signatures(spark.createDataFrame([("Big Launch's day",), ("!!",)], "t string"), "t", 4)
    got = [r.signature for r in df.collect()]
    assert got[0] == [min(fnv(f"{s}:{w}") for w in ("big", "launchs", "day")) for s in range(4)] and got[1] is None


def test_rank_metrics_facts(spark):
    rows = [("a", 1, .9), ("b", 0, .8), ("c", 1, .7), ("d", 1, .3), ("e", 0, .6), ("f", 1, .2), ("g", 1, .1), ("h", 0, .1)]
    df = spark.createDataFrame(rows, "id string, y int, s double")
    y, order = F.col("y") == 1, [F.desc("s"), F.asc("id")]
    assert evaluate.precision_at(df, y, order, 2).first()[0] == 0.5 and evaluate.precision_at(df, y, order, 20).first()[0] == 5 / 8
    pairs = [(a[2] > b[2]) + (a[2] == b[2]) / 2 for a in rows if a[1] for b in rows if not b[1]]
    assert evaluate.auc(df, y, F.col("s")).first()[0] == pytest.approx(sum(pairs) / len(pairs))
    assert evaluate.ndcg_at(df.limit(4), y, order, 3).first()[0] is None


def test_distribution_and_slots(spark):
    df = spark.createDataFrame([(1, 100, "a"), (2, 100, "a"), (3, 95, "b"), (4, 60, None), (5, 55, "c")], "id int, s int, who string")
    order = [F.desc("s"), F.asc("id")]
    assert [r.f for r in windows.forced_distribution(df, "s", order, "f").orderBy("id").collect()] == [100, 99, 89, 60, 55]
    got = windows.gated_slots(df, "s", order, 58, 50, 2, 2, "who", 1).orderBy("id").collect()
    assert [(r.slot, r.dropped) for r in got] == [("top", None), (None, "author_cap"), ("top", None), ("also", None), ("also", None)]


def test_labels_and_score(spark):
    rows = [("announcement!!", "USE-NOW", "solid", "on"), (None, None, None, None), ("launch", "reference", "vague", "off")]
    df = scoring.labelled(spark.createDataFrame(rows, "content_type string, actionability string, substance string, on_topic string"))
    got = [(r.content_type, r.actionability, r.substance, r.on_topic, r.coerced) for r in df.collect()]
    assert got == [("launch", "actionable_now", "concrete", "core", True), ("opinion", "context_only", "mixed", "adjacent", True), ("launch", "reference", "vague", "off", False)]
    assert [r.b for r in df.select(scoring.base(F.col("content_type"), F.col("actionability")).alias("b")).collect()] == [70, 25, 60]


def test_components_and_events(spark):
    nodes = spark.range(12)
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (3, 4), (6, 5), (5, 7)], "a long, b long")
    got = {r.id: r.group for r in graph.connected(nodes, edges).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 5, 6: 5, 7: 5, **{i: i for i in range(8, 12)}}
    texts = ["Quux Frob ships today", "We love quux frob", "openai releases zeta model", "zeta model by anthropic", "nothing here"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    assert {r.id: r.group for r in dedup.event_groups(df, "id", "t").collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


@pytest.mark.parametrize("rare", [1, 2, 64])
def test_events_by_two_weak_bigrams_equal_all_pairs(spark, rare):
    rng = random.Random(rare)
    words = ["alpha", "bravo", "cedar", "delta", "ember", "fjord", "grove", "haven"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([2, 3, 4]))) for _ in range(60)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    grams = {r.id: {(g.a, g.b, g.strong) for g in r.g or []} for r in df.select("id", scalars.distinctive_bigrams(F.col("t")).alias("g")).collect()}
    group = {i: i for i in grams}

    def top(i):
        return i if group[i] == i else top(group[i])

    for i in grams:
        for j in grams:
            shared = grams[i] & grams[j]
            if i < j and (any(g[2] for g in shared) or len(shared) >= 2):
                x, y = sorted((top(i), top(j)))
                group[y] = x
    assert {r.id: r.group for r in dedup.event_groups(df, "id", "t", rare=rare).collect()} == {i: top(i) for i in grams}


def test_running_sums_over_ranges(spark):
    rows = [(i, (i * 37) % 50, i % 3 if i % 7 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, k long, v long").repartition(7)
    got = {r.id: (r.before, r.at) for r in ranges.numbered(ranges.running(df, [F.desc("k"), F.asc("id")], {"before": F.col("v")}), [F.desc("k"), F.asc("id")], "at").collect()}
    want, total = {}, 0
    for at, (i, _, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))):
        want[i] = (total, at)
        total += v or 0
    assert got == want
    assert ranges.numbered(df.limit(0), [F.asc("id")], "at").count() == 0
    values = spark.createDataFrame([(x,) for x in [3.0, None, 1.0, 2.0, 2.0, 10.0]], "x double")
    assert tuple(aggregates.quartiles(values, "x").first()) == (1.0, 2.0, 2.0, 3.0, 3.6, 10.0)
    assert tuple(aggregates.quartiles(values.limit(0), "x").first()) == (None,) * 6


def test_knn_skips_odd_vectors(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0]), (4, [float("nan"), 1.0]), (5, [1.0, 1.0])], "id int, v array<double>")
    assert [(r.id, round(r.score, 4)) for r in search.knn(df, "id", "v", [1.0, 0.0]).collect()] == [(1, 1.0), (5, 0.7071), (2, 0.0)]
    assert search.knn(df, "id", "v", [1.0, 0.0], 1, "l2").first()["score"] == 1.0


def test_readers(spark):
    export = ['{"bookmarks": [{"tweetId": "1", "text": "a", "authorHandle": "x", "media": "u1, u2", "hashtags": ""}]}', '[{"id": "2", "full_text": "b"}]', '{"items": [{"id": "3", "text": "c"}]}']
    df = readers.bookmarks(spark.createDataFrame([(e,) for e in export], "j string"), "j")
    assert [(r.id, r.text, r.media) for r in df.collect()] == [("1", "a", ["u1", "u2"]), ("2", "b", []), ("3", "c", [])]
    page = '{"data": [{"id": "9", "text": "t", "author_id": "7", "attachments": {"media_keys": ["m1"]}}], "includes": {"users": [{"id": "7", "username": "u", "name": "N"}], "media": [{"media_key": "m1", "type": "photo", "url": "p"}]}}'
    got = readers.api_page(spark.createDataFrame([(page,)], "j string"), "j").first()
    assert (got.handle, got.name, [tuple(m) for m in got.media]) == ("u", "N", [("photo", "p")])
    feed = '<feed><entry><title><![CDATA[A & <b>B</b>]]></title><link href="o"/><link rel="alternate" href="l"/><author><name>me</name></author><content>&lt;p&gt;hi&lt;/p&gt;</content></entry><entry><title>cut'
    rows = readers.feed_entries(spark.createDataFrame([(feed,)], "x string"), "x").collect()
    assert [(r.title, r.link, r.author, r.summary, r.ok) for r in rows][0] == ("A & B", "l", "me", "hi", True) and [r.ok for r in rows] == [True, False]
    html = '<article><h2><a href="/o/r">x</a></h2><a href="/o/r/stargazers"> 1.2k</a><span>1,234 stars today</span></article>'
    assert [tuple(r) for r in readers.trending(spark.createDataFrame([(html,)], "h string"), "h").collect()] == [("o/r", 1200, 1234)]
    answer = 'Sure:\n```json\n{"posts": [{"url": "https://x.com/Joe/status/12", "text": "t", "like_count": "3k", "date": "Tue, 02 Jan 2024 03:04:05 GMT"}]}\n```'
    row = readers.answer_rows(spark.createDataFrame([(answer,)], "a string"), "a").select(readers.candidate(F.col("row")).alias("c")).first().c
    assert (row.id, row.handle, row.likes, str(row.created_at)) == ("12", "joe", 3000, "2024-01-02 03:04:05")


def test_scalars(spark):
    assert one(spark, scalars.decoded_entities(F.col("t")), t="&amp;lt; &quot;x&quot;") == '&lt; "x"'
    assert one(spark, readers.body_text(F.col("t"), F.col("n")), t="@a @b cut", n="long &amp; more") == "@a @b long & more"
    variants = F.array(*[F.struct(F.lit(k).alias("content_type"), F.lit(b).alias("bitrate"), F.lit(u).alias("url")) for k, b, u in (("video/mp4", 1, "a"), ("video/mp4", 5, "b"), ("video/mp4", 5, "c"), ("m3u8", 9, "d"))])
    assert one(spark, scalars.best_variant(variants)) == "b"
    assert one(spark, scalars.distinct_ignoring_case(F.array(F.lit("A"), F.lit("b"), F.lit("a")))) == ["A", "b"]
    assert one(spark, scalars.minhash_text(F.array(F.lit(35), F.lit(4294967295)))) == "000000z.1z141z3"
    assert [one(spark, scalars.is_bare_fragment(F.lit(t))) for t in ("True", "@a @b nice one", "a whole sentence with words")] == [True, True, False]


def test_deterministic_clusters(spark):
    rows = [(i, [float(i % 2) * 10 + i / 100, 0.0]) for i in range(20)]
    got = {r.id: r.cluster for r in profile.kmeans(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v", 2).collect()}
    assert len({got[i] for i in range(0, 20, 2)}) == 1 and got[0] != got[1]


def test_reranker_caps_authors(spark):
    rows = [(0, i, 1 - i / 10, "same" if i < 4 else f"o{i}", [1.0, float(i)]) for i in range(6)]
    df = spark.createDataFrame(rows, "pool int, id int, rel double, who string, v array<double>")
    got = planning.diversified(df, "pool", "id", "rel", "who", "v", 10).collect()
    assert len(got) == 4 and sum(r.id < 4 for r in got) == 2 and got[0].id == 0 and got[0].score == pytest.approx(0.7)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "x"', ["a", "b"])], "id int, t string, l array<string>")
    assert sinks.csv_lines(df, ["id", "t", "l"]).first().line == '"1","say ""x""","a; b"'
    sinks.write_csv(df, f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", header=True, escape='"').first().t == 'say "x"'
    notes = spark.createDataFrame([("a.md", "x"), ("../b.md", "y"), ("c.md", "z")], "path string, text string")
    old = notes.filter("path = 'a.md'").withColumn("sha", F.sha2("text", 256))
    assert [r.path for r in sinks.changed_notes(notes, old, "path", "text").collect()] == ["c.md"]


def test_streams(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    live = lambda: stream.read_files(spark, DATA, events, "events.parquet")
    batch = events.groupBy(F.window("ts", "6 hours"), "event_type").agg(F.count("*").alias("n"))
    got = stream.run_all(stream.tumbling(live(), "ts", "6 hours", "1 day", ["event_type"], F.count("*").alias("n")), "tumble", "complete")
    assert got.count() == batch.count() and got.agg(F.sum("n")).first()[0] == events.count()
    assert stream.run_all(stream.first_seen(live(), "ts", "60 days", ["user_id"]), "seen").count() == events.select("user_id").distinct().count()
    got = stream.run_all(stream.streaks(live(), "user_id", "ts", "event_type = 'error'", "event_type = 'purchase'", 3), "streaks", "update")
    last = windows.streak(events, F.col("event_type") == "error", F.col("event_type") == "purchase", ["ts"], ["user_id"])
    want = {r.user_id: r.streak for r in last.groupBy("user_id").agg(F.max_by("streak", "ts").alias("streak")).collect()}
    assert {r.user_id: r.streak for r in got.collect()} == want
    sink = stream.upsert_sink(f"{tmp_path}/t", "id", "p", ["v"])
    for n, rows in enumerate([[(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], [(1, 1, "z"), (2, 2, "d"), (3, 1, "e")]]):
        sink(spark.createDataFrame(rows, "id int, p int, v string"), n)
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/t/v1").collect()} == {(1, 2, "b"), (2, 2, "d"), (3, 1, "e")}


def test_paged_sweep_and_source(spark):
    pages = {None: ([("9", "x", "2024-01-09"), ("8", "x", "2024-01-08")], "p2"), "p2": ([("7", "x", "2024-01-07"), ("6", "x", "2024-01-06")], "p3"), "p3": ([("5", "x", "2024-01-05")], None)}
    rows, why = paged.sweep(pages.get, lambda r: r[0] <= "8", 2, 5)
    assert (len(rows), why) == (4, "known")
    assert paged.sweep(pages.get, lambda r: False, 3, 5)[1] == "exhausted" and paged.sweep(pages.get, lambda r: False, 3, 1)[1] == "cap"
    assert paged.sweep(pages.get, lambda r: False, 3, 5, "2024-01-07")[1] == "window"
    days = spark.createDataFrame([(None, "2024-01-08"), ("2024-01-01", "2024-01-08"), ("2024-01-02", "2024-01-08")], "l string, t string")
    assert [r[0] for r in days.select(paged.full_walk_due(F.col("l").cast("date"), F.col("t").cast("date"))).collect()] == [True, True, False]


def test_theme_examples_are_exclusive(spark):
    df = spark.createDataFrame([(1, 9.0, ["a", "b"]), (2, 5.0, ["b"]), (3, 1.0, ["a"])], "id int, s double, th array<string>")
    got = {r.theme: (r.n, r.salience, r.examples) for r in aggregates.theme_histogram(df, "th", "s", "id").collect()}
    assert got == {"a": (2, 10.0, [1, 3]), "b": (2, 14.0, [2])}


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_signature(text, size):
    """The least FNV-1a hashes of a text's ASCII tokens, or None."""
    words, out = set(re.findall("[a-z0-9]+", text.lower())), []
    for seed in range(size):
        out.append([])
        for w in words:
            h = 2166136261
            for c in f"{seed}:{w}":
                h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
            out[-1].append(h)
    return [min(hs) for hs in out] if words else None


def drawn(rng, n):
    return ["".join(rng.choices("bcdfgklmz", k=rng.randint(3, 6))) for _ in range(n)]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """A folder of small tables whose ids pass every id filter there was, and texts alike only far from their start."""
    rng, rows = random.Random(5), []
    for family in range(8):
        base = drawn(rng, 80)
        for k in range(6):
            words = drawn(rng, 14) + [w if rng.random() > 0.02 * k else "".join(drawn(rng, 1)) for w in base]
            rows.append((300 + 100 * family + k, " ".join(words), "en" if k % 2 else "de", f"s{k}", 0))
    rows += [(5, "!!", "en", "s0", 2), (6, None, "en", "s0", 0), (2000, "Big Launch", "en", "s0", 10)]
    path = str(tmp_path_factory.mktemp("whole"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path, {r[0]: r[1] or "" for r in rows}, rows


def test_signatures_of_whole_table(spark, whole):
    got = {r.doc_id: r.signature for r in catalog.queries()["minhash_signatures"](spark, whole[0]).collect()}
    want = {i: plain_signature(t, 8) for i, t in whole[1].items()}
    assert got == {i: ".".join(map(str, s)) for i, s in want.items() if s}


def test_pairs_of_whole_texts(spark, whole):
    got = {(r.a, r.b): r.similarity for r in catalog.queries()["minhash_pairs"](spark, whole[0]).collect()}
    signatures = {i: s for i, t in whole[1].items() if (s := plain_signature(t, 128))}
    want = {(a, b): sum(x == y for x, y in zip(signatures[a], signatures[b])) / 128 for a, b in combinations(sorted(signatures), 2)}
    want = {k: v for k, v in want.items() if v >= 0.7}
    assert got == want and 8 < len(want) < 8 * 15 and min(want.values()) < 0.75


def test_pairs_that_spoil_every_band(spark):
    a = list(range(128))
    b = [x + 1000 if x % 4 == 0 or x in (1, 9, 17, 25, 33, 41) else x for x in a]
    c = [x + 2000 if x % 4 == 0 or x in (1, 9, 17, 25, 33, 41, 49) else x for x in a]
    df = spark.createDataFrame([(1, a), (2, b), (3, c)], "id long, signature array<long>")
    assert {(r.a, r.b, r.similarity) for r in dedup.similar_pairs(df, "id").collect()} == {(1, 2, 90 / 128)}


def plain_bigrams(text):
    """{(a, b): strong} of a text without URLs and mentions."""
    words = [w for w in re.findall("[a-z0-9]+", text.lower()) if w not in fixed.EVENT_STOP_WORDS and not w.isdigit()]
    out = {}
    for a, b in zip(words, words[1:]):
        ga, gb = a in fixed.GENERIC_WORDS, b in fixed.GENERIC_WORDS
        if not (ga and gb) and (not ga or len(b) >= 3) and (not gb or len(a) >= 3):
            out[a, b] = not ga and not gb
    return out


def test_events_of_whole_texts(spark, tmp_path):
    rng, generic = random.Random(9), sorted(fixed.GENERIC_WORDS)
    texts = [drawn(rng, 90) for _ in range(30)]
    texts[1][80:82] = texts[0][70:72]
    texts[3][60:62], texts[3][70:72], texts[4][65:67], texts[4][75:77], texts[5][60:62] = ([w, x] for w, x in [(generic[0], "zebraxx"), (generic[1], "yakxx")] * 2 + [(generic[0], "zebraxx")])
    rows = [(700 + i, " ".join(w), "en", "s0", 0) for i, w in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    grams = {r[0]: plain_bigrams(r[1]) for r in rows}
    got = catalog.queries()["event_bigrams"](spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.n, r.strong) for r in got} == {i: (len(g), sum(g.values())) for i, g in grams.items()}
    group = {i: i for i in grams}
    for a, b in combinations(sorted(grams), 2):
        shared = [g for g in grams[a] if g in grams[b]]
        if any(grams[a][g] for g in shared) or len(shared) >= 2:
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = {i: new if x == old else x for i, x in group.items()}
    assert group[701] == 700 and group[704] == 703 and group[705] == 705
    got = catalog.queries()["event_groups"](spark, str(tmp_path))
    assert {tuple(r) for r in got.select(*got.columns).collect()} == set(group.items())


def plain_diversified(rows, k, balance=0.7, cap=2):
    """[(pool, id, rank, score)] for rows (pool, id, rel, who, unit vector), by trying every row."""
    out = []
    for pool in {r[0] for r in rows}:
        left, picks = sorted((r for r in rows if r[0] == pool), key=lambda r: r[1]), []
        while len(picks) < k:
            fit = [r for r in left if r not in picks and sum(p[3] == r[3] for p in picks) < cap]
            score = lambda r: balance * r[2] - (1 - balance) * max([0.0, *(sum(x * y for x, y in zip(r[4], p[4])) for p in picks)])
            if not fit:
                break
            best = min(fit, key=lambda r: (-score(r), -r[2], r[1]))
            out.append((pool, best[1], len(picks) + 1, round(score(best), 6)))
            picks.append(best)
    return out


def test_diversified_reads_the_whole_table(spark, tmp_path):
    rng, rows = random.Random(3), []
    for i in range(250, 900):
        v = [rng.gauss(0, 1) for _ in range(6)]
        rows.append((i, i % 3 if i < 890 else 7, v if i % 50 else [0.0] * 6))
    spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    unit = lambda v: [x / (sum(y * y for y in v) ** 0.5 or 1.0) for x in v]
    want = plain_diversified([(p, i, i % 97 / 97, i % 7, unit(v)) for i, p, v in rows], 5)
    got = catalog.queries()["diversified_pool"](spark, str(tmp_path))
    assert got.columns == ["pool", "vec_id", "rank", "score"] and max(w[1] for w in want) > 300
    assert {(r.pool, r.vec_id, r["rank"], round(r.score, 6)) for r in got.collect()} == set(want)


def test_whole_tables_without_id_filters(spark, whole, tmp_path):
    path, _, rows = whole
    got = [r.doc_id for r in catalog.queries()["inserted_if_absent"](spark, path).collect()]
    assert sorted(got) == sorted(r[0] for r in rows) and max(got) >= 700
    pages = {r.key: (r.n, r.page) for r in catalog.queries()["index_pages"](spark, path).collect()}
    lines = {lang: sorted(f"- {r[3]}/{r[0]}" for r in rows if r[2] == lang) for lang in ("en", "de")}
    assert pages == {lang: (len(x), "\n".join(x)) for lang, x in lines.items()}
    spark.createDataFrame([(1, 3.0), (41, 0.0), (42, 1.0), (45, 9.0), (41, 0.0)], "user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert {r.user_id for r in catalog.queries()["silent_sources"](spark, str(tmp_path)).collect()} == {41, 45}
