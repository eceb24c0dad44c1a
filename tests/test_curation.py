"""Operators without SQL beside them, against plain versions."""

import io
import math
import random
import unicodedata
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars, stemming, wording
from tessera.operators import backstops, curation, dedup, profile, search
from tessera.plans import catalog
from tessera.sources import sinks


def test_stems_of_known_words():
    known = {
        "caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "plastered": "plaster", "motoring": "motor", "hopping": "hop",
        "falling": "fall", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "digitizer": "digit",
        "operator": "oper", "feudalism": "feudal", "hopefulness": "hope", "triplicate": "triplic", "formative": "form", "electrical": "electr",
        "revival": "reviv", "adjustable": "adjust", "adoption": "adopt", "probate": "probat", "rate": "rate", "controll": "control", "is": "is",
        "sized": "size", "conflated": "conflat", "generalizations": "gener", "oscillators": "oscil",
    }
    assert {w: stemming.stem(w) for w in known} == known
    assert stemming.plain_tokens("Café_ÉTÉ naïve Straße 3x") == ["cafe", "ete", "naive", "straße", "3x"]


def test_titles_are_cut_at_accents(spark):
    df = spark.createDataFrame([("Café's ﬁne—Éte, cafés",), (None,), ("Plain title's",)], "t string")
    got = [r.x for r in df.select(scalars.title_tokens(F.col("t")).alias("x")).collect()]
    plain = lambda t: list(dict.fromkeys(__import__("re").findall("[a-z0-9]+", unicodedata.normalize("NFKD", t).lower().replace("'", "").replace("’", ""))))
    assert got == [plain("Café's ﬁne—Éte, cafés"), None, ["plain", "titles"]]


def test_index_ranks_like_a_scan_of_stems(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()
    got = {r.doc_id: r["rank"] for r in catalog.queries()["indexed_search"](spark, sf).collect()}
    rows = {d.doc_id: [stemming.stem(w) for w in stemming.plain_tokens(f"{d.text or ''} {d.source or ''}")] for d in docs}
    n, avg = len(rows), sum(map(len, rows.values())) / len(rows)
    want: Counter = Counter()
    for term in {stemming.stem(w) for w in ("nation", "idiot", "clown")}:
        df = sum(term in w for w in rows.values())
        idf = max(math.log((n - df + 0.5) / (df + 0.5)), 1e-6)
        for d, w in rows.items():
            if tf := w.count(term):
                want[d] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / avg))
    assert got == {d: pytest.approx(x, abs=2e-6) for d, x in want.items()}


def test_seen_titles_equal_all_pairs(spark):
    rng = random.Random(4)
    base = [[rng.randrange(1000) for _ in range(16)] for _ in range(6)]
    rows = []
    for i in range(80):
        sig = [x if rng.random() > 0.2 else rng.randrange(1000) for x in rng.choice(base)]
        rows.append((i, i % 3, f"u{rng.randrange(60)}", sig if i % 11 else None))
    df = spark.createDataFrame(rows, "id long, day long, url string, sig array<long>")
    new, seen = df.filter("id % 2 = 1"), df.filter("id % 2 = 0")
    got = {r.id: (r.seen, r.match) for r in dedup.check_seen(new, seen, "id", "day", "url", "sig").collect()}
    want = {}
    for i, day, url, sig in rows:
        if i % 2 == 0:
            continue
        same = [j for j, d, u, _ in rows if j % 2 == 0 and d == day and u == url]
        like = [(-sum(x == y for x, y in zip(sig, t)) / 16, j) for j, d, _, t in rows if j % 2 == 0 and d == day and sig and t]
        like = [x for x in like if -x[0] >= 0.7]
        want[i] = ("url", min(same)) if same else ("title", min(like)[1]) if like else ("new", None)
    assert got == want and {w[0] for w in want.values()} == {"url", "title", "new"}


def test_repeated_rows_keep_their_tools(spark):
    df = spark.createDataFrame([("a.github.com",), ("a.github.com",), ("x.org",)], "host string")
    got = profile.tools_of_hosts(df, "host", {"github.com": "GitHub"}).collect()
    assert sorted((r.host, r.tool) for r in got) == [("a.github.com", "GitHub"), ("a.github.com", "GitHub"), ("x.org", None)]


def test_batches_keep_their_size(spark):
    got = Counter(r.batch for r in curation.batches(spark.range(103), "id", 20, 4).collect())
    assert sum(got.values()) == 103 and max(got.values()) == 20


def test_failed_rows_spoil_no_other(spark):
    def work(xs):
        if 3 in xs:
            raise ValueError("three")
        return [str(x) for x in xs]

    got = {r.id: (r.out, r.error) for r in curation.applied(spark.range(6).coalesce(1), work, "id", "out", single=True).collect()}
    assert got[3] == (None, "three") and got[4] == ("4", None)
    whole = {r.id: (r.out, r.error) for r in curation.applied(spark.range(6).coalesce(1), work, "id", "out").collect()}
    assert set(whole.values()) == {(None, "three")}


def test_files_are_whole_and_logs_swept(spark, tmp_path):
    df = spark.createDataFrame([("a/1", 'say "x"', ["t", "u"]), ("b", None, [])], "name string, text string, tags array<string>")
    data = sinks.category_zip(df, ["name", "text", "tags"], "name", "text")
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert sorted(z.namelist()) == ["a_1", "b", "manifest.csv"] and '"say ""x"""' in z.read("manifest.csv").decode()
    for content in (b"one", b"two"):
        sinks.write_bytes(spark, f"{tmp_path}/f.json", content)
    assert (tmp_path / "f.json").read_bytes() == b"two" and [p.name for p in tmp_path.iterdir() if p.name.endswith(".tmp")] == []
    days = spark.createDataFrame([(d, 1) for d in ("2024-01-01", "2024-01-05", "2024-01-09")], "day string, x int")
    sinks.append_day(days, f"{tmp_path}/log", "day")
    (tmp_path / "log" / "day=odd").mkdir()
    assert sinks.swept(spark, f"{tmp_path}/log", "day", "2024-01-05") == ["day=2024-01-01"]
    assert {p.name for p in (tmp_path / "log").iterdir() if p.is_dir()} == {"day=2024-01-05", "day=2024-01-09", "day=odd"}


def test_brief_drops_fragments_and_repeated_events(spark):
    rows = [(1, "Zebracorp ships quantum toaster for kitchens", 95, "a"), (2, "Review: the Zebracorp quantum toaster burns bread daily", 97, "b"), (3, "so true", 99, "c"), (4, "Walrus database handles many frozen queries well", 60, "a")]
    df = spark.createDataFrame(rows, "id long, text string, final int, who string")
    got = {r.id: r.slot for r in backstops.brief(df, "id", [F.desc("final"), F.asc("id")], "who", "text", key="id").collect()}
    assert got == {2: "top", 4: "top"}


def test_references_and_cuts(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()["x"]
    assert one(wording.references_decoded(F.lit("&#65;&#x1F600;&amp;#65; &#0; &#9999999; &lt;"))) == "A😀&#65; &#0; &#9999999; <"
    assert one(wording.word_clip(F.lit("aaa bbb ccc"), 9)) == "aaa bbb…" and one(wording.word_clip(F.lit("short"), 9)) == "short"
    assert one(wording.natural_cut(F.lit("One two. Three four five"), 12)) == "One two. …"
