"""Whether the operators keep to their methods: parts of them against plain versions, and the pipeline stage by stage."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, exact_dedup, fingerprints, html_extract, jaccard_join, mixing, queries, repeats, substring_dedup, suffix_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return ["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(n)]


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(texts):
    """The least id that each id reaches by links, all pairs tried."""
    sets, root = {d: shingle_set(t) for d, t in texts.items()}, {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d in texts}


# ---------------------------------------------------------------- joins


def test_near_pairs_equal_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300).astype("u8")
    sets = [np.unique(np.r_[base[: int(n)], rng.integers(0, 2**63, int(m)).astype("u8")]) for n, m in zip(rng.integers(150, 300, 60), rng.integers(0, 60, 60))]
    n, sketch = np.array([len(s) for s in sets]), [jaccard_join.parity_sketch(s) for s in sets]
    group, tile, root = rng.integers(0, 3, 60), rng.integers(0, 2, 60), rng.integers(0, 5, 60)
    whole, node = group != 1, np.arange(60) + 100
    got = set(zip(*(x.tolist() for x in jaccard_join.near_pairs(group, tile, whole, node, root, n, sketch))))
    want = set()
    for i in range(60):
        for j in range(i + 1, 60):
            fit = group[i] == group[j] and root[i] != root[j] and (whole[i] or tile[i] != tile[j]) and 4 * min(n[i], n[j]) >= 3 * max(n[i], n[j])
            if fit and jaccard_join.sketch_distance(sketch[i], sketch[j]) <= (n[i] + n[j]) // 7:
                want.add((100 + i, 100 + j))
    assert want <= got and all(root[a - 100] != root[b - 100] for a, b in got) and len(want) > 5


@pytest.mark.parametrize("tile", [4, 2048])
def test_hot_lanes_over_several_components(spark, monkeypatch, tile):
    """A passage that all documents share, and near copies that only its lanes' members outside the head's component link."""
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    rng = np.random.default_rng(8)
    passage, texts = words(rng, 90), {}
    for k in range(12):
        own = words(rng, 60)
        for c in range(3):
            w = passage + own
            w[(7 * c + k) % 150] = f"edit{c}"
            texts[100 * c + k] = " ".join(w)
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df).collect()}
    assert got == components(texts) and len(set(got.values())) == 12


def test_one_of_each_carries_clashing_columns(spark):
    rows = [(1, "a b c d e f g", 7, "x"), (2, "a b c d e f g", 8, "y"), (None, "a b c d e f g", 9, "z"), (3, None, 1, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone int, rep string")
    assert sorted((r.gone for r in jaccard_join.one_of_each(df).collect())) == [1, 7, 9]


# ---------------------------------------------------------------- repeats


def test_parse_is_greedy_over_matches():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = int(rng.integers(1, 12))
        first, count = np.sort(rng.integers(0, 300, n)), rng.integers(50, 90, n)
        source = rng.integers(0, 3, n)
        origin = first + source * 1000
        found = substring_dedup.matches(first, count, source, origin)
        at, want = 0, []
        while True:  # word by word
            over = [m for m in found if m[0] <= at < m[1]]
            if over:
                best = max(m[1] for m in over)
                want.append((at, best))
                at = best
            elif any(m[0] > at for m in found):
                at += 1
            else:
                break
        got = substring_dedup.parse(found)
        assert [f[:2] for f in got] == want
        assert all(place - a == s * 1000 for a, _, s, place in got)
        gone = np.zeros(400, bool)
        for a, c in zip(first, count):
            gone[a : a + c] = True
        mine = np.zeros(400, bool)
        for a, b, _, _ in got:
            mine[a:b] = True
        assert (gone == mine).all()


def test_factors_name_words_of_earlier_documents(spark):
    rng = np.random.default_rng(6)
    shared, texts = words(rng, 200), {}
    for i in range(12):
        a = int(rng.integers(0, 100))
        texts[i] = " ".join(words(rng, 30) + shared[a : a + 90] + words(rng, 20) + shared[10:75])
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(df, with_text=True).collect()}
    assert sum(len(r.spans) for r in got.values()) > 11
    for d, r in got.items():
        for s in r.spans:
            assert s.source < d and texts[s.source].split()[s.place : s.place + s.end - s.start] == texts[d].split()[s.start : s.end]


# ---------------------------------------------------------------- mixing, exact dedup


def test_copies_follow_from_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL_ROWS", 5)  # several parts a size
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(["w"] * int(n)), "en", ["a", "b", None][i % 3], 0) for i, n in enumerate(rng.integers(0, 12, 400))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df).select(F.col("row.source").alias("source"), "size", "source_size", "target", "copies").collect()
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
    offsets = {r.source: r.u for r in df.select("source").distinct().select("source", F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), F.lit(42)), F.lit(mixing.UNIT)).alias("u")).collect()}
    for source, rs in by.items():
        rate, seen, taken = round(rs[0].target / rs[0].source_size * mixing.UNIT), 0, 0
        for size in sorted({r["size"] for r in rs}, reverse=True):  # whole sizes: the order inside one is free
            seen += sum(r["size"] == size for r in rs)
            taken += sum(r.copies for r in rs if r["size"] == size)
            assert taken == (seen * rate + offsets[source]) // mixing.UNIT
        words_taken = sum(r.copies * r["size"] for r in rs)
        assert abs(words_taken - rs[0].target) <= 12 and all(0 <= r.copies <= 3 for r in rs)


def test_deduplicated_is_the_same_by_either_way(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = [" ".join(words(rng, 8)) for _ in range(20)]
    rows = [(i, base[i % 20] + ("  " if i % 2 else " "), "en", "s", i) for i in range(60)] + [(3, base[3] + " ", "en", "s", 3)] * 2
    rows += [(None, base[4] + " ", "en", "s", 1), (None, "", "en", "s", 1), (70, None, "en", "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    few = Counter((r.doc_id, r.text) for r in exact_dedup.deduplicated(df).collect())
    monkeypatch.setattr(exact_dedup, "FEW", 0)
    assert Counter((r.doc_id, r.text) for r in exact_dedup.deduplicated(df).collect()) == few
    kept = {r.doc_id for r in exact_dedup.exact_dedup(df).filter("kept").collect()}
    assert {d for d, _ in few} == kept and sum(few.values()) == 21


# ---------------------------------------------------------------- fingerprints


def test_likeness_is_near_the_exact_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    order = sorted(text, reverse=True)
    after = dict(zip(order, order[1:] + order[:1]))
    off = []
    for r in fingerprints.edit_likeness(docs).collect():
        t, n = text[r.doc_id], text[after[r.doc_id]]
        x, y = Counter(WORD.findall(t)), Counter(WORD.findall(t[: len(t) - len(t) // 2] + n[: len(t) // 2]))
        if sum(x.values()) < 20:
            continue
        exact = sum((x & y).values()) / max(1, sum((x | y).values()))
        off.append(r.near_edited - exact)
        assert r.near_edited > 0 or exact < 0.2
    assert len(off) > 900 and abs(np.mean(off)) < 0.03 and np.std(off) < 0.09


def test_bound_leaves_no_sample_out(spark, monkeypatch):
    rng = np.random.default_rng(14)
    rows = [(i, rng.choice(words(rng, 80), int(n)).tolist()) for i, n in enumerate([1, 2, 30, 200, 900])]
    df = spark.createDataFrame(rows, "id long, phrases array<string>")
    got = {r.id: r.fp for r in fingerprints.fingerprints(df, ["id"]).collect()}
    monkeypatch.setattr(fingerprints, "BEYOND", 1e6)
    assert got == {r.id: r.fp for r in fingerprints.fingerprints(df, ["id"]).collect()}


# ---------------------------------------------------------------- pages


@pytest.mark.parametrize(("html", "text"), [
    ('<p title="a hidden gem">One</p>', "One"), ('<p data-id="search">One</p><p data-role="menu">Two</p>', "One\n\nTwo"),
    ('<p>Text <span class="ad">Buy now</span> more</p>', "Text more"), ('<p>a <span style="display:none">secret</span><a class="share">Share</a> b</p>', "a b"),
    ("<nav/>menu</nav><p>body</p>", "body"), ("<article><p>in</p></article><div>out</div>", "in\n\nout"),
    ("<p>a<div hidden>b</div><p aria-hidden='true'>c<p>d", "a\n\nd"), ("<article>" + "<p>x</p>" * 3000 + "</article>", "\n\n".join(["x"] * 3000)),
])
def test_markup(html, text):
    assert html_extract.main_text(html_extract.lines_of(html), set()) == text


def test_shared_lines_go_whatever_the_markup(spark):
    page = lambda own: f"<div>Site of tests</div><article><p>{own}</p><p>Same words</p></article><p>All rights kept</p><p>{own} too</p>"
    rows = [(1, "http://a.org/x/1", page("one"), "h"), (2, "http://a.org/x/2", page("two"), "h"), (2, "http://a.org/x/2", page("two"), "h"), (3, None, None, "h")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted((r.page_id, r.text) for r in html_extract.extract(df).collect())
    assert got[0] == (1, "one\n\nSame words\n\none too") and got[3] == (3, "") and len(got) == 4


# ---------------------------------------------------------------- pipeline


def test_pipeline_stage_by_stage(spark, tmp_path):
    import corpus_pipeline

    from tokenizers import Tokenizer

    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(300):
        w = words(rng, int(rng.integers(20, 90)))
        if i % 5 == 0:
            w[3], w[9], w[14] = "zorgish", "zorgen", "blaarg"
        rows.append((i, " ".join(w), "en", f"s{i % 4}", 0))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 5 == 0)))
    clean = [r for r in rows if r[0] % 5]
    rows += [(400 + k, r[1] + "  ", "en", "s0", 1) for k, r in enumerate(clean[:20])]
    rows += [(500 + k, r[1] + " tail", "en", None, None) for k, r in enumerate(clean[20:40])]
    rows += [(600, None, None, None, None), (601, "", "en", "s1", 0), (None, clean[50][1], "en", "s1", 0), rows[1]]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, stages, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), dict(corpus_pipeline.STAGES), []
    for name in list(stages)[:4]:
        docs = common.durable(stages[name](spark, docs, str(tmp_path)), "t")
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
        kept.append(Counter((r.doc_id, r.text) for r in docs.collect()))
    given = Counter((r[0], r[1]) for r in rows)
    model = toxicity.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    assert kept[0] == Counter({k: n for k, n in given.items() if model.score(k[1] or "") < 0.5})
    assert sum(given.values()) - sum(kept[0].values()) >= 50 and all(d is None or d >= 300 or d % 5 for d, _ in kept[0])
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    first = {}
    for d, t in sorted(kept[0], key=lambda x: (x[0] is None, x[0] or 0)):
        first.setdefault(norm(t), (d, t))
    assert kept[1] == Counter(first.values())
    root = components({d: t or "" for d, t in kept[1] if d is not None})
    assert kept[2] == Counter({k: n for k, n in kept[1].items() if k[0] is None or root[k[0]] == k[0]})
    mixed = mixing.mix(spark.createDataFrame([(d, t, "en", src, 0) for (d, t), src in ((k, next(r[3] for r in rows if (r[0], r[1]) == k)) for k in kept[2])], SCHEMA))
    copies = {(r.d, r.t): r.copies for r in mixed.select(F.col("row.doc_id").alias("d"), F.col("row.text").alias("t"), "copies").collect()}
    assert kept[3] == Counter({k: n for k, n in copies.items() if n})
    exact, want = Tokenizer.from_file(queries.byte_bpe()), Counter()
    for (d, t), n in kept[3].items():
        ids = np.array(exact.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want[d, 0, len(ids), zlib.crc32(ids.tobytes())] += n
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in out) == want


def test_pipeline_over_no_documents(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_suffixes_of_one_leading_value_are_split(spark):
    rng = np.random.default_rng(3)
    texts = ["".join("x" * 12 + f"{n:04d}" for n in rng.integers(0, 10000, 400)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cuts = suffix_dedup.sampled_splitters(df, "doc_id", "text", 50, 32)
    lead, key = [], []
    for t in texts:
        raw = np.frombuffer(t.encode(), "u1")
        both = suffix_dedup.leading(raw, repeats.blocks_of(repeats.byte_values(raw), 50, 16)[0])
        lead, key = [*lead, both[0]], [*key, both[1]]
    lead, key = np.concatenate(lead), np.concatenate(key)
    size = np.bincount(suffix_dedup.bucket_of(cuts, lead, key))
    assert np.bincount(np.unique(lead, return_inverse=True)[1]).max() > 0.2 * len(lead) and size.max() < 0.1 * len(lead)
    order = np.lexsort((key, lead))
    assert (np.diff(suffix_dedup.bucket_of(cuts, lead, key)[order]) >= 0).all()


def test_windows_in_more_bins_give_the_same(spark, monkeypatch):
    base = "".join(chr(97 + int(x)) for x in np.random.default_rng(4).integers(0, 26, 400))
    rows = [(i, base[: 60 + i] + f"{i:03d}" * 40 + base[200 + i :]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = suffix_dedup.dedup_suffixes(df).collect()
    monkeypatch.setattr(repeats, "BIN_WINDOWS", 100)
    got = suffix_dedup.dedup_suffixes(df).collect()
    assert sorted(got) == sorted(want) and any(r.n_removed for r in got)


def test_payloads_travel_in_batches_of_bounded_size(monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 10_000)
    rng = np.random.default_rng(5)
    arrays = {"a": rng.integers(0, 1 << 62, 20_000)}
    bins = rng.integers(0, 50, 20_000)
    batches = list(repeats.dealt(bins, arrays, 7))
    back = {b: repeats.unpack(x, a="i8")["a"] for batch in batches for b, x in zip(batch.column("bin").to_pylist(), batch.column("payload").to_pylist())}
    assert len(batches) > 5 and sorted(back) == list(range(50)) and all((back[b] == arrays["a"][bins == b]).all() for b in back)
