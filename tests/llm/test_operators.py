"""The training-data operators against plain versions, and on odd rows."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import (
    chat, common, exact_dedup, fingerprints, html_extract, jaccard_join, mixing, packing, queries, repeats,
    substring_dedup, suffix_dedup, toxicity,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    return " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, nulls, empty and long texts, ties and repeated rows."""
    rng = np.random.default_rng(7)
    base = [words(rng, int(n)) for n in rng.integers(3, 200, 40)]
    passage, long = words(rng, 70), words(rng, 3000)
    out = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(base)]
    out += [(100 + i, base[i], "en", "s0", 0) for i in range(10)]
    out += [(200 + i, base[i] + " tail", "en", None, None) for i in range(10, 20)]
    out += [(300 + i, words(rng, 20) + " " + passage + "\n" + words(rng, 20), "en", "s1", 1) for i in range(6)]
    out += [(400, None, None, None, None), (401, "", "en", "s1", 0), (402, " \n\t ", "en", "s2", 4), (403, long, "en", "s1", 9)]
    out += [(404, long[:9000] + " é✓𝄞 " + long[9000:], "de", "s1", 9), (405, "one two", "en", "s1", 7), (406, "ONE  two", "en", "s1", 8)]
    out += [(407, "x" * 300, "en", "s1", 300), (408, "x" * 300, "en", "s1", 300)]
    out += [out[0], out[0], (None, base[1], "en", "s1", 1)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def unique(spark, rows):
    seen = {}
    for r in rows:
        if r[0] is not None:
            seen[r[0]] = r
    return spark.createDataFrame(list(seen.values()), SCHEMA), {k: v[1] or "" for k, v in seen.items()}


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_dedup(docs, rows, empty):
    got = exact_dedup.exact_dedup(docs).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for r in rows:
        groups[norm(r[1])].append(r[0])
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    assert len(got) == len(rows)
    for r in got:
        ids = [x for x in by_sha[r.text_sha256] if x is not None]
        assert r.keep_id == min(ids) and r.group_size == len(by_sha[r.text_sha256])
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.exact_dedup(empty).count() == 0
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_exact_dedup_carries_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a", 5, "x"), (2, "a", 6, "y")], "doc_id long, text string, keep_id int, full string")
    assert [tuple(r) for r in exact_dedup.deduplicated(df).collect()] == [(1, "a", 5, "x")]
    assert exact_dedup.exact_dedup(df).count() == 2


def test_mixing(docs, rows, empty):
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == len(rows)
    total = sum(len(WORD.findall(r[1] or "")) for r in rows)
    assert sum(r["size"] for r in got) == total
    again = {(r.id, r["size"], r.copies) for r in mixing.mix_sizes(docs.repartition(7)).collect()}
    assert again == {(r.id, r["size"], r.copies) for r in got}
    targets = {(r.source_size, r.target) for r in got}
    assert abs(sum(t for _, t in targets) - total) < 1e-6 * total
    assert all(t <= 3 * s + 1e-9 for s, t in targets) and all(0 <= r.copies <= 3 for r in got)
    assert mixing.mix_sizes(empty).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_mixing_targets_fill_like_water(spark):
    sizes = {"a": 10, "b": 100, "c": 1000, None: 50}
    df = spark.createDataFrame([(k or "", k is None, v) for k, v in sizes.items()], "src string, src_null boolean, source_size long")
    got = {None if r.src_null else r.src: r.target for r in mixing.targets(df).collect()}
    weight, total, cap = dict(zip(["a", "b", "c", None], [5, 2, 1, 5])), sum(sizes.values()), {k: 3 * v for k, v in sizes.items()}
    held = set()
    while True:
        rest = total - sum(cap[k] for k in held)
        level = rest / sum(weight[k] for k in sizes if k not in held)
        more = {k for k in sizes if k not in held and weight[k] * level > cap[k]}
        if not more:
            break
        held |= more
    assert got == pytest.approx({k: cap[k] if k in held else weight[k] * level for k in sizes})


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    got = packing.pack(docs, queries.byte_bpe(), with_ids=True).collect()
    exact = Tokenizer.from_file(queries.byte_bpe())
    expected = Counter()
    for r in rows:
        ids = np.array(exact.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4")
        for k, (a, n) in enumerate(packing.pieces_of(len(ids), 2048)):
            expected[r[0], k, a, n, zlib.crc32(ids[a : a + n].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty, queries.byte_bpe()).count() == 0


def test_encoder_equals_library():
    from tokenizers import Tokenizer

    exact, fast = Tokenizer.from_file(queries.byte_bpe()), packing._encoder(queries.byte_bpe())
    for t in ["", " a  b\n\n c ", "don't <|endoftext|> x", "é✓𝄞   z\t\t", "1234 --- !!\n"]:
        assert fast(t) == exact.encode(t, add_special_tokens=False).ids


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(1)
    for capacity in (10, 64):
        lengths = sorted(rng.integers(1, capacity + 1, 300).tolist(), reverse=True)
        left = []
        for n in lengths:  # one by one
            fits = [(x, i) for i, x in enumerate(left) if x >= n]
            if fits:
                left[min(fits)[1]] -= n
            else:
                left.append(capacity - n)
        plan, bins = packing.best_fit_plan(dict(Counter(lengths)), capacity)
        used = Counter()
        for length, _, count, first, each, _ in plan.tolist():
            for r in range(count):
                used[first + r // each] += length
        assert bins == len(left) and sorted(capacity - x for x in left) == sorted(used.values())


def brute_repeats(texts, split, width=50):
    """(tokens, covered) of each document."""
    first, tokens = {}, {d: split(t) for d, t in texts.items()}
    for d in sorted(tokens):
        for i in range(len(tokens[d]) - width + 1):
            first.setdefault(tuple(tokens[d][i : i + width]), d)
    out = {}
    for d, w in tokens.items():
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if first[tuple(w[i : i + width])] < d:
                gone[i : i + width] = [True] * width
        out[d] = (w, gone)
    return out


def test_substring_dedup(unique, docs, empty):
    df, texts = unique
    want = brute_repeats(texts, lambda t: [w.encode() for w in WORD.findall(t)])
    got = {r.doc_id: r for r in substring_dedup.dedup_substrings(df, with_text=True).collect()}
    assert got.keys() == want.keys()
    for d, (w, gone) in want.items():
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        assert (got[d].n_words, got[d].n_removed, got[d].kept_sha256) == (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
        assert got[d].kept_text.encode() == kept
    assert sum(r.n_removed for r in got.values()) > 300
    repeated = substring_dedup.dedup_substrings(docs).collect()
    assert len(repeated) == docs.count() and [r.n_removed for r in repeated if r.doc_id in (0, None)] == [0] * 4
    assert substring_dedup.dedup_substrings(empty).count() == 0


def test_suffix_dedup(unique, docs, empty):
    df, texts = unique
    want = brute_repeats(texts, lambda t: t.encode())
    got = {r.doc_id: r for r in suffix_dedup.dedup_suffixes(df, with_text=True).collect()}
    for d, (w, gone) in want.items():
        kept = bytes(x for x, g in zip(w, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        assert (got[d].n_bytes, got[d].n_removed, got[d].n_spans, got[d].kept_sha256) == (len(w), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    assert suffix_dedup.dedup_suffixes(docs).count() == docs.count()
    assert suffix_dedup.dedup_suffixes(empty).count() == 0


def test_long_texts_are_cut_into_overlapping_segments(monkeypatch):
    rng = np.random.default_rng(3)
    tokens = repeats.mix(rng.integers(0, 40, 5000).astype("u8"))
    whole = repeats.blocks_of(tokens, 50, 8)
    monkeypatch.setattr(repeats, "CHUNK", 100)
    parts = []
    for a, b, keep, end in repeats.segments(len(tokens), 50):
        at, first, *rest = repeats.blocks_of(tokens[a:b], 50, 8)
        inside = (at + a >= keep) & (at + a < end)
        parts.append((at[inside] + a, first[inside] + a, *(x[inside] for x in rest)))
    for x, y in zip(whole, zip(*parts)):
        assert np.array_equal(x, np.concatenate(y))


def test_multikey_order():
    rng = np.random.default_rng(2)
    columns = [rng.integers(0, n, 500).astype("u8") for n in (3, 4, 50)]
    assert suffix_dedup.multikey_order(*columns).tolist() == np.lexsort(columns[::-1]).tolist()


def test_jaccard_components(unique, docs, empty):
    df, texts = unique
    sets = {}
    for d, t in texts.items():
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {d: d for d in sets}

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
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect()}
    assert got == {d: (len(s), find(d)) for d, s in sets.items()}
    assert jaccard_join.jaccard_components(docs).count() == docs.count()
    assert jaccard_join.jaccard_components(empty).count() == 0
    assert jaccard_join.one_of_each(df).columns == df.columns


def test_partners_share_a_lane():
    rng = np.random.default_rng(5)
    for size in [*range(4, 40), 100, 333, 1000]:
        for _ in range(5):
            union = rng.integers(0, 2**63, size).astype("u8")
            drop = size - -(-3 * size // 4)  # as many apart as a link allows
            left = rng.integers(0, drop + 1)
            a, b = np.unique(union[left:]), np.unique(np.r_[union[:left], union[drop:]])
            if jaccard_join.linked(a, b):
                assert np.intersect1d(jaccard_join.signatures(a), jaccard_join.signatures(b)).size or np.array_equal(a, b)


def test_large_group_keeps_links_beyond_its_head(spark):
    """More documents than are paired at once share lanes with a chain that the smallest id doesn't link to."""
    head = [f"w{i}" for i in range(400)]
    texts = {}
    for i in range(30):
        w = list(head)
        for j in range(i):
            w[(13 * j) % 400] = f"c{j}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.component_id for r in jaccard_join.jaccard_components(df).collect()}
    assert got == {0}


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40) if i % 10], "a long, b long")
    got = {r.node: r.root for r in jaccard_join.components(edges).collect()}
    assert got == {i: (i - 1) // 10 * 10 + 1 for i in range(1, 41) if i % 10 != 1}


def test_chat_round_trip_and_events(spark):
    said = ["a</s>[INST] ok [/INST]", "<\\s> <<SYS>> <\\<SYS>>", "<|x|> [\\\\INST] \\", "line\nend[", None]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(said)] + [(2, None, None, None), (2, 0, "tool\n%0A", "t")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    shown = chat.format_conversations(chat.log_of(df))
    back = {r.conv_id: r.turns for r in shown.select("conv_id", chat.parsed(F.col("formatted")).alias("turns")).collect()}
    assert [(t.role, t.text) for t in back[1]] == [(r[2], r[3] or "") for r in rows[:5]]
    assert [(t.role, t.text) for t in back[2]] == [("", ""), ("tool\n%0A", "t")]
    for r in shown.collect():
        assert r.formatted.count("<s>[INST]") == r.formatted.count("[/INST]</s>") == len(back[r.conv_id])
    log = [(1, 1, 0, "message", "user", "hi"), (1, 2, 1, "delta", "assistant", "one "), (1, 2, 2, "delta", None, "two"), (1, 2, 3, "regenerate", None, None),
           (1, 2, 4, "delta", None, "three"), (1, 1, 5, "edit", None, "hello"), (1, 3, 6, "message", "user", "gone"), (1, 3, 7, "delete", None, None)]
    log = spark.createDataFrame(log, "conv_id long, turn long, seq long, kind string, role string, text string")
    got = chat.messages(log).orderBy("turn").collect()
    assert [(r.role, r.text) for r in got] == [("user", "hello"), ("assistant", "three")]
    assert chat.format_conversations(chat.log_of(df.limit(0))).count() == 0


def test_fingerprints(spark, docs, rows, empty):
    got = fingerprints.edit_likeness(docs).collect()
    assert len(got) == len(rows)
    by_sha = {}
    order = sorted({r[0] for r in rows if r[0] is not None}, reverse=True)
    text = {r[0]: r[1] or "" for r in rows}
    for r in got:
        if r.doc_id in (None, 0):
            continue
        t = text[r.doc_id]
        after = text[order[(order.index(r.doc_id) + 1) % len(order)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert by_sha.setdefault(t, r.fingerprint) == r.fingerprint and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) >= (edited == t)
    assert fingerprints.edit_likeness(empty).count() == 0


def test_fingerprints_follow_the_words_of_any_language(spark):
    rng = np.random.default_rng(12)
    endings = {"en": ["", "s", "d"], "es": ["o", "a", "é", "ñ"], "zh": ["好", "国"], "loud": ["!!"], "dots": ["."]}
    rows = []
    for n, (lang, ends) in enumerate(endings.items()):
        for i in range(30):
            text = " ".join(w + ends[j % len(ends)] for j, w in enumerate(words(rng, 120).split()))
            rows.append((100 * n + i, text, lang, "s0", len(text)))
    text, lang = {r[0]: r[1] for r in rows}, {r[0]: r[2] for r in rows}
    order, off = sorted(text, reverse=True), defaultdict(list)
    for r in fingerprints.edit_likeness(spark.createDataFrame(rows, SCHEMA)).collect():
        t, after = text[r.doc_id], text[order[(order.index(r.doc_id) + 1) % len(order)]]
        x, y = Counter(WORD.findall(t)), Counter(WORD.findall(t[: len(t) - len(t) // 2] + after[: len(t) // 2]))
        off[lang[r.doc_id]].append(r.near_edited - sum((x & y).values()) / sum((x | y).values()))
    for ds in off.values():
        assert len(ds) == 30 and abs(np.mean(ds)) < 0.05 and max(map(abs, ds)) < 0.3


def test_sampling_estimates_generalised_jaccard(spark):
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), 5)) + "d" for _ in range(60)]
    a = rng.choice(vocabulary, 300).tolist()
    b = a[:200] + rng.choice(vocabulary, 100).tolist()
    x, y = Counter(a), Counter(b)
    exact = sum((x & y).values()) / sum((x | y).values())
    df = spark.createDataFrame([(1, a), (2, b)], "id long, phrases array<string>")
    got = {r.id: r.fp for r in fingerprints.fingerprints(df, ["id"], 512).collect()}
    assert abs(np.mean(np.array(got[1]) == np.array(got[2])) - exact) < 0.08


def test_html(spark):
    def page(host, path, body):
        return (f"https://{host}{path}", f"<html><head><title>t</title><script>var x='</p>';</script></head><body>{body}</body></html>")

    nav = '<nav><ul><li>Home<li>News</ul></nav><div class="ad">Buy &amp; go</div>'
    foot = '<div class="comments"><p>Nice!</p></div><footer>&copy; me</footer>'
    pages = [
        page("a.org", "/x/1", nav + "<article><header><h1>T &lt;1&gt;</h1></header><p><b>One\n two<br>x<p>Same line</article>" + foot),
        page("a.org", "/x/2", nav + "<article><p>Same line</p><aside>side</aside><p>Three</p></article>" + foot),
        page("b.org", "/p/1", "<div>Top line</div><p>own one</p><div>Bottom</div>"),
        page("b.org", "/p/2", "<div>Top line</div><p>own two</p><div>Bottom</div>"),
        (None, None), ("https://c.org/", "<p>cut off <a href='"),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {0: "T <1>\n\nOne two x\n\nSame line", 1: "Same line\n\nThree", 2: "own one", 3: "own two", 4: "", 5: "cut off"}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_common_lines():
    a, b = list("xabcabay"), list("xcbabacz")
    left, right = html_extract.common_lines(a, b)
    assert [a[i] for i in sorted(left)] == [b[j] for j in sorted(right)] and len(left) == 5


def test_toxicity(spark, empty):
    rng = np.random.default_rng(11)
    rows, labels = [], []
    for i in range(600):
        w = words(rng, int(rng.integers(20, 80))).split()
        toxic = i % 5 == 0
        if toxic:
            for k in range(2):
                w[int(rng.integers(0, len(w)))] = ["zorgish", "zorgen", "blaarg"][int(rng.integers(0, 3))]
        rows.append((i, " ".join(w), "en", "s", 0))
        if i % 2 == 0:
            labels.append((i, 1, int(toxic)))
    rows += [(None, None, None, None, None), (1000, "", "en", "s", 0), (1000, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score_ids(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        want = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
        assert r.held_out == want and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    right = [r.predicted == (r.doc_id % 5 == 0) for r in got if r.doc_id is not None and r.doc_id < 600]
    assert np.mean(right) > 0.97
    assert toxicity.score_ids(empty, toxicity.train(empty, labels)).count() == 0
    assert toxicity.without_toxic(docs, labels).columns == docs.columns


def test_neighbours_cross_ranges(spark):
    df = spark.range(500).select((F.col("id") * 3).alias("k"), F.lit(0).alias("t"))
    got = common.with_neighbours(df, ["k", "t"], 16, split=["k"], cyclic=True)
    from pyspark.sql import Window

    w = Window.partitionBy("_bucket").orderBy("_row")
    got = {r.k: (r.p, r.n) for r in got.select("k", "_side", F.lag("k").over(w).alias("p"), F.lead("k").over(w).alias("n")).filter("_side = 0").collect()}
    assert got == {3 * i: (3 * ((i - 1) % 500), 3 * ((i + 1) % 500)) for i in range(500)}


def test_pipeline_keeps_clean_and_drops_copies(spark, tmp_path):
    import corpus_pipeline

    rng = np.random.default_rng(21)
    texts = [words(rng, 60) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    rows += [(50 + i, texts[i] + "  ", "en", "s0", 0) for i in range(5)] + [(60, texts[0] + " more", "en", "s0", 0), (61, texts[1], "en", "s0", 0)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], (47, 46, 40)):
        docs = common.durable(stage(spark, docs, str(tmp_path)), "t")
        assert docs.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert {r.doc_id for r in docs.collect()} == set(range(40))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns) and got.count() > 30
