"""Column functions: text, URLs, dates, hashes and numbers, all inside the JVM but ``minhash_batch``."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

from . import fixed, stemming


def words_in(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def slug(text: Column) -> Column:
    """Lower case, ``&`` as ``and``, runs of other characters as one hyphen, none at either end."""
    plain = F.regexp_replace(F.lower(F.trim(text)), "&", " and ")
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def decoded_entities(text: Column) -> Column:
    """The five named references and numbers' plain forms; the ampersand last, so that nothing is decoded twice."""
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def stripped_tags(html: Column) -> Column:
    """Text without scripts, styles and tags, with white space in single spaces."""
    text = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]+>", " ")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def query_tokens(text: Column, stop: list[str] = fixed.SEARCH_STOP_WORDS, limit: int = 16) -> Column:
    """Distinct tokens of two characters or more that aren't stop words, the first ``limit``."""
    got = F.split(F.lower(text), "[^a-z0-9]+")
    kept = F.filter(got, lambda w: (F.length(w) >= 2) & ~w.isin(stop))
    return F.slice(F.array_distinct(kept), 1, limit)


def keywords(text: Column, limit: int = 10) -> Column:
    """The first keywords of a question, repeats kept."""
    got = F.split(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", " "), r"\s+")
    return F.slice(F.filter(got, lambda w: (F.length(w) >= 2) & ~w.isin(fixed.KEYWORD_STOP_WORDS)), 1, limit)


def host_of(url: Column) -> Column:
    host = F.lower(F.regexp_extract(url, r"(?i)^[a-z][a-z0-9+.-]*://([^/?#:]+)", 1))
    host = F.regexp_replace(host, r"^www\.", "")
    folded = F.regexp_replace(host, r"^(m|mobile)\.", "")
    return F.when(folded.isin("x.com", "twitter.com"), "x.com").otherwise(host)


def canonical_url(url: Column) -> Column:
    """https, bare host, no fragment, no tracking parameters, the others in order, no closing slash."""
    given = F.trim(url)
    full = F.when(F.regexp_like(given, F.lit(r"(?i)^[a-z][a-z0-9+.-]*://")), given).otherwise(F.concat(F.lit("https://"), given))
    host = host_of(full)
    port = F.regexp_extract(full, r"^[^/]*//[^/?#:]+(:[0-9]+)", 1)
    path = F.regexp_replace(F.regexp_extract(full, r"^[^/]*//[^/?#]*([^?#]*)", 1), "/+$", "")
    pairs = F.split(F.regexp_extract(full, r"^[^?#]*\?([^#]*)", 1), "&")
    key = lambda p: F.lower(F.substring_index(p, "=", 1))
    kept = F.filter(
        pairs,
        lambda p: (p != "") & ~key(p).startswith("utm_") & ~key(p).isin(fixed.TRACKING_PARAMETERS) & ~((host == "x.com") & (key(p) == "s")),
    )
    query = F.array_join(F.array_sort(kept), "&")
    return F.concat(F.lit("https://"), host, port, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def pt_day(ts: Column) -> Column:
    """The calendar day in Los Angeles of a UTC time."""
    return F.to_date(F.from_utc_timestamp(ts, "America/Los_Angeles"))


def python_round(x: Column) -> Column:
    """Half to even, as a whole number."""
    return F.bround(x, 0).cast("int")


def half_up(x: Column, places: int = 3) -> Column:
    scale = float(10**places)
    return F.floor(x * scale + 0.5) / scale


def clamp(x: Column, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def wilson(successes: Column, trials: Column, z: float = 1.96) -> Column:
    """Lower bound of the Wilson interval; more successes than trials are an error."""
    s, n = F.greatest(successes.cast("double"), F.lit(0.0)), F.greatest(trials.cast("double"), F.lit(0.0))
    p, z2 = s / n, z * z
    low = (p + z2 / (2 * n) - z * F.sqrt((p * (1 - p) + z2 / (4 * n)) / n)) / (1 + z2 / n)
    bad = F.raise_error(F.lit("more successes than trials")).cast("double")
    return F.when(s > n, bad).when((s <= 0) | (n <= 0), 0.0).otherwise(clamp(low, 0.0, 1.0))


def title_tokens(title: Column) -> Column:
    """Distinct tokens of a title in compatibility decomposition: an accent ends a token, as any character but letters and digits does."""
    text = F.lower(stemming.decomposed(title))
    return F.array_distinct(F.regexp_extract_all(F.regexp_replace(text, "['’]", ""), F.lit("([a-z0-9]+)"), F.lit(1)))


def fnv1a32(text: str) -> str:
    """SQL for the 32-bit FNV-1a hash of an ASCII text, as a long."""
    return f"aggregate(split({text}, ''), 2166136261L, (h, c) -> ((h ^ ascii(c)) * 16777619L) & 4294967295L)"


def minhash(tokens: str, size: int = 128) -> Column:
    """For each seed the least FNV hash of ``seed:token`` over an array column of tokens."""
    return F.expr(f"transform(sequence(0, {size - 1}), s -> array_min(transform({tokens}, t -> {fnv1a32("concat(s, ':', t)")})))")


def minhash_batch(size: int = 128):
    """A function of a column of tokens ([a-z0-9]+) that equals :func:`minhash`, for whole texts: hashing is sequential, and each word of some rows is hashed once."""
    def run(tokens: pd.Series) -> pd.Series:
        start = []
        for seed in range(size):
            h = 2166136261
            for c in f"{seed}:":
                h = ((h ^ ord(c)) * 16777619) & 0xFFFFFFFF
            start.append(h)
        start, prime, out = np.array(start, np.uint32), np.uint32(16777619), []
        for at in range(0, len(tokens), 256):
            part = tokens.iloc[at : at + 256].tolist()
            words = sorted({w for row in part if row is not None for w in row}, key=len, reverse=True)
            place, left = {w: i for i, w in enumerate(words)}, len(words)
            h = np.repeat(start[None, :], len(words), 0)
            for i in range(len(words[0]) if words else 0):
                while len(words[left - 1]) <= i:
                    left -= 1
                h[:left] = (h[:left] ^ np.array([ord(w[i]) for w in words[:left]], np.uint32)[:, None]) * prime
            for row in part:
                some = row is not None and len(row) > 0
                out.append(h[[place[w] for w in row]].min(axis=0).astype(np.int64) if some else None)
        return pd.Series(out, dtype=object)

    return F.pandas_udf(run, "array<bigint>")


def minhash_text(signature: Column) -> Column:
    """A signature in base 36, seven digits a slot, joined by points."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.conv(x.cast("string"), 10, 36), 7, "0"))), ".")


def substance_words(text: Column) -> Column:
    """The word tokens left of a text without URLs, leading mentions, emoji and punctuation."""
    t = F.regexp_replace(text, r"(?i)https?://\S+", " ")
    t = F.regexp_replace(t, r"^(?:\s*@\w+)+\s*", " ")
    t = F.regexp_replace(t, "[\U0001F000-\U0001FAFF☀-➿←-⇿⌀-⏿️‍]+", " ")
    t = F.regexp_replace(t, r"(?U)[^\w\s]", " ")
    return F.filter(F.split(t, r"(?U)\s+"), lambda w: F.regexp_like(w, F.lit(r"(?U)[\p{Alnum}]")))


def is_bare_fragment(text: Column, min_words: int = 4, min_chars: int = 15) -> Column:
    words = substance_words(F.coalesce(text, F.lit("")))
    return (F.size(words) < min_words) | (F.length(F.array_join(words, " ")) < min_chars)


def significant(text: Column) -> Column:
    """Lower-case tokens in order, without stop words, numbers, URLs and mentions."""
    t = F.regexp_replace(F.regexp_replace(F.lower(text), r"https?://\S+", " "), r"@\w+", " ")
    words = F.regexp_extract_all(t, F.lit("([a-z0-9]+)"), F.lit(1))
    return F.filter(words, lambda w: ~w.isin(fixed.EVENT_STOP_WORDS) & ~F.regexp_like(w, F.lit("^[0-9]+$")))


def distinctive_bigrams(text: Column) -> Column:
    """Distinct pairs of neighbouring tokens of which one names something, as structs (a, b, strong)."""
    words = significant(text)
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    common = lambda w: w.isin(fixed.GENERIC_WORDS)
    kept = F.filter(
        pairs,
        lambda p: p["b"].isNotNull()
        & ~(common(p["a"]) & common(p["b"]))
        & (~common(p["a"]) | (F.length(p["b"]) >= 3))
        & (~common(p["b"]) | (F.length(p["a"]) >= 3)),
    )
    return F.array_distinct(F.transform(kept, lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b"), (~common(p["a"]) & ~common(p["b"])).alias("strong"))))


def grade(score: Column) -> Column:
    out, s = F.lit("D"), python_round(score.cast("double"))
    for low, letter in reversed(fixed.GRADES):
        out = F.when(s >= low, letter).otherwise(out)
    return out


def count_of(text: Column) -> Column:
    """A number written with commas or a k, m or b suffix."""
    t = F.lower(F.replace(F.trim(text), F.lit(",")))
    n = F.regexp_extract(t, r"^([0-9]+(?:\.[0-9]+)?)", 1)
    scale = F.when(t.endswith("k"), 1e3).when(t.endswith("m"), 1e6).when(t.endswith("b"), 1e9).otherwise(1.0)
    return F.when(n != "", F.floor(n.cast("double") * scale + 0.5)).cast("long")


def any_time(text: Column) -> Column:
    """An ISO-8601 or RFC-1123 time; null where it is neither."""
    iso = F.try_to_timestamp(text)
    rfc = F.regexp_replace(text, r"^\w{3}, (.*?)( GMT| [+-]0000)?$", "$1")
    return F.coalesce(iso, F.when(F.regexp_like(text, F.lit(r"^\w{3}, ")), F.try_to_timestamp(rfc, F.lit("dd MMM yyyy HH:mm:ss"))))


def best_variant(variants: Column) -> Column:
    """URL of the mp4 variant of highest bit rate, the first of equals; variants are structs (content_type, bitrate, url)."""
    ranked = F.transform(variants, lambda v, i: F.struct(F.coalesce(v["bitrate"], F.lit(0)).alias("rate"), (-i).alias("at"), v["url"].alias("url"), v["content_type"].alias("kind")))
    return F.array_max(F.filter(ranked, lambda v: v["kind"] == "video/mp4"))["url"]


def distinct_ignoring_case(values: Column) -> Column:
    """Values in order, of those equal but for case the first."""
    lowered = F.transform(values, lambda v: F.lower(v))
    return F.filter(values, lambda v, i: F.array_position(lowered, F.lower(v)) == i + 1)


def literals(pattern: str) -> list[str] | None:
    """A literal that each alternative of a pattern starts with, in lower case; None if one starts with none."""
    flat = pattern.replace(r"\b(", "").replace(r")\b", "").replace(r"\b", "")
    out = []
    for part in flat.split("|"):
        head = re.match(r"(?:[A-Za-z0-9 `&/_-]|\\\.)*", part)[0]
        if part[len(head):][:1] in ("?", "*", "{"):
            head = head[:-1]
        if not head or "(" in part:
            return None
        out.append(head.replace("\\.", ".").lower())
    return sorted(set(out))


def ascii_words(text: Column) -> Column:
    """A text in which every character beyond ASCII is one that ends a word, as it does in ASCII word boundaries."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "\x01")


def like(low: Column, plain: Column, pattern: str) -> Column:
    """Whether a text matches a pattern, case ignored: ``low`` is the text in lower case, ``plain`` its :func:`ascii_words`.

    The pattern runs only on texts that hold one of its literals.
    """
    found, some = F.regexp_like(plain, F.lit("(?i)" + pattern)), literals(pattern)
    return found if some is None else F.when(F.exists(words_in(some), lambda x: F.contains(low, x)), found).otherwise(False)


def matches(low: Column, plain: Column, rules: list[tuple]) -> Column:
    """Names (first of each rule) whose pattern (last) the text matches."""
    return F.array_compact(F.array(*[F.when(like(low, plain, r[-1]), F.lit(r[0])) for r in rules]))
