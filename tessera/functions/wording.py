"""Column functions on wording: slugs, file names, references, cuts, Markdown, echoes, scripts and languages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import lists, scalars


def _sub(text: Column, *steps: tuple[str, str]) -> Column:
    return reduce(lambda t, s: F.regexp_replace(t, s[0], s[1]), steps, text)


def stripped(text: Column) -> Column:
    return _sub(text, (r"^\s+|\s+$", ""))


def category_slug(name: Column) -> Column:
    """Other characters dropped, white space as one hyphen."""
    return _sub(F.lower(F.trim(name)), (r"[^a-z0-9\s-]", ""), (r"\s+", "-"), ("-+", "-"), ("^-|-$", ""))


def note_slug(text: Column) -> Column:
    """The ampersand as ``and``, runs of other characters as one hyphen."""
    return _sub(F.replace(F.lower(F.trim(text)), F.lit("&"), F.lit("and")), ("[^a-z0-9]+", "-"), ("^-+|-+$", ""))


def topic_slug(text: Column) -> Column:
    """A tag without its sign, the ampersand as a word of its own."""
    bare = F.lower(_sub(F.trim(text), ("^#", ""), ("^@", "")))
    return _sub(F.replace(bare, F.lit("&"), F.lit(" and ")), ("[^a-z0-9]+", "-"), ("^-+|-+$", ""))


def unique_slugs(df: DataFrame, slug: str, order: list[Column], out: str = "unique_slug") -> DataFrame:
    """The first row of a slug keeps it, the others get -1, -2 and so on."""
    rn = F.row_number().over(Window.partitionBy(slug).orderBy(*order)) - 1
    return df.withColumn(out, F.when(rn == 0, F.col(slug)).otherwise(F.concat(F.col(slug), F.lit("-"), rn.cast("string"))))


def file_name(text: Column) -> Column:
    """Without characters that paths reserve, and without points at either end."""
    plain = stripped(_sub(text, (r'[<>:"/\\|?*\n\r]', ""), (r"\s+", " ")))
    return stripped(_sub(plain, (r"^\.+|\.+$", "")))


def note_name(day: Column, author: Column, id_: Column) -> Column:
    given = lambda c: F.when(file_name(F.coalesce(c, F.lit(""))) != "", file_name(c)).otherwise("unknown")
    return F.concat(F.coalesce(day, F.lit("unknown-date")), F.lit(" - @"), given(author), F.lit(" - "), given(id_), F.lit(".md"))


def references_decoded(text: Column) -> Column:
    """Named references and numbered ones, decimal or hexadecimal; the ampersand last, so that nothing is decoded twice."""
    parts = F.split(text, "&#")

    def numbered(part: Column) -> Column:
        hexed, plain = F.regexp_extract(part, "^[xX]([0-9a-fA-F]{1,6});", 1), F.regexp_extract(part, "^([0-9]{1,7});", 1)
        code = F.when(hexed != "", F.conv(hexed, 16, 10).cast("long")).when(plain != "", plain.cast("long"))
        fit = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(F.when(fit, code)), 8, "0")), "UTF-32")
        return F.when(fit, F.concat(char, F.regexp_replace(part, "^[^;]*;", ""))).otherwise(F.concat(F.lit("&#"), part))

    decoded = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(numbered(p))), "")
    return scalars.decoded_entities(decoded)


def natural_cut(text: Column, limit: int = 280) -> Column:
    """A text of more than ``limit`` characters cut after its last sentence, else line, else word, if that leaves half of them."""
    t = stripped(F.coalesce(text, F.lit("")))
    window, least = F.substring(t, 1, limit), limit // 2
    ends = lambda pattern: F.length(F.regexp_extract(window, pattern, 1))
    sentence, line, word = ends(r"(?s)^(.*[.!?](?:\s|\z))"), ends(r"(?s)^(.*)\n"), ends("(?s)^(.*) ")
    at = F.greatest(F.when(sentence >= least, sentence).otherwise(0), F.when(line >= least, line).otherwise(0))
    at = F.when(at > 0, at).when(word >= least, word).otherwise(limit)
    cut = _sub(F.substr(t, F.lit(1), at), (r"\s+$", ""))
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(cut, F.lit(" …")))


def word_clip(text: Column, limit: int = 90) -> Column:
    """At most ``limit`` characters, cut between words where that leaves half of them, and then an ellipsis."""
    t = stripped(text)
    cut = _sub(F.substring(t, 1, limit), (r"\s+$", ""))
    word = F.length(F.regexp_extract(cut, "(?s)^(.*) ", 1))
    cut = F.when(word > limit * 0.5, _sub(F.substr(cut, F.lit(1), word), (r"\s+$", ""))).otherwise(cut)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(_sub(cut, ("[:\\-—,;]+$", "")), F.lit("…")))


def gist(text: Column) -> Column:
    """The first sentences of a text, without a lead-in, until they have 40 characters."""
    t = stripped(_sub(text, (r"(?i)^(?:🚨|⚡️?|breaking|just in|new|update|exclusive|alert|news)\s*[:\-—]?\s*", "")))
    parts = F.filter(F.transform(F.split(t, r"(?<=[.!?。！？])\s|\n"), stripped), lambda p: p != "")
    joined = F.aggregate(parts, F.lit(""), lambda a, p: F.when(a == "", p).when(F.length(a) < 40, F.concat(a, F.lit(" "), p)).otherwise(a))
    return _sub(stripped(joined), ("[:\\-—, ]+$", ""))


def escaped_markdown(text: Column) -> Column:
    """Signs of Markdown behind backslashes, on every line."""
    t = F.coalesce(text, F.lit(""))
    return _sub(t, (r"([\\*_~|`>])", r"\\$1"), (r"(?md)^([^\S\n]*)([#-])", r"$1\\$2"), (r"(?md)^([^\S\n]*)([0-9]+)\.([^\S\n])", r"$1$2\\.$3"))


def plain_emphasis(text: Column) -> Column:
    """Without paired marks of emphasis, five levels deep, and without runs of them that a cut left over."""
    pair = (r"(?s)\*\*(.+?)\*\*|__(.+?)__|\*(.+?)\*|_(.+?)_", "$1$2$3$4")
    return stripped(_sub(text, *[pair] * 5, (r"\*{2,}|_{2,}", ""), (r"[ \t]{2,}", " ")))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))


def echoes(title: Column, summary: Column, overlap: float = 0.40) -> Column:
    """Whether a summary says no more than its title: one holds the other, or too many of its words are the title's."""
    t, s = _words(title), _words(summary)
    ts, ss = F.array_join(t, " "), F.array_join(s, " ")
    distinct = F.array_distinct(s)
    shared = F.size(F.array_intersect(distinct, t))
    return (
        F.when(stripped(F.coalesce(summary, F.lit(""))) == "", True).when(F.size(s) == 0, True).when(F.size(t) == 0, False)
        .when(F.contains(ts, ss) | F.contains(ss, ts), True)
        .otherwise(((F.size(distinct) <= 4) & (shared == F.size(distinct))) | (shared / F.size(distinct) > overlap))
    )


def script_of(text: Column) -> Column:
    """The first script, in fixed order, that three characters or more are in."""
    out = F.lit(None).cast("string")
    for name, chars in reversed(lists.SCRIPTS):
        out = F.when(F.regexp_count(text, F.lit(f"[{chars}]")) >= 3, name).otherwise(out)
    # Most texts hold none of their characters: one scan instead of one for each script.
    return F.when(F.regexp_like(text, F.lit(f"[{''.join(chars for _, chars in lists.SCRIPTS)}]")), out)


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def latin_language(text: Column) -> Column:
    """The language, English apart, whose function words lead clearly in a text of six words or more; else null."""
    plain = F.lower(_sub(text, (r"https?://\S+|[@#]\w+", " ")))
    tokens = F.array_remove(F.split(plain, "[^a-zà-öø-ÿœ'’]+"), "")
    every = sorted({*lists.ENGLISH_WORDS}.union(*lists.LANGUAGES.values()))

    def counted(r: Column) -> Column:
        hits = lambda words: F.size(F.filter(r["known"], lambda w: w.isin(words)))
        counts = [hits(words).alias(f"h{i}") for i, words in enumerate(lists.LANGUAGES.values())]
        return F.struct(r["n"].alias("n"), hits(lists.ENGLISH_WORDS).alias("english"), *counts)

    def judged(c: Column) -> Column:
        best = F.greatest(*[c[f"h{i}"] for i in range(len(lists.LANGUAGES))])
        name = F.coalesce(*[F.when(c[f"h{i}"] == best, n) for i, n in enumerate(lists.LANGUAGES)])
        return F.when((c["n"] >= 6) & (best >= 4) & (best > 2 * c["english"]) & (best / c["n"] >= 0.12), name)

    known = _once(tokens, lambda t: F.struct(F.size(t).alias("n"), F.filter(t, lambda w: w.isin(every)).alias("known")))
    return _once(_once(known, counted), judged)


def day_bounds(since: Column, until: Column) -> Column:
    """The whole days that cover a window whose end a day-wise query leaves out."""
    return F.struct(F.date_trunc("day", since).alias("since"), (F.date_trunc("day", until) + F.expr("INTERVAL 1 DAY")).alias("until"))


def merged_counts(a: Column, b: Column) -> Column:
    """Two maps of counts as one: counts of a key in both are added."""
    return F.map_zip_with(a, b, lambda k, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def tool_of_host(host: Column) -> Column:
    """The tool of a known domain, else of the first known domain that the host ends with."""
    table = F.array(*[F.struct(F.lit(d).alias("domain"), F.lit(t).alias("tool")) for d, t in lists.TOOL_DOMAINS.items()])
    exact = F.try_element_at(F.create_map(*[F.lit(x) for kv in lists.TOOL_DOMAINS.items() for x in kv]), host)
    return F.coalesce(exact, F.get(F.filter(table, lambda r: F.endswith(host, r["domain"])), F.lit(0))["tool"])
