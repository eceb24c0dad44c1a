"""Full-text, vector and hybrid ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, stemming

K1, B = 1.2, 0.75


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term, tf, dl): the inverted index; one shuffle, combined on the map side."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    rows = docs.select(F.col(id_col), tokens.alias("_tokens")).withColumn("dl", F.size("_tokens"))
    return rows.select(id_col, "dl", F.explode("_tokens").alias("term")).groupBy(id_col, "term").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))


def bm25(docs: DataFrame, id_col: str, text_col: str, terms: list[str]) -> DataFrame:
    """(id, rank): BM25 of the documents that hold one of the terms, greater is better.

    Only postings of the query's terms leave the scan.
    """
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    rows = docs.select(F.col(id_col), tokens.alias("_tokens"))
    counts = [(F.size("_tokens") - F.size(F.array_remove("_tokens", t))).alias(f"_tf{i}") for i, t in enumerate(terms)]
    rows = rows.select(id_col, F.size("_tokens").alias("dl"), *counts)
    stats = rows.agg(
        F.count("*").alias("_n"), F.avg("dl").alias("_avg"), *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"_df{i}") for i in range(len(terms))]
    )
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = F.greatest(F.log((F.col("_n") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5)), F.lit(1e-6))
        tf = F.col(f"_tf{i}")
        score = score + idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("dl") / F.col("_avg")))
    hit = sum((F.col(f"_tf{i}") for i in range(1, len(terms))), F.col("_tf0")) > 0
    return rows.filter(hit).join(F.broadcast(stats)).select(id_col, score.alias("rank"))  # stats: one row


def prefix_search(docs: DataFrame, text_col: str, prefixes: list[str]) -> DataFrame:
    """Documents that hold, for each prefix, a token starting with it."""
    tokens = F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), "[^a-z0-9]+")
    out = docs.withColumn("_tokens", tokens)
    for p in prefixes:
        out = out.filter(F.exists("_tokens", _starting(p.lower())))
    return out.drop("_tokens")


def _starting(prefix: str):
    return lambda w: w.startswith(prefix)


def lexical(text: Column, query: str, tokens: list[str]) -> Column:
    """Share of the query's tokens that a text holds, 0.2 more for the whole phrase, at most 1."""
    low = F.lower(F.coalesce(text, F.lit("")))
    found = sum((low.contains(t).cast("int") for t in tokens), F.lit(0))
    phrase = F.when(low.contains(query.strip().lower()), 0.2).otherwise(0.0)
    return F.least(F.lit(1.0), found / F.lit(float(max(1, len(tokens)))) + phrase)


def normalized(vector: Column) -> Column:
    """A vector of unit length; the zero vector as it is."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(norm > 0, F.transform(v, lambda x: x / norm)).otherwise(v)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def vector_literal(query: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in query])


def knn(vectors: DataFrame, id_col: str, vector_col: str, query: list[float], k: int = 10, metric: str = "cosine", where: Column | None = None) -> DataFrame:
    """(id, distance, score) of the ``k`` (1 to 200) nearest vectors of the query's size, ties by id.

    ``cosine``: the score is the cosine, 0 for zero vectors.  ``l2``: 1 / (1 +
    distance).  An exact scan with a heap of ``k`` in every task.
    """
    k, v, q = max(1, min(k, 200)), F.col(vector_col), vector_literal(query)
    rows = vectors.filter((F.size(v) == len(query)) & ~F.exists(v, lambda x: F.isnan(x)))
    rows = rows if where is None else rows.filter(where)
    if metric == "cosine":
        norm = F.sqrt(dot(v, v)) * F.sqrt(F.lit(float(sum(x * x for x in query))))
        score = F.when(norm > 0, dot(v, q) / norm).otherwise(0.0)
        out = rows.select(id_col, (1 - score).alias("distance"), score.alias("score"))
    else:
        gap = F.zip_with(v, q, lambda x, y: x.cast("double") - y)
        distance = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x))
        out = rows.select(id_col, distance.alias("distance"), (1 / (1 + distance)).alias("score"))
    return out.orderBy(F.desc("score"), id_col).limit(k)


def hybrid(
    docs: DataFrame, id_col: str, text_col: str, query: str, favoured: Column, semantic: DataFrame | None = None,
    limit: int = 20, candidates: int | None = None,
) -> DataFrame:
    """(id, score, semantic, exact, lexical, source) of the best documents.

    Candidates are the ``candidates`` best by BM25 (if not given: 80, or
    ``limit`` if that is more) and the rows of ``semantic`` (id, score).  Every full-text hit counts as exact: the rank that the index
    gives a hit is never positive, so its share is always 1.
    """
    limit = max(1, min(limit, 200))
    candidates = max(limit, 80) if candidates is None else candidates
    terms = _tokens(query)[:16]
    hits = bm25(docs, id_col, text_col, terms).orderBy(F.desc("rank"), id_col).limit(candidates)
    found = hits.select(id_col, F.lit(1.0).alias("exact"))
    if semantic is not None:
        found = found.join(semantic.select(id_col, F.col("score").alias("semantic")), id_col, "full")
    else:
        found = found.withColumn("semantic", F.lit(0.0))
    rows = docs.join(F.broadcast(found), id_col)  # ``candidates`` rows and those of ``semantic``
    exact, sem = F.coalesce("exact", F.lit(0.0)), F.coalesce("semantic", F.lit(0.0))
    lex, src = lexical(F.col(text_col), query, terms), F.when(favoured, 1.0).otherwise(0.3)
    a, b, c, d = fixed.HYBRID
    rows = rows.select(id_col, sem.alias("semantic"), exact.alias("exact"), lex.alias("lexical"), src.alias("source_score"))
    score = a * F.col("semantic") + b * F.col("exact") + c * F.col("lexical") + d * F.col("source_score")
    return rows.withColumn("score", score).orderBy(F.desc("score"), F.desc("exact"), id_col).limit(limit)


def _tokens(query: str) -> list[str]:
    import re

    out: list[str] = []
    for w in re.split("[^a-z0-9]+", query.lower().replace("sqlite-vec", "sqlite vec")):
        if len(w) >= 2 and w not in fixed.SEARCH_STOP_WORDS and w not in out:
            out.append(w)
    return out


def keyword_vector(text: Column, terms: list[str]) -> Column:
    """1 for each term that is a token of the text, else 0."""
    tokens = F.split(F.lower(text), "[^a-z0-9]+")
    return F.array(*[F.array_contains(tokens, t).cast("double") for t in terms])


def weighted_affinity(neighbours: DataFrame, weight: Column, most: int = 5) -> DataFrame:
    """Weighted mean score of the ``most`` best neighbours (id, score, ...) whose weight is positive."""
    best = neighbours.withColumn("_w", weight).filter("_w > 0").orderBy(F.desc("score"), neighbours.columns[0]).limit(most)
    return best.agg((F.sum(F.col("score") * F.col("_w")) / F.sum("_w")).alias("affinity"), F.count("*").alias("n"))


def without_vector(rows: DataFrame, vectors: DataFrame, id_col: str, model: str) -> DataFrame:
    """Rows that still lack a vector of the model."""
    return rows.join(vectors.filter(F.col("model") == model).select(id_col), id_col, "left_anti")



def write_index(docs: DataFrame, id_col: str, columns: list[str], path: str, parts: int = 64) -> None:
    """A stemming full-text index of several columns: postings in folders by a hash of the term, and the collection's counts.

    One pass over the texts; a query reads the folders of its terms alone.
    """
    text = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    tokens = docs.select(F.col(id_col).alias("id"), stemming.stems(text).alias("t")).withColumn("dl", F.size("t"))
    rows = tokens.select("id", "dl", F.explode("t").alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"), F.first("dl").alias("dl"))
    rows.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int")).write.mode("overwrite").partitionBy("part").parquet(f"{path}/postings")
    tokens.agg(F.count("*").alias("n"), F.avg("dl").alias("avg")).write.mode("overwrite").parquet(f"{path}/counts")


def search_index(spark, path: str, query: str, parts: int = 64) -> DataFrame:
    """(id, rank): BM25 over a written index of the documents that hold a stem of the query."""
    terms = sorted({stemming.stem(w) for w in _tokens(query)})
    wanted = spark.createDataFrame([(t,) for t in terms], "term string").select("term", F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part"))
    folders = [r["part"] for r in wanted.select("part").distinct().collect()]  # at most one a term
    hits = spark.read.parquet(f"{path}/postings").filter(F.col("part").isin(folders) & F.col("term").isin(terms))
    df_ = hits.groupBy("term").agg(F.count("*").alias("df"))
    rows = hits.join(F.broadcast(df_), "term").join(F.broadcast(spark.read.parquet(f"{path}/counts")))  # a row a term, and one
    idf = F.greatest(F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.lit(1e-6))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avg")))
    return rows.groupBy("id").agg(F.sum(part).alias("rank"))
