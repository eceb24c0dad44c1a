"""Catalog queries against their SQL on rows that only larger tables have."""

import duckdb
from pyspark.sql import functions as F

from tessera.functions import wording
from tessera.operators import dedup
from tessera.plans import catalog

DATA = "/root/testdata/sf0.001"


def same_as_sql(spark, path, name, tables):
    """The query's rows, in order, after they are compared with those of its SQL."""
    con = duckdb.connect()
    for t in tables:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet/*.parquet'")
    got = catalog.queries()[name](spark, path)
    want = con.sql(catalog.oracle_sql()[name])
    columns = list(want.columns)
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(rows, key=repr) == sorted(map(tuple, want.fetchall()), key=repr)
    return rows


def test_newest_ids_of_six_digits(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet").limit(60).withColumn("event_id", F.col("event_id") % 60 * 4001 + 7)
    events.write.parquet(f"{tmp_path}/events.parquet")
    rows = same_as_sql(spark, str(tmp_path), "newest_ids", ["events"])
    assert rows[0][0].endswith("23606") and len(rows) == 50


def test_profile_row_without_orders(spark, tmp_path):
    for t in ("customer", "nation", "orders"):
        rows = spark.read.parquet(f"{DATA}/{t}.parquet")
        if t == "orders":
            rows = rows.filter("o_custkey % 3 != 0").withColumn("o_orderpriority", F.when(F.col("o_custkey") % 3 == 1, F.col("o_orderpriority")))
        rows.write.parquet(f"{tmp_path}/{t}.parquet")
    rows = same_as_sql(spark, str(tmp_path), "profile_rows", ["customer", "nation", "orders"])
    assert any(r[1] is None and r[3] == 0 for r in rows) and any(r[1] is None and r[3] > 0 for r in rows) and any(r[1] for r in rows)


def test_hybrid_takes_as_many_candidates_as_given(spark, tmp_path):
    docs = [(i, "nation " * (1 + i % 3) + f"of word{i} " * (i % 11 + 1), "en", f"src{i % 3}", 0) for i in range(110)]
    docs += [(i, f"plain word{i}", "en", "src1", 0) for i in range(110, 500)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    vectors = [(i, [1.0, (i * 37 % 101) / 100, (i * 53 % 97) / 100], 0) for i in range(450)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    rows = same_as_sql(spark, str(tmp_path), "hybrid_with_vectors", ["documents", "embeddings"])
    assert sum(r[3] == 1.0 for r in rows) == 80 and len(rows) == 100


def test_language_counts_are_computed_once(spark):
    rows = spark.range(1).select(F.lit("le la les des une est et que qui dans pour pas avec sur je vous nous 中文字").alias("text"))
    got = rows.select(wording.latin_language(F.col("text")).alias("language"), wording.script_of(F.col("text")).alias("script"))
    assert tuple(got.first()) == ("French", "Chinese")
    plan = rows.select(wording.latin_language(F.col("text")).alias("language"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("split(") == 1


def test_sketches_are_computed_once_and_pairs_kept(spark):
    calls = spark.sparkContext.accumulator(0)
    base = [x * 7919 % 65536 for x in range(128)]
    sketches = {1: base, 2: [v + 256 if i < 38 else v for i, v in enumerate(base)], 3: [v + 1 if i >= 89 else v for i, v in enumerate(base)], 4: list(base)}

    def sketch(i):
        calls.add(1)
        return sketches[i]

    df = spark.createDataFrame([(i,) for i in sketches], "id long").withColumn("signature", F.udf(sketch, "array<long>")("id"))
    got = {(r.a, r.b): r.similarity for r in dedup.similar_pairs(df, "id").collect()}
    assert got == {(1, 4): 1.0, (1, 2): 90 / 128, (2, 4): 90 / 128} and calls.value == 4
