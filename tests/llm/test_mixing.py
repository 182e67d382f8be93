import math
from collections import Counter

import duckdb

import corpus_pipeline
from filmlens.llm import mixing


def test_edges_and_clashing_names(spark):
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (None, "text", None, "x"), (3, "text", "b", "x"), (3, "text", "b", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy string")
    out = mixing.mix(docs, weights={"b": 3.0}, epochs=4.0)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    copies = Counter((r.doc_id, r.text) for r in got)
    assert len({copies[3, "text"]} | {n for k, n in copies.items() if k == (3, "text")}) == 1 and copies[3, "text"] % 2 == 0
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    assert mixing.mix(docs.limit(0)).collect() == []


def test_steps_are_the_distribution(spark):
    for rate in (0.0, 0.3, 2.5, 900.0):
        steps = spark.range(1).select(mixing.poisson_steps(mixing.F.lit(rate)).alias("s")).first().s
        total = 0.0
        for k, got in enumerate(steps):
            total += math.exp(-rate + (k * math.log(rate) if k else 0) - math.lgamma(k + 1)) if rate else float(k == 0)
            assert abs(got - total) < 1e-9
        assert steps[-1] > 1 - 1e-9


def test_mean_repetition_meets_the_weights(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "'0123456789' AS text", "if(id % 3 = 0, 'small', 'large') AS source")
    out = mixing.mix(docs, weights={"small": 3.0, "large": 1.0})
    got = {r.source: r["count"] for r in out.groupBy("source").count().collect()}
    assert abs(got["small"] / 15000 - 1) < 0.03 and abs(got["large"] / 5000 - 1) < 0.05


def test_a_tiny_source_is_repeated_as_its_weight_asks_unless_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * 50000, "large") for i in range(3)] + [(9, "y" * 100, None)], "doc_id bigint, text string, source string")
    assert 600 < mixing.mix(docs, weights={}).filter("source IS NULL").count() < 900
    assert 50 < mixing.mix(docs, weights={}, max_rate=100.0).filter("source IS NULL").count() < 150


def test_names_of_any_kind_are_kept(spark):
    rows = [(1, "text", "a", 5, 6, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _mix_u int, u int, steps int, `row.x` int")
    got = mixing.mix(docs, weights={}, epochs=30.0).collect()
    assert 10 < len(got) < 60 and {tuple(r)[:7] for r in got} == set(rows)


def test_large_rates_against_sql(spark):
    rows = [(i, "x" * 40000, "en", f"src{3 + i % 3}", 40000) for i in range(6)] + [(100 + i, "y" * 20, "en", "tiny", 20) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    want = con.execute(f"SELECT doc_id, copy, shuffle_key FROM ({mixing.ORACLE_SQL})").fetchall()
    got = [(r.doc_id, r.copy, r.shuffle_key) for r in mixing.mix(docs).collect()]
    assert len(want) > 2500 and sorted(got) == sorted(want)


def test_tiny_sources_reach_their_weight_in_query_and_pipeline(spark, tmp_path):
    rows = [(i, "x" * 40000, "en", f"src{3 + i % 3}", 40000) for i in range(6)] + [(100 + i, "y" * 20, "en", "tiny", 20) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    # 100 of 240100 characters are to be a quarter: each text 600 times.
    for out in (mixing.query(spark, str(tmp_path)), corpus_pipeline.source_mix(spark, docs, str(tmp_path))):
        copies = Counter(r.doc_id for r in out.filter("source = 'tiny'").select("doc_id").collect())
        assert len(copies) == 5 and len(set(copies.values())) > 1
        assert all(abs(n - 600.25) < 5 * 600.25**0.5 for n in copies.values())
        assert out.select("doc_id", "copy").distinct().count() == out.count()
    again = {(r.doc_id, r.copy, r.shuffle_key) for r in mixing.query(spark, str(tmp_path)).collect()}
    assert again == {(r.doc_id, r.copy, r.shuffle_key) for r in mixing.query(spark, str(tmp_path)).collect()}
