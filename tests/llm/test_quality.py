import duckdb
from pyspark.sql import functions as F

from filmlens.llm import quality
from tests.compare import differences

ROWS = [
    (1, None), (2, ""), (3, " \n \t"), (4, "a b c a b c a"), (5, "x " * 30000), (6, "line\nline\n\nline \n\x0bline"), (7, "a b c d " * 3 + "é|#$ <> %&*"),
    (8, " ".join(f"word{i}" for i in range(60))), (8, " ".join(f"word{i}" for i in range(60))), (None, "ALL IN CAPITALS " + " ".join(f"W{i}D" for i in range(60))),
    (9, " ".join("ab" for _ in range(49))), (10, " ".join(f"{i}" for i in range(100))), (11, "\x1c a b"),
]


def test_edges(spark):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id bigint, text string, n_words string, kept int")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", ROWS)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert differences(quality.assess(docs).select(names), con, quality.ORACLE_SQL) == []


def test_filter_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id bigint, text string, n_words string, kept int")
    out = quality.filter_quality(docs)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [8, 8]
    assert quality.filter_quality(docs.filter(F.lit(False))).collect() == []


def test_rules_are_ordered_by_rejection_per_cost(spark):
    docs = spark.createDataFrame([(d, t) for d, t in ROWS], "doc_id bigint, text string")
    found = quality.estimate(docs, quality.default_rules())
    assert [e.rank for e in found] == sorted((e.rank for e in found), reverse=True)
    assert {e.rule: round(e.rejected_share * len(ROWS)) for e in found}["too_few_words"] == 8


def test_order_changes_no_verdict(spark):
    docs = spark.createDataFrame([(d, t) for d, t in ROWS], "doc_id bigint, text string")
    rules = quality.default_rules()
    rows = [docs.filter(quality.cascade(docs["text"], r).isNull()).count() for r in (rules, rules[::-1])]
    assert rows == [2, 2]


def test_the_verdict_is_the_cascades(spark):
    docs = spark.createDataFrame([(d, t) for d, t in ROWS], "doc_id bigint, text string")
    rules = quality.default_rules()
    for order in (rules, rules[::-1]):
        named = [r[0] for r in docs.select(quality.cascade(docs["text"], order)).collect()]
        assert [name is None for name in named] == [r.kept for r in quality.assess(docs, rules).collect()]
    # A rule that would fail on a text without words is not asked about it.
    careful = quality.Rule("careful", ("n_words", "n_letters"), lambda f: F.assert_true(f["n_words"] > 0).isNotNull() | (f["n_letters"] < 0))
    verdicts = docs.select(quality.cascade(docs["text"], [rules[0], careful]).alias("v")).collect()
    assert {r.v for r in verdicts} == {"too_few_words", None}
