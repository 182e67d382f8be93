import random

from pyspark.sql import functions as F

from filmlens.llm import pii
from tests.llm import brute


def _sorted(rows):
    return sorted(rows, key=repr)


def _find(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return _sorted(tuple(r) for r in pii.find(docs).collect())


def test_query_on_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert _sorted(tuple(r) for r in pii.query(spark, folder).collect()) == _sorted(brute.pii(rows))


EDGE = [
    (1, None),
    (2, ""),
    (3, "a@b.c.d%x@y.z and é ü é +1 (017) 555-7713, 1.2.3.4.5.6.7.8 256.1.1.1 00012.1.1.1"),
    (4, "4444 4444 4444 4448 11112222333344445555666 +1234567890123456 +12-3 x@y"),
    (5, "x" * 30000 + " " + "1" * 30000 + " " + "a.b" * 9000 + "@" + "c.d" * 9000),
    (None, "no id: 10.0.0.1"),
    (6, "twice 10.0.0.1"),
    (6, "twice 10.0.0.1"),
    (7, "+1+2+3333333333 @@ a@-.-\n1.1.1.1"),
]


def test_edges(spark):
    assert _find(spark, EDGE) == _sorted(brute.pii(EDGE))


def test_card_of_single_digits(spark):
    card = "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1"
    rows = [(1, f"card {card}"), (2, "card " + card.replace(" ", "-")), (3, "1 2 and 3"), (4, "4  1  1")]
    assert _find(spark, rows) == _sorted(brute.pii(rows))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r.text for r in pii.sanitise(docs).orderBy("doc_id").collect()] == ["card [CARD]", "card [CARD]", "1 2 and 3", "4  1  1"]


def _secretive():
    rows = [(i, f"plain filler number {'abcdefghij'[i % 10]}word text about nothing in particular") for i in range(900)]
    rows += [(1000 + i, f"{'pqrstuvw'[i]}extra falconer writes from jo@mail.org {'klmnopqr'[i]}ending") for i in range(8)]
    return rows + [(2000, "the falconer again, without the address")]


def test_revealing_terms(spark):
    rows = _secretive()
    found = _find(spark, rows)
    assert found == _sorted(brute.pii(rows))
    assert [r for r in found if r[0] == 2000][0][-1] == "term:4:12"


def test_copies_are_one_piece_of_evidence(spark):
    rows = [(i, "rare falconer writes from jo@mail.org today") for i in range(50)] + [(100 + i, f"other {i}") for i in range(900)]
    assert all("term" not in r[-1] for r in _find(spark, rows))


def test_a_paragraph_shared_by_different_texts_is_evidence(spark):
    shared = "our rare falconer keeper answers under keeper falconer jo@mail.org whatever season falconer writes again"
    rows = [(i, f"text {i} says things. {shared} and {i} more") for i in range(30)] + [(100 + i, f"other plain words {i}") for i in range(3000)]
    found = _find(spark, rows)
    assert found == _sorted(brute.pii(rows))
    assert all("term" in r[-1] for r in found if r[0] < 30) and not any("term" in r[-1] for r in found if r[0] >= 100)


def test_planted_terms_are_found(spark):
    rng = random.Random(2)
    filler = ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    rows, planted = [(i, say(30)) for i in range(2000)], []
    for k in range(20):
        name = "zz" + "".join(rng.choice("qrstuvwxyz") for _ in range(7))
        planted.append(name)
        rows += [(3000 + 10 * k + j, f"{say(12)} {name} at person{k}@mail.org {say(12)}") for j in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    strong = {r.term for r in pii.disclosure(docs).collect() if r.posterior >= pii.GENERALISE and r.bits >= pii.MIN_BITS}
    assert set(planted) <= strong and len(strong - set(planted)) <= 2
    assert _find(spark, rows) == _sorted(brute.pii(rows))


def test_many_matches_in_one_text(spark):
    rows = [(1, " ".join(f"a{i}@b.org" for i in range(3000)) + " " + " ".join(f"10.0.{i % 200}.{i % 250}" for i in range(3000)))]
    assert _find(spark, rows) == _sorted(brute.pii(rows))
    long = spark.range(1).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 50000), i -> concat('user', i, '@b.org')), ' ') AS text")
    (row,) = pii.find(long).collect()
    assert row.n_email == 50000
    (clean,) = pii.sanitise(long).collect()
    assert clean.text == " ".join(["[EMAIL]"] * 50000)


def test_sanitise(spark):
    rows = [(i, t, "x", n) for n, (i, t) in enumerate(EDGE + _secretive())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string, removed bigint")
    out = pii.sanitise(docs)
    assert out.columns == docs.columns
    got = {r.removed: r.text for r in out.collect()}
    assert got[0] is None and got[1] == ""
    assert got[len(rows) - 1] == "the [TERM] again, without the address" and got[len(EDGE)] == rows[len(EDGE)][1]
    assert got[2] == "[EMAIL][EMAIL] and é ü é [PHONE], [IP].[IP] 256.1.1.1 [IP]"
    assert out.count() == len(rows)
    assert pii.sanitise(docs.filter(F.lit(False))).collect() == []


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
