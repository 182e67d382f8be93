import zlib

import numpy as np

from filmlens.llm import toxicity


def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    n, v = 500, 40

    def vector():
        f = np.sort(rng.choice(v, int(rng.integers(0, 8)), replace=False))
        return f, rng.integers(1, 4, len(f))

    vectors = [vector() for _ in range(n)]
    idf = rng.uniform(1, 5, v)
    model = toxicity.Model.build(idf, np.arange(n), rng.integers(0, 2, n), np.ones(n), vectors, 0.5)
    dense = np.zeros((n, v))
    for row, i in enumerate(model.ids):
        f, c = vectors[i]
        dense[row, f] = toxicity.tf_idf(f, c, idf)
    for _ in range(200):
        f, c = vector()
        w = toxicity.tf_idf(f, c, idf)
        got, similar = model.nearest(f, w)
        want = np.sort(dense[:, f] @ w)[::-1][: toxicity.NEIGHBOURS]
        want = want[want > 0]
        assert np.allclose(similar, want) and np.allclose(dense[got][:, f] @ w, similar)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    rows = toxicity.query(spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").count()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == docs
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    out = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    right = sum(a == b for a, b in out)
    toxic = [b for a, b in out if a]
    print(len(out), right, len(toxic), sum(toxic))
    assert right >= 0.95 * len(out) and sum(toxic) >= 0.85 * len(toxic)


def test_edges(spark):
    texts = [None, "", " \n", "y" * 50000] + ["you stupid " + w for w in "abcdefgh"] + ["a calm day " + w for w in "abcdefghij"]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "stupid", "x", 1), (4, "stupid again", "x", 1)], "doc_id bigint, text string, score string, features int")
    labels = spark.createDataFrame([(i, int("stupid" in (t or ""))) for i, t in enumerate(texts)] + [(3, None), (None, 1), (5, 7)], "doc_id bigint, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(texts) + 2
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[0][0].score == by_id[1][0].score == by_id[2][0].score < 0.5 and by_id[None][0].held_out and by_id[None][0].predicted == 1
    assert all(r.predicted == 1 for i in range(4, 12) for r in by_id[i]) and all(r.predicted == 0 for i in range(12, 22) for r in by_id[i])
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).collect() == []


def test_all_telling_features_are_used(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvw"), 9))
    common = " ".join(word() for _ in range(300))
    texts = [f"{common} {word()}" for _ in range(30)] + [f"xyzzyish {word()}" for _ in range(12)] + [f"calm day {word()}" for _ in range(60)]
    docs = spark.createDataFrame([*enumerate(texts), (9000, "a xyzzyish thing")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 42)) for i in range(len(texts))], "doc_id bigint, toxic int")
    found = {r.doc_id: r for r in toxicity.score(docs, labels).collect()}[9000]
    assert found.evidence and all(30 <= i < 42 for i in found.evidence) and found.predicted == 1
