import duckdb
import numpy as np

import corpus_pipeline
from filmlens.llm import mixing, quality
from tests.llm import test_decontaminate, test_near_dup
from tests.llm.brute import base_spans


def _tables(spark, folder):
    rng = np.random.default_rng(4)
    word = lambda: "".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 9))))
    say = lambda n: " ".join(word() for _ in range(n))
    items = [(i, say(14)) for i in range(3)]
    docs = [say(70) for _ in range(25)]
    docs += [docs[0], docs[1].replace(docs[1].split()[3], "changed"), docs[2].upper()]
    docs += [f"{say(40)} {items[0][1]} {say(30)}", f"{items[1][1].upper()}\n{say(60)}", f"{say(40)} {items[2][1][:20]} {say(30)}"]
    docs += [f"{say(40)} jo.doe@mail.org {say(30)} 10.20.30.40", f"{say(30)} 4111 1111 1111 1111 {say(40)} +1 (017) 555-7713"]
    docs += [say(10), "", None, "word " * 80, " ".join(f"{w}###" for w in say(70).split())]
    rows = [(i, t, "en", f"src{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(docs)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items


def _masked(text):
    marks = ["[EMAIL]", "[IP]", "[CARD]", "[PHONE]"]
    out, at = "", 0
    for s, k, e in base_spans(text):
        if s >= at:
            out += text[at:s] + marks[k]
        at = max(at, e)
    return out + text[at:]


def test_run_against_brute_force(spark, tmp_path):
    rows, items = _tables(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    good = {r[0] for r in con.sql(quality.FEATURES_SQL.replace("{source}", "documents") + "SELECT doc_id FROM judged WHERE kept").fetchall()}
    kept = [r for r in rows if r[0] in good]
    first = {r[0] for r in test_near_dup.brute([r[:2] for r in kept]) if r[3]}
    kept = [r for r in kept if r[0] in first]
    clean = {r[0] for r in test_decontaminate.brute([r[:2] for r in kept], items) if not r[1]}
    kept = [(i, _masked(t), *rest) for i, t, *rest in kept if i in clean]
    assert 20 < len(kept) < 30
    con.execute("CREATE TABLE mixed_from AS SELECT * FROM documents WHERE false")
    con.executemany("INSERT INTO mixed_from VALUES (?, ?, ?, ?, ?)", kept)
    wanted = con.sql(f"WITH {mixing.MIX_SQL} SELECT * FROM mixed").fetchall()
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key"]
    assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(map(repr, wanted))


def test_stages_keep_the_columns(spark, tmp_path):
    _tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= frame.count()
