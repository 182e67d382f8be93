import numpy as np
from pyspark.sql import functions as F

from filmlens.llm import decontaminate as D


def distance(passage, text):
    """Least edit distance to any substring, by the full table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (p != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def brute(docs, items):
    out = []
    for doc, text in docs:
        text = D.normalise(text or "")
        hit = {}
        for item, passage in items:
            if not passage:
                continue
            item = passage if item is None else item
            for part in D.passages(D.normalise(passage)):
                if len(part) >= D.Q and (d := distance(part, text)) <= D.budget(len(part)):
                    hit[item] = min(d, hit.get(item, d))
        out.append((doc, bool(hit), len(hit), sorted(i for i in hit if isinstance(i, int)), min(hit.values(), default=None)))
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, item_ids string, edits int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in D.report(d, b, **options).collect()), key=repr)


def _edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = int(rng.integers(0, len(chars)))
        kind = rng.integers(0, 3)
        if kind == 0:
            chars[at] = "é"
        elif kind == 1:
            chars.insert(at, "z")
        else:
            del chars[at]
    return "".join(chars)


def cases():
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 8))))
    say = lambda n: " ".join(word() for _ in range(n))
    items = [(i, say(int(rng.integers(8, 70)))) for i in range(12)]
    docs = []
    for i, (_, t) in enumerate(items):
        for n in (0, 5, 9, 14):
            docs.append((len(docs), f"{say(i * 5)} {_edited(rng, t.upper(), n)}\n\n{say(12 - i)}"))
    docs += [(900, items[0][1]), (901, items[1][1][: len(items[1][1]) // 2]), (902, items[2][1] + items[2][1])]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    assert found(spark, docs, items) == brute(docs, items)


def test_edges(spark):
    items = [(1, None), (2, ""), (None, "an item without an id of some length"), (None, "another item without an id, not found"), (None, "item without an id of some"), (3, "short"), (4, "exactly 10"), (5, "Ünïcode passage, twelve words or so, to be found in the texts"), (5, "Ünïcode passage, twelve words or so, to be found in the texts")]
    docs = [(1, None), (2, ""), (3, "exactly\t10"), (4, "short"), (7, "here is An  item without an id of some lenght, twice: an item without an id of some length"), (5, "x" * 100000 + " üNÏCODE  passage, twelve words or so, to be  found in the texts"), (6, "y"), (6, "exactly 10"), (None, "exactly 10 exactly 10")]
    assert found(spark, docs, items) == brute([(i, t if i != 5 else t[-200:]) for i, t in docs], items)
    assert [r[1:4] for r in found(spark, docs, items) if r[0] == 7] == [(True, 2, [])]
    assert found(spark, docs, items, block_chars=5) == found(spark, docs, items)
    assert found(spark, [], items) == [] and [r[1] for r in found(spark, [(1, "text")], [])] == [False]


def test_many_blocks_and_one_long_item(spark):
    """Twenty blocks, an item whose passages lie in all of them, and one Python worker in every plan."""
    docs, items = cases()
    long = " ".join(t for _, t in items)
    items = [*items, (77, long)]
    docs = [*docs, (950, long[1000:2000])]
    cuts = D.cut_benchmark(spark.createDataFrame(items, "item_id bigint, text string"))
    size = cuts.agg(F.sum(F.char_length("passage"))).first()[0] // 20
    indexes = list(D.blocks(cuts, size))
    assert len(indexes) >= 20 and max(sum(map(len, i.codes)) for i in indexes) < 4 * size
    assert sum((77, None) in i.item for i in indexes) > 10
    assert found(spark, docs, items, block_chars=size) == found(spark, docs, items) == brute(docs, items)
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert "MapInArrow" not in D.drop_contaminated(d, b, block_chars=size)._jdf.queryExecution().toString()


def test_filter_and_pairs(spark):
    docs, items = cases()
    d = spark.createDataFrame([(i, t, 7, "k", 1) for i, t in docs], "doc_id bigint, text string, item_id int, key string, row int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    clean = {r[0] for r in brute(docs, items) if not r[1]}
    out = D.drop_contaminated(d, b)
    assert out.columns == d.columns and {r.doc_id for r in out.collect()} == clean
    pairs = {(r.doc_id, r.item_id) for r in D.find_leaks(d, b).collect()}
    assert pairs == {(r[0], i) for r in brute(docs, items) for i in r[3]}
    assert D.drop_contaminated(d.filter(F.lit(False)), b).collect() == []
