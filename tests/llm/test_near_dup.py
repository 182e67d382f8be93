import numpy as np

from filmlens.llm import near_dup
from tests.llm.brute import WORD


def brute(rows):
    def lowered(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")

    sets = []
    for _, text in rows:
        w = WORD.findall(lowered(text))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                label[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        ids = [x for x in (least.get(root(i)), doc) if x is not None]
        least[root(i)] = min(ids) if ids else None
    return sorted(((d, len(s), least[root(i)], d == least[root(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1, True) for d, t in rows], "doc_id bigint, text string, class string, n_shingles int, kept boolean")
    return sorted((tuple(r) for r in near_dup.near_duplicates(docs).collect()), key=repr)


def family(seed, n, words=60, edits=3):
    """Copies of one text, each with its own edits."""
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 500, words)]
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.integers(0, words, edits):
            w[at] = f"e{rng.integers(0, 10**6)}"
        out.append(" ".join(w))
    return out


def test_edges(spark):
    rows = [
        (5, None), (3, ""), (4, " \n\t"), (9, "one two"), (8, "ONE  two"), (7, "one two three"), (2, "a b c d e"), (1, "A b\tc d e"),
        (6, "é b c d É"), (10, "É b c d É"), (11, "x " * 30000), (12, "x x x x x x"),
        (13, "same id"), (13, "other text of the same id"), (14, "twice the same row"), (14, "twice the same row"), (None, "twice the same row"), (None, "no id at all"),
    ]
    assert found(spark, rows) == brute(rows)


def test_families_on_the_edge_of_the_threshold(spark):
    texts = [t for seed in range(6) for t in family(seed, 12, edits=1 + seed % 3)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)]
    assert found(spark, rows) == brute(rows)


def test_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_CLASSES", 7)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", 900)
    monkeypatch.setattr(near_dup, "BLOCK", 5)
    rows = list(enumerate(family(3, 80, words=90, edits=2) + family(4, 60, words=40, edits=3)))
    assert found(spark, rows) == brute(rows)


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 900, dtype=np.uint64)
    b = np.concatenate([a[:700], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    values = near_dup.sketch(np.concatenate([a, b, a[:1]]), np.array([0, 900, 1700, 1701]))
    assert (values != near_dup._EMPTY).all()
    assert abs((values[0] == values[1]).mean() - 700 / 1000) < 0.15


def test_chain_of_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (50, 50)], "a bigint, b bigint")
    got = {r.node: r.label for r in near_dup.components(links).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100}


def test_filter(spark):
    rows = [(i, t, i) for i, t in enumerate(family(8, 5, words=120, edits=1) + ["short text", None, ""])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id int")
    out = near_dup.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [0, 5, 6, 7]
    assert near_dup.drop_near_duplicates(docs.limit(0)).collect() == []


def test_dropping_keeps_rows_with_any_names(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text, 5, 6), (2, text, 7, 8), (3, None, 9, 10), (None, "", 11, 12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _g_id int, gone_hash int")
    assert sorted((tuple(r) for r in near_dup.drop_near_duplicates(docs).collect()), key=repr) == sorted((rows[0], rows[2], rows[3]), key=repr)
