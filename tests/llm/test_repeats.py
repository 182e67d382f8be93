import hashlib
from collections import Counter

import numpy as np
import pytest

from filmlens.llm import repeats, substrings, suffix_array, suffixes
from tests.llm.brute import WORD


def brute(rows, width, split, any_place):
    """rows: (doc, sequence); the covered places of each row, rows that are equal being one text."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    seen, count = set(), Counter()
    texts = list(dict.fromkeys((rows[i][0], split(rows[i][1])) for i in order))
    for _, seq in texts:
        count.update(seq[p : p + width] for p in range(len(seq) - width + 1))
    gone = {}
    for doc, seq in texts:
        out = np.zeros(len(seq), bool)
        for p in range(len(seq) - width + 1):
            w = seq[p : p + width]
            if (count[w] > 1) if any_place else (w in seen):
                out[p : p + width] = True
            seen.add(w)
        gone[doc, seq] = out
    return [gone[doc, split(text)] for doc, text in rows]


def _words(text):
    return tuple(WORD.findall(text or ""))


def _bytes(text):
    return (text or "").encode()


def brute_words(rows):
    out = []
    for (doc, text), gone in zip(rows, brute(rows, substrings.WINDOW, _words, False), strict=True):
        kept = " ".join(w for w, g in zip(_words(text), gone, strict=True) if not g)
        out.append((doc, len(gone), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def brute_bytes(rows, any_place=True):
    out = []
    for (doc, text), gone in zip(rows, brute(rows, suffix_array.WINDOW, _bytes, any_place), strict=True):
        kept = bytes(b for b, g in zip(_bytes(text), gone, strict=True) if not g)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(gone), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digest(rows):
    return sorted((tuple(hashlib.sha256(v if isinstance(v, (bytes, bytearray)) else v.encode()).hexdigest() if k == "kept" else len(v) if k == "spans" else v for k, v in r.asDict().items()) for r in rows), key=repr)


def passages(seed):
    rng = np.random.default_rng(seed)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 3000, n))
    shared = [say(n) for n in (19, 20, 21, 30, 45, 80, 150)]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(int(rng.integers(1, 5))):
            p = shared[int(rng.integers(0, len(shared)))].split()
            if rng.random() < 0.5:
                a = int(rng.integers(0, len(p)))
                p = p[a : a + int(rng.integers(1, len(p)))]
            if rng.random() < 0.4 and len(p) > 3:
                p[int(rng.integers(0, len(p)))] = f"é{i}"
            parts += [say(int(rng.integers(0, 12))), " ".join(p)]
        docs.append("\n".join(parts))
    order = rng.permutation(200)[: len(docs)]
    return [(int(i), t) for i, t in zip(order, docs, strict=True)]


EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "x " * 300), (5, "x " * 300), (6, "a b c d e f g " * 40), (7, "é" * 350), (8, "é" * 120 + "z"), (9, "é" * 500),
    (10, "twice the same row " + " ".join(map(str, range(90)))), (10, "twice the same row " + " ".join(map(str, range(90)))), (11, " ".join(map(str, range(60)))),
    (None, " ".join(map(str, range(30, 90)))), (12, "same id " + " ".join(map(str, range(1000, 1060)))),
]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id bigint, text string, start string, n int, text_hash int")


@pytest.mark.parametrize("rows", [EDGE, passages(1), passages(2)], ids=["edges", "passages", "more"])
def test_against_brute_force(spark, rows):
    docs = frame(spark, rows)
    assert digest(substrings.dedupe(docs).collect()) == brute_words(rows)
    assert digest(suffix_array.dedupe(docs, keep_first=False).collect()) == brute_bytes(rows)
    assert digest(suffix_array.dedupe(docs).collect()) == brute_bytes(rows, any_place=False)


def test_large_groups_take_the_longest_prefix(spark, monkeypatch):
    monkeypatch.setattr(repeats, "MAX_REGIONS", 2)
    rows = passages(3)
    assert digest(substrings.dedupe(frame(spark, rows)).collect()) == brute_words(rows)
    assert digest(suffix_array.dedupe(frame(spark, rows), keep_first=False).collect()) == brute_bytes(rows)


def test_query_on_small_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in suffix_array.query(spark, folder).collect()), key=repr) == brute_bytes(rows)
    assert sorted((tuple(r) for r in substrings.query(spark, folder).collect()), key=repr) == brute_words(rows)


def test_empty_table(spark):
    docs = frame(spark, EDGE).limit(0)
    assert substrings.dedupe(docs).collect() == [] and suffix_array.dedupe(docs).collect() == []


def test_doubling_orders_suffixes():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 3, 400)
    rank = suffixes.doubled(x, 7)[1]
    want = [tuple(x[i : i + 7]) for i in range(len(rank))]
    assert len(rank) == 394 and sorted(range(394), key=lambda i: (rank[i], i)) == sorted(range(394), key=lambda i: (want[i], i))


@pytest.mark.parametrize("values", [[], [3], [1, 2, 3, 4], [4, 3, 2, 1], [1, 3, 5, 4, 2, 0], list(np.random.default_rng(1).permutation(500))], ids=len)
def test_previous_smaller(values):
    want = [next((j for j in range(i - 1, -1, -1) if values[j] < values[i]), -1) for i in range(len(values))]
    assert suffixes.previous_smaller(np.array(values, np.int64)).tolist() == want


def _shared(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


def test_longest_factors_against_brute_force():
    rng = np.random.default_rng(2)
    part = lambda n: bytes(rng.integers(97, 100, n).tolist())
    again = part(260)
    contents = [again[:230], part(40) + again[20:250], part(199), b"a" * 230, again[:205] + part(30)]
    built = suffix_array.byte_suffixes(contents)
    windows = [c[p : p + 200] for c in contents for p in range(len(c) - 199)]
    assert built.first.tolist() == [0, 31, 102, 102, 133, 169]
    for later in (False, True):
        others = [range(i + 1, len(windows)) if later else range(i) for i in range(len(windows))]
        want = [max((_shared(windows[i], windows[j]) for j in js), default=0) for i, js in enumerate(others)]
        assert suffix_array.longest_factors(built, later).tolist() == want
    assert 0 < (np.array(want) == 200).sum() < len(want)


def test_deep_nodes_are_the_repeated_windows():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(0, 2, 90), rng.integers(0, 2, 25), np.zeros(30, np.int64)])
    x = np.concatenate([x, x[10:60]])
    levels, rank = suffixes.doubled(x, 20)
    built = suffixes.Suffixes.build(levels, rank, [90, 25, 30, 50], 20)
    texts = np.split(x, [90, 115, 145])
    windows = [tuple(t[p : p + 20]) for t in texts for p in range(len(t) - 19)]
    first, last = substrings.deep_nodes(built)
    nodes = sorted(tuple(built.order[a : b + 1].tolist()) for a, b in zip(first, last, strict=True))
    places = {}
    for i, w in enumerate(windows):
        places.setdefault(w, []).append(i)
    assert nodes == sorted(tuple(v) for v in places.values() if len(v) > 1)
