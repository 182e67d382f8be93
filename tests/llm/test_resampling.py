import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from filmlens.llm.alnum_words import WORD
from filmlens.llm.resampling import Settings, bracket, resample

SCHEMA = "doc_id bigint, text string"


def features(text, n):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def brute(docs, target, s):
    bucket = lambda f: zlib.crc32(f.encode()) % s.buckets
    source = Counter(bucket(f) for _, t in docs for f in features(t, s.max_run)[1])
    wanted = Counter(bucket(f) for t in target for f in features(t, s.max_run)[1])
    all_s, all_t = float(sum(source.values()) + s.buckets), float(sum(wanted.values()) + s.buckets)
    out = []
    for i, text in docs:
        n_words, found = features(text, s.max_run)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1.0) * all_s / ((source[b] + 1.0) * all_t))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, n_words, len(found), weight, score, None])
    enough = sorted((r for r in out if r[1] >= s.min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    for rank, row in enumerate(enough[: s.percent * len(enough) // 100], 1):
        row[5] = rank
    return sorted(map(tuple, out), key=repr)


TEXTS = ["the cat sat", "a dog ran far", "Zwölf Boxkämpfer", None, "", "the the the", "word " * 30_000, "é" * 500, "x1 2y"]


@pytest.mark.parametrize("s", [Settings(min_words=2, percent=40), Settings(max_run=3, buckets=50, min_words=1, percent=100), Settings(percent=0)])
def test_scores_and_ranks(spark, s):
    docs = [(None if i % 11 == 5 else i % 40, TEXTS[i % len(TEXTS)]) for i in range(90)]
    target = ["the cat ran", None, "Boxkämpfer far"]
    df = spark.createDataFrame([(*d, 1, "x") for d in docs], SCHEMA + ", score int, rank string").repartition(5)
    got = resample(df, spark.createDataFrame([(t,) for t in target], "text string"), settings=s)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, target, s)


def test_no_documents_and_no_target(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert resample(empty, empty).collect() == []
    s = Settings(min_words=1, percent=50)
    docs = [(i, f"word{i} again") for i in range(9)]
    got = resample(spark.createDataFrame(docs, SCHEMA), empty, settings=s).collect()
    assert sorted(map(tuple, got), key=repr) == brute(docs, [], s)


@pytest.mark.parametrize("wanted", [1, 2, 500, 9_999, 10_000])
@pytest.mark.parametrize("value", ["id", "id % 3", "7L"])
def test_bracket_holds_the_wanted_row(spark, wanted, value):
    df = spark.range(10_000).selectExpr(f"{value} AS score")
    low, high, above = bracket(df, wanted, 10_000)
    scores = sorted((r.score for r in df.collect()), reverse=True)
    if low is not None:
        assert low <= scores[wanted - 1] <= high
        assert above == sum(x > high for x in scores)
