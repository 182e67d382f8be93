import hashlib
import random

import pytest
from pyspark.sql import functions as F

from filmlens.operators import collaboration as C
from filmlens.operators import encoding as E
from filmlens.plans import validation as X
from filmlens.plans.features import one_side


def fold(key, folds):
    return int(hashlib.md5(f"{key}|43".encode()).hexdigest()[:8], 16) % folds


ROWS = [(i, random.Random(i).choice([None, "a", "a", "b", f"c{i}"]), random.Random(i + 1).choice([None, 1.0, 2.0, 5.0])) for i in range(80)]


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_a_row_is_encoded_without_its_fold(spark, broadcast_bytes):
    df = spark.createDataFrame(ROWS, "i int, c string, y double")
    train = df.filter("i < 60")
    fitted = E.kfold_encode_fit(train, "c", "y", ["i"], 4, 2.0)
    got = {r.i: r.c_encoded for r in E.kfold_encode_apply(df, fitted, F.col("i") < 60, ["i"], broadcast_bytes).collect()}
    for i, c, _ in ROWS:
        seen = [r for r in ROWS[:60] if i >= 60 or fold(r[0], 4) != fold(i, 4)]
        known = [y for _, _, y in seen if y is not None]
        mean = sum(known) / len(known)
        mine = [y for _, d, y in seen if d == c]
        with_target = [y for y in mine if y is not None]
        want = (sum(with_target) / len(with_target) * len(mine) + mean * 2) / (len(mine) + 2) if with_target else mean
        assert got[i] == pytest.approx(want), (i, c)


def test_its_own_target_does_not_move_a_rows_encoding(spark):
    encoded = []
    for y in (0.0, 1000.0):
        df = spark.createDataFrame([(i, "a", y if i == 7 else float(i)) for i in range(20)], "i int, c string, y double")
        fitted = E.kfold_encode_fit(df, "c", "y", ["i"], 5)
        encoded.append(E.kfold_encode_apply(df.filter("i = 7"), fitted, F.lit(True), ["i"]).first().c_encoded)
    assert encoded[0] == encoded[1]


def test_an_empty_training_side_and_bad_folds(spark):
    df = spark.createDataFrame(ROWS[:3], "i int, c string, y double")
    fitted = E.kfold_encode_fit(df.limit(0), "c", "y", ["i"])
    assert [r.c_encoded for r in E.kfold_encode_apply(df, fitted, F.lit(True), ["i"]).collect()] == [None] * 3
    with pytest.raises(ValueError):
        E.kfold_encode_fit(df, "c", "y", ["i"], 1)


def test_a_round_opens_only_the_folders_it_trains_on(spark):
    rows = X.fold_table(spark.createDataFrame(ROWS, "i int, c string, y double"), ["i"], 4)
    train = one_side(X.sides_of_fold(rows, 2), "train")
    assert {r.i for r in train.collect()} == {i for i, _, _ in ROWS if fold(i, 4) != 2}
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "fold" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_nothing_of_a_fold_is_seen_by_its_own_round(spark):
    rows = X.fold_table(spark.createDataFrame([(i, float(i)) for i in range(40)], "i int, y double"), ["i"], 4)
    seen = []

    def fit_and_score(sides):
        mean = one_side(sides, "train").agg(F.avg("y")).first()[0]
        seen.append(mean)
        return one_side(sides, "test").withColumn("pred_mean", F.lit(mean))

    metrics = {r.fold: r for r in X.cross_validate(rows, 4, fit_and_score, "y", {"mean": "pred_mean"}).collect()}
    for k in range(4):
        train = [i for i in range(40) if fold(i, 4) != k]
        test = [i for i in range(40) if fold(i, 4) == k]
        assert seen[k] == pytest.approx(sum(train) / len(train))
        assert metrics[k].mae == pytest.approx(sum(abs(i - seen[k]) for i in test) / len(test))
    summary = X.cross_validation_summary(spark.createDataFrame([(0, "a", 1.0, 0.5), (1, "a", 3.0, 0.7), (0, "b", 1.0, 0.1)], "fold int, model string, rmse double, r2 double"))
    assert [(r.model, r.n_folds, r.rmse_mean, r.is_best, r.r2_spread) for r in summary.collect()][0] == ("b", 1, 1.0, True, 0.0)


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_ranks_against_plain_loops(spark, broadcast_bytes):
    rng = random.Random(9)
    # One left node is in a third of all rows.
    rows = [(rng.choice(["hot", rng.choice("abcdef"), rng.choice("ghijk"), None]), rng.choice([None, *range(12)])) for _ in range(300)]
    weight = {}
    for pair in rows:
        if None not in pair:
            weight[pair] = weight.get(pair, 0) + 1
    strength = {}
    for (l, r), w in weight.items():
        strength["l", l] = strength.get(("l", l), 0) + w
        strength["r", r] = strength.get(("r", r), 0) + w
    lefts, rights = {l for l, _ in weight}, {r for _, r in weight}
    rank_l, rank_r = {l: 1 / len(lefts) for l in lefts}, {}
    for _ in range(4):
        rank_r = {r: 0.15 / len(rights) + 0.85 * sum(rank_l[l] / strength["l", l] * w for (l, q), w in weight.items() if q == r) for r in rights}
        rank_l = {l: 0.15 / len(lefts) + 0.85 * sum(rank_r[r] / strength["r", r] * w for (p, r), w in weight.items() if p == l) for l in lefts}
    df = spark.createDataFrame(rows, "l string, r int")
    got_l, got_r = C.collaboration_rank(df, "l", "r", 4, broadcast_bytes=broadcast_bytes)
    assert {x.node: (x.rank, x.strength) for x in got_l.collect()} == {l: (pytest.approx(rank_l[l]), strength["l", l]) for l in lefts}
    assert {x.node: x.rank for x in got_r.collect()} == pytest.approx(rank_r)
    assert sum(rank_l.values()) == pytest.approx(1.0)
    featured = C.collaboration_features(df, "l", "r", 4)
    assert featured.count() == 300
    for x in featured.collect():
        assert x.pair_count == weight.get((x.l, x.r))
        assert x.l_rank == (pytest.approx(rank_l[x.l]) if x.l in rank_l else None)
        assert x.r_degree == (len({l for l, r in weight if r == x.r}) or None)


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_a_grid_of_strengths_is_the_single_encodings(spark, broadcast_bytes):
    df = spark.createDataFrame(ROWS, "i int, c string, y double")
    train, test = df.filter("i < 60"), df.filter("i >= 60")
    strengths = {"a": 1.0, "b": 10.0}
    got = E.encode_apply_grid(test, E.target_encode_fit(train, "c", "y"), strengths, ["i"], broadcast_bytes)
    assert got.columns == ["i", "y", "a", "b"]
    for name, strength in strengths.items():
        want = E.encode_apply(test, E.target_encode_fit(train, "c", "y", strength), ["i"]).collect()
        assert {r.i: r[name] for r in got.collect()} == pytest.approx({r.i: r.c_encoded for r in want})


def test_all_rounds_together_send_out_no_more_than_one_lookup(spark, monkeypatch):
    assert 5 * X.broadcast_share(5) <= X.BROADCAST_BYTES
    # Each round's table fits the whole limit, but not its share of it.
    monkeypatch.setattr(X, "BROADCAST_BYTES", 1000)
    scored = []

    def fit_and_score(sides):
        fitted = E.target_encode_fit(one_side(sides, "train"), "c", "y")
        assert 200 < fitted.lookup.n_bytes <= 1000
        scored.append(E.encode_apply_grid(one_side(sides, "test"), fitted, {"p": 1.0}, ["i"], X.broadcast_share(5)))
        return scored[-1]

    df = spark.createDataFrame([(i, f"c{i % 15}", float(i)) for i in range(80)], "i int, c string, y double")
    assert X.cross_validate(X.fold_table(df, ["i"], 5), 5, fit_and_score, "y", {"p": "p"}).count() == 5
    # Not even the planner's own estimate sends them out.
    assert all("strategy=merge" in s._jdf.queryExecution().optimizedPlan().toString() for s in scored)


@pytest.mark.parametrize("turned", [False, True])
def test_rounds_read_lists_of_the_larger_side(spark, monkeypatch, turned):
    rng = random.Random(5)
    rows = [(rng.randrange(6), rng.randrange(40)) for _ in range(400)]
    df = spark.createDataFrame(rows, "l int, r int")
    if turned:
        df = df.select(F.col("r").alias("l"), F.col("l").alias("r"))
    whole = [{x.node: x.rank for x in side.collect()} for side in C.collaboration_rank(df, "l", "r", 3)]
    # Nodes with many edges have several lists.
    for size, broadcast_bytes in ((10_000, None), (3, None), (3, 0)):
        monkeypatch.setattr(C, "LIST_EDGES", size)
        lists, lefts, rights = C._ranked(df, "l", "r", 3, C.DAMPING, broadcast_bytes)
        assert lists.by == ("left" if turned else "right")
        n = lists.table.count()
        assert n == 40 if size > 40 else n > 40
        assert sorted((x.left, x.right, x.weight) for x in lists.edges().collect()) == sorted((x.left, x.right, x.weight) for x in C.edges(df, "l", "r").collect())
        for got, want in zip((lefts, rights), whole, strict=True):
            assert {x.node: x.rank for x in got.collect()} == pytest.approx(want)


def test_rows_with_both_values_are_joined_once(spark, monkeypatch):
    rows = [(1, "a", 1), (2, "a", 1), (3, "b", 1), (4, None, 1), (5, "a", None), (6, None, None), (7, "only here", None), (8, "b", 2)]
    df = spark.createDataFrame(rows, "i int, l string, r int")
    joined = []
    lookup_join = C.lookup_join
    monkeypatch.setattr(C, "lookup_join", lambda table, column, *rest: joined.append((table, column)) or lookup_join(table, column, *rest))
    found = C.collaboration_features(df, "l", "r", 1, spread=["i"])
    # Of all joins with rows of the input, one is of the rows with both values.
    assert sorted(t.count() for t, _ in joined if "i" in t.columns) == [4, 4, 4]
    got = {x.i: (x.l, x.r, x.l_degree, x.r_degree, x.pair_count) for x in found.collect()}
    assert got == {
        1: ("a", 1, 1, 2, 2), 2: ("a", 1, 1, 2, 2), 3: ("b", 1, 2, 2, 1), 4: (None, 1, None, 2, None), 5: ("a", None, 1, None, None),
        6: (None, None, None, None, None), 7: ("only here", None, None, None, None), 8: ("b", 2, 2, 1, 1),
    }
