"""Relational operators, profiles, cleaning and derived columns on small frames."""

import pytest
from pyspark.sql import functions as F

from filmlens.functions import bands, derive
from filmlens.operators import cleaning as C
from filmlens.operators import profiling as P
from filmlens.operators import relational as R


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_year_parsing(spark):
    df = spark.createDataFrame([("TV Movie 2019",), ("1999",), ("",), (None,), ("n/a",), ("99999999999",)], "year string")
    assert [r[1] for r in rows(C.clean_year(df))] == [2019, 1999, None, None, None, None]
    assert [r[1] for r in rows(C.clean_year(df, mode="strict"))] == [None, 1999, None, None, None, None]
    assert [r[1] for r in rows(C.clean_year(df, dtype="double"))][:2] == [2019.0, 1999.0]
    with pytest.raises(ValueError):
        C.clean_year(df, mode="other")


def test_blank_and_null_are_told_apart(spark):
    df = spark.createDataFrame([("a", 1.0), ("", 2.0), (None, float("nan")), ("b", None)], "director string, x double")
    assert {r.column: r.n_null for r in P.null_profile(df).collect()} == {"director": 2, "x": 1}
    assert df.na.drop(subset=["director"]).count() == 3
    assert R.drop_blank(df, ["director"]).count() == 2
    assert df.filter(R.all_present(df, ["director", "x"])).count() == df.na.drop().count() == 2
    done = P.completeness(df).first()
    assert (done.n_rows, done.n_complete, done.n_incomplete) == (4, 2, 2)
    kept = C.retention(df, R.all_present(df, ["x"])).first()
    assert (kept.rows_before, kept.rows_after, kept.pct_lost) == (4, 2, 50.0)


def test_profiles_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "a string, x double")
    assert rows(P.null_profile(df)) == [("a", 0, None), ("x", 0, None)]
    assert rows(P.distinct_counts(df, ["a"])) == [("a", 0)]
    assert R.join_loss(df, df, "a").first().rows_before == 0


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("a", 2)], "s string, n int")
    assert dict(rows(P.distinct_counts(df, ["s", "n"]))) == {"s": 2, "n": 2}
    assert df.select("s").distinct().count() == 2


def test_describe_matches_spark(spark):
    df = spark.createDataFrame([(1, "TV 1"), (2, "20"), (4, "3"), (None, None)], "x int, s string")
    ours = P.describe_typed(df, ["x"]).first()
    theirs = {r.summary: float(r.x) for r in df.describe("x").collect()}
    assert (ours.n, ours.mean, ours.sd, ours.min, ours.max) == pytest.approx(
        (theirs["count"], theirs["mean"], theirs["stddev"], theirs["min"], theirs["max"])
    )
    text = P.describe_text(df, ["s"]).first()
    assert (text.n, text.mean, text.min, text.max) == (3, 11.5, "20", "TV 1")


def test_histogram_cuts_toward_zero(spark):
    df = spark.createDataFrame([(6.29,), (6.21,), (6.3,), (-0.05,)], "x double")
    assert rows(P.histogram(df, "x")) == [(0.0, 1), (6.2, 2), (6.3, 1)]


def test_top_groups_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "g string")
    assert rows(P.top_groups(df, "g", 2)) == [("c", 2), ("a", 1)]


def test_dedupe_first_last(spark):
    data = [("k", 3, "c", None), ("k", 1, "a", "x"), ("k", 2, "b", "y"), (None, 5, "n", "z"), (None, 4, "m", None)]
    df = spark.createDataFrame(data, "k string, o int, v string, w string")
    assert set(rows(R.dedupe_by_key(df, ["k"], ["o"]))) == {("k", 1, "a", "x"), (None, 4, "m", None)}
    assert set(rows(R.first_last(df, ["k"], "v", ["o"]))) == {("k", "a", "c"), (None, "m", "n")}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_loss_equals_the_join(spark, how):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,), (None,)], "k int")
    found = R.join_loss(left, right, "k", how).first()
    assert (found.rows_before, found.rows_after) == (5, left.join(right, "k", how).count())


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    train, test = R.split_by_key(df, ["k"])
    again, _ = R.split_by_key(df.repartition(13).orderBy(F.desc("k")), ["k"])
    assert {r.k for r in train.collect()} == {r.k for r in again.collect()}
    assert train.count() + test.count() == 5000 and 3800 < train.count() < 4200
    hundreds = df.select((F.col("k") * 100).alias("k"))
    assert 3800 < R.split_by_key(hundreds, ["k"])[0].count() < 4200
    sample = R.sample_by_key(df, ["k"], 10)
    assert 400 < sample.count() < 600


def test_bins_and_flags_at_their_edges(spark):
    df = spark.createDataFrame([(5.0,), (6.0,), (7.0,), (8.0,), (4.99,), (None,)], "x double")
    bins = [r[0] for r in df.select(bands.rating_bin(F.col("x"))).collect()]
    assert bins == [*bands.RATING_LABELS[1:], bands.RATING_LABELS[0], bands.RATING_LABELS[-1]]
    years = spark.createDataFrame([(1980, 90), (1981, 91), (2014, 120), (2015, 121), (None, None)], "year_clean int, duration int")
    found = derive.derive_temporal(years).select("decade", "is_recent", "is_old_classic", "duration_category").collect()
    assert [tuple(r) for r in found] == [
        (1980, 0.0, 1.0, "short"),
        (1980, 0.0, 0.0, "medium"),
        (2010, 0.0, 0.0, "medium"),
        (2010, 1.0, 0.0, "long"),
        (None, 0.0, 0.0, "long"),
    ]


def test_popularity_with_zero_reviews(spark):
    df = spark.createDataFrame([(10, 0.0, 0.0)], "votes int, reviews_from_users double, reviews_from_critics double")
    found = derive.derive_popularity(df).first()
    assert (found.votes_per_review, found.review_ratio) == (10.0, 0.0)
    assert found.log_votes == pytest.approx(2.397895, abs=1e-6)


def test_validation_cleaning(spark):
    data = [("1999", "g", 1.0), ("TV 1999", "g", 1.0), ("1999", "", 1.0), ("1999", "g", None), (None, "g", 1.0)]
    df = spark.createDataFrame(data, "year string, genre string, label double")
    found = C.clean_validation(df, ["label", "genre", "year_clean"], ["genre"])
    assert found.columns == ["genre", "label", "year_clean"] and rows(found) == [("g", 1.0, 1999)]


@pytest.mark.parametrize("n,verdict", [(10001, "sufficient"), (10000, "limited"), (5001, "limited"), (5000, "insufficient")])
def test_sufficiency(spark, n, verdict):
    assert C.data_sufficiency(spark.range(n), F.lit(True)).first().verdict == verdict


def test_bands(spark):
    df = spark.createDataFrame([(0.29,), (0.3,), (0.5,), (0.7,), (0.39,), (0.6,)], "r double")
    assert [r[0] for r in df.select(bands.r2_band(F.col("r"))).collect()] == ["low", "moderate", "good", "suspect", "moderate", "good"]
    assert [r[0] for r in df.select(bands.r2_band_intrinsic(F.col("r"))).collect()][4:] == ["realistic", "suspect"]
