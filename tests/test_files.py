"""CSV readers, film schemas and sinks."""

from pyspark.sql import functions as F

from filmlens.sources.catalog import full_movies
from filmlens.sources.csv_files import movie_schema, rating_schema, read_csv, read_movies
from filmlens.sources.sinks import save_head, save_table, write_csv
from filmlens.sources.staging import materialize, released, staging_root


def test_schema_widths():
    assert len(movie_schema().fields) == 22
    assert len(rating_schema().fields) == 49
    assert movie_schema("my_id").names[0] == "my_id"


def test_doubled_quote_and_line_break(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('id,description\na,"He said ""no"", left"\nb,"two\nlines"\n')
    schema = "id string, description string"
    whole = read_csv(spark, str(path), schema, multi_line=True).collect()
    assert [tuple(r) for r in whole] == [("a", 'He said "no", left'), ("b", "two\nlines")]
    assert read_csv(spark, str(path), schema).count() == 3
    assert read_csv(spark, str(path), multi_line=True).columns == ["id", "description"]


def _film_files(tmp_path):
    movies, ratings = movie_schema(), rating_schema()
    text = {"title_id": "t1", "title": "A", "year": "TV Movie 2019", "duration": "90", "avg_vote": "7.5", "votes": "120"}
    other = {"title_id": "t2", "title": "B", "year": "1999", "duration": "100", "avg_vote": "6.5", "votes": "130"}
    lines = [",".join(movies.names)] + [",".join(row.get(n, "") for n in movies.names) for row in (text, other)]
    (tmp_path / "movies.csv").write_text("\n".join(lines) + "\n")
    rated = {"title_id": "t1", "total_votes": "120", "mean_vote": "7.4"}
    lines = [",".join(ratings.names), ",".join(rated.get(n, "") for n in ratings.names)]
    (tmp_path / "ratings.csv").write_text("\n".join(lines) + "\n")
    return str(tmp_path / "movies.csv"), str(tmp_path / "ratings.csv")


def test_film_files(spark, tmp_path):
    movies, ratings = _film_files(tmp_path)
    full = full_movies(spark, movies, ratings)
    assert len(full.columns) == 70 and full.count() == 2
    assert full.filter(F.col("total_votes").isNull()).count() == 1
    assert full_movies(spark, movies, ratings, how="inner").count() == 1
    inferred = read_movies(spark, movies, infer_schema=True)
    assert inferred.columns == movie_schema().names and dict(inferred.dtypes)["votes"] == "int"


def test_csv_keeps_odd_texts(spark, tmp_path):
    odd = [(1, ' lead and trail '), (2, 'q"uote, comma'), (3, "line\nbreak"), (4, None), (5, "back\\slash"), (6, '\\"')]
    df = spark.createDataFrame(odd, "id int, text string")
    write_csv(df, str(tmp_path / "odd"), file_bytes=1)
    back = read_csv(spark, str(tmp_path / "odd"), df.schema, multi_line=True)
    assert sorted((tuple(r) for r in back.collect()), key=lambda r: r[0]) == odd


def test_sinks(spark, tmp_path):
    df = spark.range(100)
    save_head(df, str(tmp_path / "head"), 5, [F.desc("id")])
    assert [r.id for r in spark.read.parquet(str(tmp_path / "head")).orderBy("id").collect()] == [95, 96, 97, 98, 99]
    save_table(df, str(tmp_path / "all"), "json")
    assert spark.read.json(str(tmp_path / "all")).count() == 100


def test_materialize_uses_the_named_folder(spark):
    written = materialize(spark.range(10), "ten")
    assert written.count() == 10
    assert all(staging_root(spark) in f for f in written.inputFiles())


def test_layout_does_not_depend_on_the_input_files(spark, tmp_path):
    def rows(files):
        path = str(tmp_path / f"in{files}")
        spark.range(0, 1000, 1, files).write.parquet(path)
        written = materialize(spark.read.parquet(path), "dealt", ["id"])
        return sorted(sorted(r.id for r in spark.read.parquet(f).collect()) for f in written.inputFiles())

    assert rows(1) == rows(16)


def test_staged_tables_go_when_released(spark):
    import os

    with released(spark):
        written = materialize(spark.range(10), "short-lived")
        folder = os.path.dirname(written.inputFiles()[0].removeprefix("file://"))
        assert os.path.exists(folder)
    assert not os.path.exists(folder)


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    import pytest

    class Context:
        master = "spark://somewhere"

        @staticmethod
        def getCheckpointDir():
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError):
        staging_root(Session())
