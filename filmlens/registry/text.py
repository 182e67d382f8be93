"""Description tokens, exact-term weights and the hashed text features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, FeatureHasher, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.functions.derive import duration_category
from filmlens.functions.stopwords import ENGLISH
from filmlens.functions.text import content_tokens, term_tfidf, tokens
from filmlens.operators.relational import hash_percent, split_by_key
from filmlens.plans.features import hash_text, vector_entries
from filmlens.registry.core import query
from filmlens.registry.tables import draw_sql, labelled_documents, rounded, table
from filmlens.sources.staging import materialize

_STOP_SQL = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH)
_TOKENS_SQL = r"list_filter(regexp_split_to_array(lower(text), '\W+'), lambda w: length(w) >= 3)"
_CONTENT_SQL = f"list_filter({_TOKENS_SQL}, lambda w: w NOT IN ({_STOP_SQL}))"


def _tokens_sql(expression: str) -> str:
    return f"SELECT doc_id, CAST(len({expression}) AS INT) AS n_tokens, array_to_string({expression}, ' ') AS tokens FROM documents"


@query("text_tokens", _tokens_sql(_TOKENS_SQL))
def text_tokens(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "documents").select("doc_id", tokens("text").alias("words"))
    return found.select("doc_id", F.size("words").alias("n_tokens"), F.array_join("words", " ").alias("tokens"))


@query("text_tokens_filtered", _tokens_sql(_CONTENT_SQL))
def text_tokens_filtered(spark: SparkSession, sf: str) -> DataFrame:
    found = table(spark, sf, "documents").select("doc_id", content_tokens("text").alias("words"))
    return found.select("doc_id", F.size("words").alias("n_tokens"), F.array_join("words", " ").alias("tokens"))


_TFIDF_SQL = (
    f"""WITH x AS (SELECT doc_id, {draw_sql("doc_id")} AS draw, unnest({_CONTENT_SQL}) AS term FROM documents),
             m AS (SELECT count(*) AS m FROM documents WHERE {draw_sql("doc_id")} < 80),
             f AS (SELECT term, count(DISTINCT doc_id) AS df FROM x WHERE draw < 80 GROUP BY 1),
             c AS (SELECT doc_id, term, count(*) AS tf FROM x GROUP BY 1, 2)
        SELECT doc_id, c.term, tf, coalesce(df, 0) AS df,
               round(tf * ln(CAST((SELECT m FROM m) + 1 AS DOUBLE) / (coalesce(df, 0) + 1)), 6) AS tfidf
        FROM c LEFT JOIN f ON c.term = f.term"""
)


def _term_tfidf(spark: SparkSession, sf: str, broadcast_bytes: int | None = None) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return term_tfidf(docs, "doc_id", "text", hash_percent(["doc_id"]) < 80, broadcast_bytes).withColumn("tfidf", rounded("tfidf"))


@query("term_tfidf", _TFIDF_SQL)
def term_tfidf_query(spark: SparkSession, sf: str) -> DataFrame:
    return _term_tfidf(spark, sf)


@query("term_tfidf_shuffled", _TFIDF_SQL)
def term_tfidf_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    return _term_tfidf(spark, sf, broadcast_bytes=0)


_MASK = "4294967295::UBIGINT"


def _rotated(x: str, bits: int) -> str:
    return f"(((({x}) << {bits}) | (({x}) >> {32 - bits})) & {_MASK})"


def _folded(x: str, shift: int) -> str:
    return f"xor({x}, {x} >> {shift})"


def _bucket_sql(source: str, width: int) -> str:
    """CTEs ending in ``buckets`` (term, bucket): the terms of ``source`` under the public 32-bit Murmur3 hash with seed 42.

    Terms are taken as UTF-8 in four-byte words, little end first; what is left
    at the end is mixed in like a word but not stirred, and the bucket is the
    signed hash modulo ``width``.
    """
    word = lambda at, n: "('0x' || " + " || ".join(f"h[{at} + {2 * k - 1} : {at} + {2 * k}]" for k in range(n, 0, -1)) + ")::UBIGINT"
    mixed = lambda x: f"{_rotated(f'({x} * 3432918353::UBIGINT) & {_MASK}', 15)} * 461845907::UBIGINT & {_MASK}"
    stirred = _rotated("xor(a, b)", 13)
    return f"""
        spelled AS (SELECT term, hex(encode(term)) AS h, octet_length(encode(term)) AS n FROM (SELECT DISTINCT term FROM {source}) q),
        cut AS (SELECT term, n, list_transform(range(0, n // 4), lambda i: {word("8 * i", 4)}) AS body,
                       CASE n % 4 WHEN 0 THEN 0::UBIGINT WHEN 1 THEN {word("2 * n - 2", 1)} WHEN 2 THEN {word("2 * n - 4", 2)} ELSE {word("2 * n - 6", 3)} END AS tail FROM spelled),
        mixed AS (SELECT term, n, list_prepend(42::UBIGINT, list_transform(body, lambda k: {mixed("k")})) AS parts, {mixed("tail")} AS tail FROM cut),
        stirred AS (SELECT term, xor(xor(list_reduce(parts, lambda a, b: ({stirred} * 5 + 3864292196::UBIGINT) & {_MASK}), tail), n::UBIGINT) AS h FROM mixed),
        once AS (SELECT term, {_folded("h", 16)} * 2246822507::UBIGINT & {_MASK} AS h FROM stirred),
        twice AS (SELECT term, {_folded("h", 13)} * 3266489909::UBIGINT & {_MASK} AS h FROM once),
        final AS (SELECT term, {_folded("h", 16)}::BIGINT AS h FROM twice),
        buckets AS (SELECT term, CAST(((h - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END) % {width} + {width}) % {width} AS INT) AS bucket FROM final)"""


_HASHED_SQL = f"""WITH x AS (SELECT doc_id, unnest({_CONTENT_SQL}) AS term FROM documents), {_bucket_sql("x", 100)},
    counts AS (SELECT doc_id, bucket, CAST(count(*) AS DOUBLE) AS tf FROM x JOIN buckets USING (term) GROUP BY 1, 2)"""


def _hashed_documents(spark: SparkSession, sf: str) -> DataFrame:
    return hash_text(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@query("hashing_tf", f"{_HASHED_SQL} SELECT doc_id, bucket, tf FROM counts")
def hashing_tf(spark: SparkSession, sf: str) -> DataFrame:
    return vector_entries(_hashed_documents(spark, sf), "doc_id", "desc_tf", "tf")


@query("hashing_tf_sums", f"SELECT doc_id, CAST(len({_CONTENT_SQL}) AS DOUBLE) AS n_tokens FROM documents WHERE len({_CONTENT_SQL}) > 0")
def hashing_tf_sums(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of a document over all buckets: its tokens, wherever they were hashed to."""
    return hashing_tf(spark, sf).groupBy("doc_id").agg(F.sum("tf").alias("n_tokens"))


@query("hashed_tfidf")
def hashed_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    hashed = materialize(_hashed_documents(spark, sf), "hashed-documents")
    train, _ = split_by_key(hashed, ["doc_id"])
    weights = IDF(inputCol="desc_tf", outputCol="tfidf_vector").fit(train)
    return vector_entries(weights.transform(hashed), "doc_id", "tfidf_vector", "tfidf")


@query(
    "hashed_tfidf_rounded",
    f"""{_HASHED_SQL}, m AS (SELECT count(*) AS m FROM documents WHERE {draw_sql("doc_id")} < 80),
        f AS (SELECT bucket, count(*) AS df FROM counts WHERE {draw_sql("doc_id")} < 80 GROUP BY 1),
        w AS (SELECT doc_id, bucket, tf * ln(CAST((SELECT m FROM m) + 1 AS DOUBLE) / (coalesce(df, 0) + 1)) AS v FROM counts LEFT JOIN f USING (bucket))
        SELECT doc_id, bucket, round(v, 6) AS tfidf FROM w WHERE v <> 0""",
)
def hashed_tfidf_rounded(spark: SparkSession, sf: str) -> DataFrame:
    """The same to six places, for a comparison with SQL."""
    return hashed_tfidf(spark, sf).withColumn("tfidf", rounded("tfidf"))


@query(
    "feature_hasher",
    f"""WITH x AS (SELECT p_partkey, 'p_type=' || p_type AS term FROM part), {_bucket_sql("x", 16)}
        SELECT p_partkey, bucket, 1.0::DOUBLE AS value FROM x JOIN buckets USING (term)""",
)
def feature_hasher(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    hasher = FeatureHasher(inputCols=["p_type"], outputCol="genre_features", numFeatures=16)
    return vector_entries(hasher.transform(parts), "p_partkey", "genre_features")


@query("feature_hasher_entries", "SELECT p_partkey, CAST(1 AS BIGINT) AS n_entries, 1.0::DOUBLE AS total FROM part WHERE p_type IS NOT NULL")
def feature_hasher_entries(spark: SparkSession, sf: str) -> DataFrame:
    """One entry of value 1 for each part, in whatever bucket."""
    return feature_hasher(spark, sf).groupBy("p_partkey").agg(F.count(F.lit(1)).alias("n_entries"), F.sum("value").alias("total"))


@query(
    "string_index",
    """WITH t AS (SELECT p_partkey, CASE WHEN p_size <= 15 THEN 'short' WHEN p_size <= 35 THEN 'medium' ELSE 'long' END AS duration_category FROM part),
            r AS (SELECT duration_category, row_number() OVER (ORDER BY count(*) DESC, duration_category) - 1 AS i FROM t GROUP BY 1)
       SELECT p_partkey, duration_category, CAST(i AS DOUBLE) AS duration_indexed FROM t JOIN r USING (duration_category)""",
)
def string_index(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", duration_category("p_size", 15, 35).alias("duration_category"))
    indexer = StringIndexer(inputCol="duration_category", outputCol="duration_indexed", handleInvalid="keep")
    return indexer.fit(parts).transform(parts)


@query(
    "assemble_features",
    """SELECT doc_id, CAST(n_chars AS DOUBLE) AS f0, CAST(quality AS DOUBLE) AS f1, CAST(toxic AS DOUBLE) AS f2
       FROM documents JOIN labels USING (doc_id)""",
)
def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    rows = labelled_documents(spark, sf).select("doc_id", "n_chars", "quality", "toxic")
    assembler = VectorAssembler(inputCols=["n_chars", "quality", "toxic"], outputCol="features", handleInvalid="skip")
    values = assembler.transform(rows).select("doc_id", vector_to_array("features").alias("v"))
    return values.select("doc_id", *[F.col("v")[i].alias(f"f{i}") for i in range(3)])


@query(
    "standard_scale",
    """SELECT p_partkey, round(p_size / (SELECT stddev_samp(p_size) FROM part), 6) AS size_scaled,
              round(p_retailprice / (SELECT stddev_samp(p_retailprice) FROM part), 6) AS price_scaled FROM part""",
)
def standard_scale(spark: SparkSession, sf: str) -> DataFrame:
    stages = [
        VectorAssembler(inputCols=["p_size", "p_retailprice"], outputCol="features", handleInvalid="skip"),
        StandardScaler(inputCol="features", outputCol="scaled", withStd=True, withMean=False),
    ]
    parts = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    values = Pipeline(stages=stages).fit(parts).transform(parts).select("p_partkey", vector_to_array("scaled").alias("v"))
    return values.select("p_partkey", rounded(F.col("v")[0]).alias("size_scaled"), rounded(F.col("v")[1]).alias("price_scaled"))
