"""Feature frames: split first, fit on the training rows, apply to both sides."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    FeatureHasher,
    HashingTF,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.functions.derive import derive_popularity, derive_temporal
from filmlens.functions.stopwords import ENGLISH
from filmlens.operators.encoding import (
    Encoding,
    FoldedEncoding,
    TopCategories,
    encode_apply,
    frequency_encode_fit,
    kfold_encode_apply,
    kfold_encode_fit,
    target_encode_fit,
    top_categories_apply,
    top_categories_fit,
)
from filmlens.operators.relational import hash_percent
from filmlens.plans.variants import Variant
from filmlens.sources.staging import materialize


@dataclass(frozen=True)
class FeatureFrame:
    """The rows of both sides, told apart by ``side``, and what was fitted on the training side."""

    variant: Variant
    rows: DataFrame
    encodings: dict[str, Encoding | FoldedEncoding]
    top_genres: TopCategories
    limits: Mapping[str, float]
    broadcast_bytes: int | None = None

    def temporal(self, df: DataFrame) -> DataFrame:
        """The row features that need no fit."""
        return derive_temporal(df, **self.limits)

    def apply(self, df: DataFrame) -> DataFrame:
        """Encode the categories, reduce the genres and derive the row features."""
        for encoding in self.encodings.values():
            if isinstance(encoding, FoldedEncoding):
                df = kfold_encode_apply(df, encoding, F.col("side") == "train", [self.variant.key], self.broadcast_bytes)
            else:
                df = encode_apply(df, encoding, [self.variant.key], self.broadcast_bytes)
        df = self.temporal(top_categories_apply(df, self.top_genres, spread=[self.variant.key]))
        return derive_popularity(df) if self.variant.popularity else df

    @property
    def train_rows(self) -> DataFrame:
        return one_side(self.rows, "train")

    @property
    def both(self) -> DataFrame:
        """All rows encoded in one pass, with their ``side``."""
        return self.apply(self.rows)


def one_side(df: DataFrame, side: str) -> DataFrame:
    return df.filter(F.col("side") == side).drop("side")


def split_table(df: DataFrame, keys: list[str], name: str, train_percent: int = 80, seed: int = 42, dealt: bool = True) -> DataFrame:
    """Write ``df`` once with its ``side``, train or test, as the folder of each row.

    A read of one side does not open the other's files. Rows are dealt by the
    keys. Where nothing depends on the layout, as in encoders and what they are
    applied to, ``dealt=False`` saves that shuffle and the sort by folder: rows
    are written by the task that has them, and ``side`` is a plain column.
    """
    side = F.when(hash_percent(keys, seed) < train_percent, "train").otherwise("test")
    marked = df.withColumn("side", side)
    return materialize(marked, name, keys, ["side"]) if dealt else materialize(marked, name)


def fit_encoder(train: DataFrame, variant: Variant, column: str) -> Encoding | FoldedEncoding:
    """The variant's encoder, fitted on one category column of the training rows."""
    if variant.encoder == "kfold":
        return kfold_encode_fit(train, column, variant.target, [variant.key], variant.folds, variant.smoothing)
    return target_encode_fit(train, column, variant.target, variant.smoothing) if variant.encoder == "target" else frequency_encode_fit(train, column)


def feature_frame(rows: DataFrame, variant: Variant, broadcast_bytes: int | None = None, **limits: float) -> FeatureFrame:
    """Fit the encoders and the genre list on the training rows of ``rows``, which have a ``side``.

    ``broadcast_bytes`` bounds the encoders' lookups (see ``lookup_join``).
    ``limits`` passes other year and duration limits to ``derive_temporal``.
    Every fit reads the raw training rows, so its plan stays flat however many
    encoders are chained.
    """
    train = one_side(rows, "train")
    encodings = {c: fit_encoder(train, variant, c) for c in variant.categories}
    top = top_categories_fit(train, variant.genre, variant.top_genres)
    return FeatureFrame(variant, rows, encodings, top, limits, broadcast_bytes)


def text_stages(text: str, width: int = 100) -> list:
    """Tokenise, remove stop words, hash the term counts and weigh them."""
    return [
        RegexTokenizer(inputCol=text, outputCol="desc_words", pattern="\\W+", minTokenLength=3),
        StopWordsRemover(inputCol="desc_words", outputCol="desc_filtered", stopWords=ENGLISH),
        HashingTF(inputCol="desc_filtered", outputCol="desc_tf", numFeatures=width),
        IDF(inputCol="desc_tf", outputCol="description_features"),
    ]


def hash_text(df: DataFrame, text: str, width: int = 100) -> DataFrame:
    """Replace the text column by its hashed term counts, ``desc_tf``, and leave in its place whether there is a text.

    The three stages before the weights have no state, so a text is cut up
    once, best on its scan: before any join, and before anything is fitted. The
    mark (true, or null without a text) serves the rules on missing values.
    """
    tokenizer, remover, hashing, _ = text_stages(text, width)
    marked = df.withColumn("__has_text", F.when(F.col(text).isNotNull(), F.lit(True))).withColumn(text, F.coalesce(text, F.lit("")))
    hashed = PipelineModel([tokenizer, remover, hashing]).transform(marked).drop(text, "desc_words", "desc_filtered")
    return hashed.withColumnRenamed("__has_text", text)


def feature_stages(variant: Variant) -> Pipeline:
    """The eight feature stages; rows with a missing input are skipped by the assembler."""
    return Pipeline(
        stages=[
            *text_stages(variant.text, variant.text_width),
            FeatureHasher(inputCols=[variant.genre], outputCol="genre_features", numFeatures=variant.genre_width),
            StringIndexer(inputCol=variant.indexed, outputCol="duration_indexed", handleInvalid="keep"),
            VectorAssembler(
                inputCols=["description_features", "genre_features", *variant.numeric],
                outputCol="features",
                handleInvalid="skip",
            ),
            StandardScaler(inputCol="features", outputCol="scaled_features", withStd=True, withMean=False),
        ]
    )


@dataclass(frozen=True)
class FeatureTables:
    """Fitted feature stages and the assembled rows of both sides, as written tables."""

    stages: PipelineModel
    train: DataFrame
    test: DataFrame

    @property
    def varying(self) -> list[int]:
        """The positions that differ between training rows; at all others the scaled vector is 0."""
        return [i for i, deviation in enumerate(self.stages.stages[-1].std.toArray()) if deviation != 0.0]


def fit_features(frame: FeatureFrame) -> FeatureTables:
    """Fit every feature stage on the least input it needs; all regressors share the result.

    The rows of ``frame`` carry hashed term counts in place of the text (see
    :func:`hash_text`). The term weights need only those counts and the
    duration index only the duration class, so these fits do not run the
    encoder joins. The assembled vectors are written once; the scaler is
    fitted on that table and applied as it is read.
    """
    variant = frame.variant
    tokenizer, remover, hashing, idf, hasher, indexer, assembler, scaler = feature_stages(variant).getStages()
    weights = idf.fit(frame.train_rows.select("desc_tf"))
    index = indexer.fit(frame.temporal(frame.train_rows).select(variant.indexed))
    assembly = PipelineModel([weights, hasher, index, assembler])

    assembled = assembly.transform(frame.both).select(variant.key, variant.target, "features", "side")
    vectors = materialize(assembled, "vectors", [variant.key], ["side"])
    train, test = one_side(vectors, "train"), one_side(vectors, "test")
    scaling = scaler.fit(train)
    stages = PipelineModel([tokenizer, remover, hashing, *assembly.stages, scaling])
    return FeatureTables(stages, scaling.transform(train), scaling.transform(test))


def feature_index_map(spark: SparkSession, variant: Variant) -> DataFrame:
    """Name and group of every position of the assembled vector, from the input widths."""
    text, genre = variant.text_width, variant.genre_width
    rows = [(i, f"{variant.text}[{i}]", "text") for i in range(text)]
    rows += [(text + i, f"{variant.genre}[{i}]", "genre") for i in range(genre)]
    for i, name in enumerate(variant.numeric):
        group = f"{variant.encoder}_encoding" if name.endswith(("_encoded", "_freq")) else "numeric"
        rows.append((text + genre + i, name, group))
    return spark.createDataFrame(rows, "index int, name string, group string")


def feature_summary(assembled: DataFrame, variant: Variant) -> DataFrame:
    """The index map with each position's non-zero count and mean over the rows."""
    stats = assembled.agg(Summarizer.metrics("numNonZeros", "mean").summary(F.col("features")).alias("s")).select(
        F.arrays_zip(
            vector_to_array("s.numNonZeros").alias("n_nonzero"), vector_to_array("s.mean").alias("mean")
        ).alias("z")
    )
    per_index = stats.select(F.posexplode("z").alias("index", "v")).select("index", "v.n_nonzero", "v.mean")
    return (
        feature_index_map(assembled.sparkSession, variant)
        .join(per_index, "index")
        .select("index", "name", "group", F.col("n_nonzero").cast("bigint").alias("n_nonzero"), "mean")
        .orderBy("index")
    )


def vector_entries(df: DataFrame, key: str, vector: str, value: str = "value") -> DataFrame:
    """The non-zero entries of a vector column as rows."""
    return (
        df.select(key, F.posexplode(vector_to_array(vector)).alias("bucket", value))
        .filter(F.col(value) != 0.0)
    )
