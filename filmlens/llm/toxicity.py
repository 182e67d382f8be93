"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Features are words and their beginnings of 4 to 7 bytes, hashed; one that
occurs 2, 3 or 5 times in a text is a further feature each time, so that the
cosine, which forgets lengths, still sees how often it occurs. A bounded
sample of labelled texts is the example set; from it all features that tell the
classes apart are taken. Document frequencies of the chosen features are
counted over all documents. The examples form an inverted index whose postings
are cut into blocks of examples; for each feature and block the largest weight
is kept. A query adds up these maxima, visits blocks from the largest bound
down and stops when no block left can reach its k-th best example: the k nearest
are exact. Their votes, weighted by 1 / distance and by what each class's
sample stands for, are calibrated on the examples themselves, each judged
without itself.

Only the example set is sampled. Ids, languages and sources are no features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import table
from filmlens.llm.tokens import byte_hashes, find_words, mix64, slices
from filmlens.sources.staging import materialize

EXAMPLES = 2000
"""Most labelled texts of each class that are used: a bounded sample, by a hash of the id."""
MIN_TEXTS = 3
MIN_LIFT = 4.0
NEIGHBOURS = 15
BLOCK = 64
_PREFIXES = (4, 5, 6, 7)
_LEVELS = (1, 2, 3, 5)
"""Occurrences in a text from which on it has the feature of that level."""
_LETTERS_BIT = 16


def held_out(id_column: Column) -> Column:
    return F.pmod(F.coalesce(F.crc32(id_column.cast("string")), F.lit(0)), F.lit(5)) == 0


def _features(texts: list[bytes | None], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text numbers, words and beginnings, and how often they occur; with ``wanted`` (sorted), only those, as their numbers."""
    words = find_words(texts, lower=True, letters=True)
    owner = np.repeat(np.arange(len(texts)), words.counts)
    length = words.end - words.start
    owners, values = [owner], [words.hashes]
    for n in _PREFIXES:
        at = length > n
        owners.append(owner[at])
        values.append(mix64(byte_hashes(words.sums, words.start[at], words.start[at] + n) + np.uint64(n)))
    owner, value = np.concatenate(owners), np.concatenate(values)
    if wanted is not None:
        near = np.zeros(1 << _LETTERS_BIT, bool)
        near[wanted >> np.uint64(64 - _LETTERS_BIT)] = True
        at = near[value >> np.uint64(64 - _LETTERS_BIT)]
        owner, value = owner[at], value[at]
        k = np.searchsorted(wanted, value)
        k[k == len(wanted)] = 0
        at = wanted[k] == value if len(wanted) else np.zeros(0, bool)
        owner, value = owner[at], k[at]
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    fresh = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])))[: len(owner)])
    return owner[fresh], value[fresh], np.diff(np.append(fresh, len(owner)))


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        owner, value, count = _features(texts)
        toxic = np.asarray(part.column("toxic"))[owner] == 1
        for level in _LEVELS:
            at = count >= level
            names, k = np.unique(value[at], return_inverse=True)
            n = [np.bincount(k, x[at], len(names)).astype(np.int64) for x in (toxic, ~toxic)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.view(np.int64)), pa.array(np.full(len(names), level, np.int32)), *map(pa.array, n)],
                names=["feature", "level", "n_toxic", "n_clean"],
            )


@dataclass(frozen=True)
class Chosen:
    """The chosen features: ``number[i, j]`` is that of ``names[i]`` at level j, or -1."""

    names: np.ndarray
    number: np.ndarray
    size: int

    @classmethod
    def of(cls, rows: list[tuple[int, int]]) -> Chosen:
        rows = sorted(rows)
        names = np.unique(np.array([r[0] for r in rows], np.int64).view(np.uint64))
        number = np.full((len(names), len(_LEVELS)), -1)
        for k, (name, level) in enumerate(rows):
            number[np.searchsorted(names, np.array([name], np.int64).view(np.uint64)), _LEVELS.index(level)] = k
        return cls(names, number, len(rows))

    def __call__(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text numbers, feature numbers and counts, by text, then feature."""
        owner, k, count = _features(texts, self.names)
        parts = []
        for j, level in enumerate(_LEVELS):
            at = count >= level
            number = self.number[k[at], j] if len(self.names) else k[at]
            has = number >= 0
            parts.append((owner[at][has], number[has], count[at][has] - level + 1))
        owner, number, count = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((number, owner))
        return owner[order], number[order], count[order]


def _vectors(df: DataFrame, chosen: Chosen, extra: str, extra_type: str) -> DataFrame:
    """``extra`` column, feature numbers and counts of each row's ``text``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            owner, feature, count = chosen(texts)
            offsets = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (feature, count)]
            yield pa.RecordBatch.from_arrays([part.column(extra), *lists], names=[extra, "features", "counts"])

    return df.select(extra, "text").mapInArrow(rows, f"{extra} {extra_type}, features array<int>, counts array<int>")


@dataclass
class Model:
    """The examples as a block-max inverted index."""

    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    stands_for: np.ndarray
    first: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    block_max: np.ndarray
    prior: float
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def build(cls, idf: np.ndarray, ids: np.ndarray, toxic: np.ndarray, stands_for: np.ndarray, vectors: list[tuple[np.ndarray, np.ndarray]], prior: float) -> Model:
        weights = [tf_idf(f, c, idf) for f, c in vectors]
        # Similar examples get neighbouring places, which keeps the block maxima tight.
        lead = [int(f[np.argmax(w)]) if len(f) else len(idf) for (f, _), w in zip(vectors, weights, strict=True)]
        order = np.lexsort((ids, lead))
        place = np.repeat(np.arange(len(order)), [len(vectors[i][0]) for i in order])
        feature = np.concatenate([vectors[i][0] for i in order] + [np.zeros(0, np.int64)]).astype(np.int64)
        weight = np.concatenate([weights[i] for i in order] + [np.zeros(0)])
        n_blocks = (len(order) + BLOCK - 1) // BLOCK
        sort = np.lexsort((place, feature))
        cell = feature[sort] * n_blocks + place[sort] // BLOCK
        first = np.searchsorted(cell, np.arange(len(idf) * n_blocks + 1))
        block_max = np.zeros(len(idf) * n_blocks)
        np.maximum.at(block_max, cell, weight[sort])
        model = cls(idf, ids[order], toxic[order], stands_for[order], first, place[sort], weight[sort], block_max.reshape(len(idf), n_blocks), prior)
        model._calibrate([vectors[i] for i in order])
        return model

    def nearest(self, features: np.ndarray, weights: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the largest positive cosine, ties to the earlier one; and the cosines."""
        n_blocks = self.block_max.shape[1]
        bound = weights @ self.block_max[features] if len(features) else np.zeros(n_blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, similar = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 4
        while at < len(order):
            if len(best) == k and bound[order[at]] < similar[-1] * (1 - 1e-12):
                break
            cells = (features[:, None] * n_blocks + order[at : at + step]).reshape(-1)
            n = self.first[cells + 1] - self.first[cells]
            entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - self.first[cells], n)
            scale = np.repeat(np.repeat(weights, min(step, len(order) - at)), n)
            total = np.bincount(self.example[entry], scale * self.weight[entry])
            found = np.flatnonzero(total)
            found = found[found != without]
            best, similar = np.concatenate([best, found]), np.concatenate([similar, total[found]])
            top = np.lexsort((best, -similar))[:k]
            best, similar = best[top], similar[top]
            at, step = at + step, step * 2
        return best, np.minimum(similar, 1.0)

    def vote(self, found: np.ndarray, similar: np.ndarray) -> float:
        # Inverse distance, less its value at no similarity: far examples hardly count.
        weight = self.stands_for[found] * similar / (0.05 + 1 - similar)
        # The prior takes part as one far example.
        return float((weight @ self.toxic[found] + self.prior) / (weight.sum() + 1))

    def _calibrate(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> None:
        raw = np.array([self.vote(*self.nearest(f, tf_idf(f, c, self.idf), without=i)) for i, (f, c) in enumerate(vectors)])
        if len(set(self.toxic.tolist())) < 2:
            return
        x, y, w = _logit(raw), self.toxic.astype(float), self.stands_for / self.stands_for.sum()
        slope, shift = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -30, 30)))
            g = np.array([(w * (p - y) * x).sum() + 1e-3 * (slope - 1), (w * (p - y)).sum() + 1e-3 * shift])
            v = w * p * (1 - p)
            h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-3]])
            d = np.linalg.solve(h, g)
            slope, shift = slope - np.clip(d[0], -0.5, 0.5), shift - np.clip(d[1], -1, 1)
            if np.abs(d).max() < 1e-9:
                break
        self.slope, self.shift = (float(slope), float(shift)) if slope > 0 else (1.0, 0.0)

    def score(self, features: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray]:
        found, similar = self.nearest(features, tf_idf(features, counts, self.idf))
        x = self.slope * _logit(np.array([self.vote(found, similar)]))[0] + self.shift
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30)))), found


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def tf_idf(features: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(np.maximum(counts, 1))) * idf[features] if len(features) else np.zeros(0)
    norm = np.sqrt((value * value).sum())
    return value / norm if norm else value


def _examples(docs: DataFrame, labels: DataFrame, limit: int) -> tuple[DataFrame, dict[int, int]]:
    """Distinct texts of the sampled training rows (doc_id, text, toxic), and the training rows of each class."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    usable = usable.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    usable = materialize(usable, "training-labels")
    sizes = {r.toxic: r["count"] for r in usable.groupBy("toxic").count().collect()}
    chosen = [usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit) for c in (0, 1)]
    # At most twice ``limit`` rows of two numbers: the bound of the broadcast.
    ids = materialize(chosen[0].union(chosen[1]), "example-ids")
    rows = docs.join(F.broadcast(ids), "doc_id").groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    return materialize(rows, "examples"), sizes


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = EXAMPLES, n_features: int | None = None) -> tuple[Model | None, DataFrame | None]:
    """The model, and the feature vectors of all rows (written); None if there is no usable example.

    ``labels`` has doc_id and toxic (0 or 1; other values are not used, of
    repeated rows the larger counts). Rows held out by their id are not read.
    Every feature that tells the classes apart is used; ``n_features`` keeps only the best.
    """
    narrow = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    examples, sizes = _examples(narrow, labels, limit)
    n = {r.toxic: r["count"] for r in examples.groupBy("toxic").count().collect()}
    if not n:
        return None, None
    shares = examples.repartition(F.xxhash64("text")).mapInArrow(_class_counts, "feature bigint, level int, n_toxic bigint, n_clean bigint")
    both = shares.groupBy("feature", "level").agg(F.sum("n_toxic").alias("t"), F.sum("n_clean").alias("c"))
    n_toxic, n_clean = float(n.get(1, 0)), float(n.get(0, 0))
    p_toxic, p_clean = F.col("t") / max(n_toxic, 1.0), F.col("c") / max(n_clean, 1.0)
    pooled = (F.col("t") + F.col("c")) / (n_toxic + n_clean)
    telling = (p_toxic - p_clean) ** 2 / (pooled * (1.0 - pooled) + 1e-9)
    lift = p_toxic * max(n_clean, 1.0) >= MIN_LIFT * (F.col("c") + 0.5)
    # As many as a bounded number of examples has.
    best = both.filter((F.col("t") >= MIN_TEXTS) & lift)
    if n_features is not None:
        best = best.orderBy(telling.desc(), "feature", "level").limit(n_features)
    chosen = Chosen.of([(r.feature, r.level) for r in best.select("feature", "level").collect()])

    vectors = materialize(_vectors(narrow, chosen, "doc_id", "bigint"), "vectors")
    counted = {r.f: r["count"] for r in vectors.select(F.explode("features").alias("f")).groupBy("f").count().collect()}
    df = np.array([counted.get(i, 0) for i in range(chosen.size)], float)
    idf = np.log((vectors.count() + 1) / (df + 1)) + 1

    rows = _vectors(examples.withColumn("example", F.struct("doc_id", "toxic")), chosen, "example", "struct<doc_id:bigint,toxic:int>").collect()
    rows.sort(key=lambda r: (r.example.doc_id, r.example.toxic))
    toxic = np.array([r.example.toxic for r in rows])
    stands = {c: sizes.get(c, 0) / n[c] for c in n}
    smallest = min(stands.values())
    prior = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1)
    model = Model.build(
        idf, np.array([r.example.doc_id for r in rows]), toxic, np.array([stands[t] / smallest for t in toxic.tolist()]),
        [(np.array(r.features, np.int64), np.array(r.counts, np.int64)) for r in rows], prior,
    )
    return model, vectors


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = EXAMPLES, n_features: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted``, ``evidence`` (ids of the nearest examples).

    A text without any chosen feature, null and empty ones too, has no nearest
    example and gets the calibrated prior. Equal texts get equal scores,
    whatever their ids; a null id counts as held out. Without a usable label
    every score is 0. Other columns are not read.
    """
    model, vectors = train(docs, labels, id_column, text_column, limit, n_features)
    schema = "doc_id bigint, score double, evidence array<bigint>"
    if model is None:
        found = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.lit(0.0).alias("score"), F.array().cast("array<bigint>").alias("evidence"))
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value
            nothing = model.score(np.zeros(0, np.int64), np.zeros(0, np.int64))
            for batch in batches:
                first = np.concatenate(([0], np.cumsum([len(x) for x in batch.column("features").to_pylist()])))
                features, counts = (np.asarray(batch.column(c).flatten()).astype(np.int64) for c in ("features", "counts"))
                out = [model.score(features[a:b], counts[a:b]) if b > a else nothing for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array([s for s, _ in out], pa.float64()), pa.array([model.ids[e].tolist() for _, e in out], pa.list_(pa.int64()))],
                    names=["doc_id", "score", "evidence"],
                )

        found = vectors.mapInArrow(rows, schema)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


NAME = "op7_toxicity"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Score and nearest labelled examples of every document."""
    return score(table(spark, folder, "documents"), table(spark, folder, "labels"))


# A fitted model has no SQL form; tests check the search by brute force and the scores on held-out rows.
ORACLE_SQL = None
