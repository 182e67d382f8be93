"""Near-duplicates on word shingles by fast similarity sketches.

1. Every text becomes the set of its 5-word shingles (hashed to 64 bits) and a
   sketch of 128 coordinates. In round i each shingle is thrown into one bin by
   a hash of its own, with a value between i and i + 1; a bin keeps its least
   value. Most sets fill all bins in a few rounds; after 128 rounds, round
   128 + b throws everything into bin b, so every coordinate is filled. The
   share of equal coordinates estimates the similarity with concentration
   bounds as strong as those of independent MinHash values.
2. Texts with equal sets are one class; only classes go on.
3. Sketches are cut into 32 bands of 4; classes that share a band meet in a
   bucket. At similarity 0.75 all bands differ with probability 5e-6.
4. In a bucket, all classes are first compared with one centre: the class that
   shares the most bucket places over all bands, which in a group of copies is
   the one nearest to all. Pairs whose sketches agree in fewer than 70
   coordinates are dropped (at similarity 0.75, about 2e-7 of the pairs), the
   others are confirmed on the full sets. A centre's set is sent once per block
   of members.
5. What this links to one component is settled. In buckets that still hold
   several components, the classes outside the largest one meet the whole
   bucket, on the full sets, in blocks of bounded size: a task holds two blocks
   and gives back only a spanning forest of the links between them. No pairs
   are emitted, and none is left out.
6. Components by least labels over the confirmed links, in tables.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import table
from filmlens.llm.tokens import find_words, mix64, shingles, slices
from filmlens.sources.staging import materialize

SHINGLE = 5
PERCENT = 75
BINS = 128
BANDS = 32
ROWS = BINS // BANDS
MIN_EQUAL = 70
PAIRED = 4
"""A bucket of so few classes is settled by its pairs."""
BLOCK_CLASSES = 512
BLOCK_SHINGLES = 400_000
"""Most classes, and about the most shingles, of one side of a block."""
BLOCK = 256
"""Members that are compared with one copy of a centre's set."""

_ROUND = 0x2545F4914F6CDD1D
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketch(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of ``BINS`` values for each set; set d is ``hashes[first[d]:first[d + 1]]``."""
    sizes = np.diff(first)
    n = len(sizes)
    bins = np.full(n * BINS, _EMPTY, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    left, left_owner = hashes, owner
    for i in range(2 * BINS):
        if not len(left):
            break
        value = mix64(left ^ np.uint64((i + 1) * _ROUND % (1 << 64)))
        at = (value & np.uint64(BINS - 1)).astype(np.int64) if i < BINS else np.full(len(left), i - BINS)
        value = (value >> np.uint64(9)) | (np.uint64(i) << np.uint64(55))
        np.minimum.at(bins, left_owner * BINS + at, value)
        if i < 8 or i % 8 == 0:
            # Rounds come in order, so a filled bin keeps its value: full sets need no more rounds.
            open_sets = (bins.reshape(n, BINS) == _EMPTY).any(axis=1)
            keep = open_sets[left_owner]
            left, left_owner = left[keep], left_owner[keep]
    return bins.reshape(n, BINS)


def _distinct_sets(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    hashes, first = shingles(find_words(texts, lower=True), SHINGLE)
    sets = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else hashes), np.concatenate(([0], np.cumsum(sizes)))


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


_SKETCH_SCHEMA = "doc_id bigint, text_hash bigint, n_shingles bigint, class binary, bands array<bigint>, low binary"


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        hashes, first = _distinct_sets(texts)
        values = sketch(hashes, first)
        sizes = np.diff(first)
        banded = np.zeros((len(sizes), BANDS), np.uint64)
        for r in range(ROWS):
            banded = mix64(banded * np.uint64(3) + values[:, r::ROWS])
        banded = mix64(banded + np.arange(BANDS, dtype=np.uint64))
        bands = pa.ListArray.from_arrays(
            pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * BANDS), pa.array(banded.reshape(-1).view(np.int64))
        )
        low = values.astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("text_hash"),
                pa.array(sizes),
                pa.array([_digest(hashes[a:b]) if b > a else None for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                bands,
                pa.array([row.tobytes() for row in low], pa.binary()),
            ],
            names=["doc_id", "text_hash", "n_shingles", "class", "bands", "low"],
        )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        hashes, first = _distinct_sets(texts)
        parts = [hashes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([part.column("class"), pa.array(parts, pa.binary())], names=["class", "members"])


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one centre and block arrive together, the centre first; linked pairs leave."""
    group, centre = None, None
    for batch in batches:
        left, right = [], []
        rows = zip(
            batch.column("centre").to_pylist(), batch.column("block").to_pylist(), batch.column("member").to_pylist(),
            batch.column("members").to_pylist(), strict=True,
        )
        for c, block, member, values in rows:
            if member is None:
                group, centre = (c, block), np.frombuffer(values, np.uint64)
                continue
            assert group == (c, block), "a member without its centre"
            other = np.frombuffer(values, np.uint64)
            both = len(np.intersect1d(centre, other, assume_unique=True))
            if 100 * both >= PERCENT * (len(centre) + len(other) - both):
                left.append(c)
                right.append(member)
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])


def _text(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    # The hash names the text: rows that repeat an id are kept apart by it.
    text = F.col(f"`{text_column}`")
    return df.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough. ``sets``: class, members."""
    blocked = pairs.select(F.col("a").alias("centre"), F.col("b").alias("member"))
    counts = blocked.groupBy("centre").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    dealt = blocked.join(counts, "centre").select("centre", F.pmod(F.xxhash64("member"), blocks).cast("int").alias("block"), "member")
    centres = dealt.select("centre", "block").distinct()
    given = centres.join(sets, F.col("centre") == F.col("class")).select("centre", "block", F.lit(None).cast("binary").alias("member"), "members")
    members = dealt.join(sets, F.col("member") == F.col("class")).select("centre", "block", "member", "members")
    together = given.unionByName(members).repartition("centre", "block").sortWithinPartitions("centre", "block", "member")
    return together.mapInArrow(_linked, "a binary, b binary")


def components(links: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``node``, ``label``: the least node reachable over ``links`` (a, b); both binary or both numbers.

    Alternates two contractions until nothing changes: every node points its
    larger neighbours, then its smaller ones, to the least node it knows. The
    links of one node never meet in one task: minima are partial aggregates and
    the joins are plain ones, which adaptive execution splits.
    """
    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before, now = None, state(edges)
    while now != before:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        # Minima are written before they are joined: the join then has shuffles of its own, in which a hot node's rows are split.
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.distinct(), "links")
        small = large.join(materialize(large.groupBy("a").agg(F.min("b").alias("m")), "least"), "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        edges = materialize(small.filter("a <> b").distinct(), "links")
        before, now = now, state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _similar_sketches(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose sizes and sketches allow the similarity."""
    low = classes.select("class", "low", "n_shingles")
    joined = pairs.join(low.toDF("a", "low_a", "n_a"), "a").join(low.toDF("b", "low_b", "n_b"), "b")
    joined = joined.filter(F.col("n_a") * 100 >= F.col("n_b") * PERCENT).filter(F.col("n_b") * 100 >= F.col("n_a") * PERCENT)
    return joined.mapInArrow(_agreeing, "a binary, b binary")


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        def rows(name: str, batch: pa.RecordBatch = batch) -> np.ndarray:
            return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, BINS)

        equal = (rows("low_a") == rows("low_b")).sum(axis=1)
        keep = pa.array(equal >= MIN_EQUAL)
        yield batch.select(["a", "b"]).filter(keep)


def _open_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets with several components: bucket, class, n_shingles, label, ``open`` (outside the largest one, and not the centre)."""
    labelled = members.join(labels, F.col("class") == F.col("node"), "left").withColumn("label", F.coalesce("label", "class"))
    parts = labelled.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("size"), F.count_if(~F.col("done")).alias("waiting"))
    largest = parts.groupBy("bucket").agg(F.max(F.struct("size", "label", "waiting")).alias("main"), F.sum("waiting").alias("waiting"))
    state = largest.filter(F.col("waiting") > F.col("main.waiting")).select("bucket", F.col("main.label").alias("main"))
    return labelled.join(state, "bucket").select("bucket", "class", "n_shingles", "label", ((F.col("label") != F.col("main")) & ~F.col("done")).alias("open"))


def _block_links(live: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between the open classes and all classes of their buckets, as forests."""
    side = lambda column, what: F.ceil(F.greatest(F.sum(what) / BLOCK_SHINGLES, F.count_if(column) / BLOCK_CLASSES)).cast("int")
    counts = live.groupBy("bucket").agg(
        side(F.col("open"), F.when(F.col("open"), F.col("n_shingles")).otherwise(0)).alias("na"), side(F.lit(True), F.col("n_shingles")).alias("nb")
    )
    dealt = live.join(counts, "bucket").withColumn("h", F.xxhash64("class", "bucket"))
    columns = ["bucket", "a", "b", "side", "class", "label"]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = dealt.filter("open").select("bucket", F.pmod("h", "na").cast("int").alias("a"), every("nb").alias("b"), F.lit(0).alias("side"), "class", "label")
    right = dealt.select("bucket", every("na").alias("a"), F.pmod("h", "nb").cast("int").alias("b"), F.lit(1).alias("side"), "class", "label")
    rows = left.select(columns).union(right.select(columns)).join(sets, "class")
    together = rows.repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b", "side", "class")
    return together.select(*columns, "members").mapInArrow(_forests, "a binary, b binary").distinct()


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right set."""
    values = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (left, right)]
    owners = [np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (left, right)]
    both = np.intersect1d(values[0], values[1])
    total = np.zeros((len(left), len(right)), np.float32)
    at = []
    for v, o in zip(values, owners, strict=True):
        k = np.searchsorted(both, v)
        k[k == len(both)] = 0
        same = both[k] == v if len(both) else np.zeros(len(v), bool)
        at.append((o[same], k[same]))
    for start in range(0, len(both), 4096):
        parts = []
        for (o, k), n in zip(at, total.shape, strict=True):
            here = (k >= start) & (k < start + 4096)
            part = np.zeros((n, min(4096, len(both) - start)), np.float32)
            part[o[here], k[here] - start] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    return np.rint(total).astype(np.int64)


def _forest(left: list, right: list) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between two blocks of (class, label, set)."""
    if not left or not right:
        return []
    shared = _shared_counts([s for _, _, s in left], [s for _, _, s in right])
    union = np.array([len(s) for _, _, s in left])[:, None] + np.array([len(s) for _, _, s in right]) - shared
    apart = np.array([x for _, x, _ in left], object)[:, None] != np.array([x for _, x, _ in right], object)
    linked = (100 * shared >= PERCENT * union) & apart.astype(bool)
    found: list[tuple[bytes, bytes]] = []
    fresh_left, fresh_right = linked.any(axis=1), linked.any(axis=0)
    while fresh_left.any():
        root = int(np.argmax(fresh_left))
        wave = np.zeros(len(left), bool)
        wave[root] = True
        while wave.any():
            fresh_left &= ~wave
            reached = linked[wave].any(axis=0) & fresh_right
            fresh_right &= ~reached
            found += [(left[root][0], right[j][0]) for j in np.flatnonzero(reached)]
            wave = linked[:, reached].any(axis=1) & fresh_left
            found += [(left[root][0], left[i][0]) for i in np.flatnonzero(wave)]
    return found


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one pair of blocks arrive together."""

    def out(sides: tuple[list, list]) -> pa.RecordBatch:
        pairs = _forest(*sides)
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in pairs], pa.binary()) for i in (0, 1)], names=["a", "b"])

    group, sides = None, ([], [])
    for batch in batches:
        for bucket, a, b, side, name, label, members in zip(*[column.to_pylist() for column in batch.columns], strict=True):
            if group != (bucket, a, b):
                yield out(sides)
                group, sides = (bucket, a, b), ([], [])
            sides[side].append((name, label, np.frombuffer(members, np.uint64)))
    yield out(sides)


def links(docs: DataFrame, sketched: DataFrame) -> DataFrame:
    """Classes that are linked to others, with the label of their component: node, label."""
    spark = docs.sparkSession
    classes = materialize(
        sketched.filter("n_shingles > 0").groupBy("class").agg(
            F.min(F.struct("text_hash", "doc_id")).alias("example"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"), F.first("low").alias("low")
        ),
        "classes",
    )
    banded = classes.select("class", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("class").alias("c0"), F.max("class").alias("c1")).filter("c0 <> c1").select("bucket")
    members = materialize(banded.join(shared, "bucket").join(classes.select("class", "n_shingles"), "class").select("bucket", "class", "n_shingles"), "bucket-members")
    if members.isEmpty():
        return spark.createDataFrame([], "node binary, label binary")

    # Sets of the classes that meet another one; the rest is settled already.
    met = members.select("class").distinct().join(classes.select("class", "example"), "class").select("class", "example.*")
    texts = docs.join(met, docs["doc_id"].eqNullSafe(met["doc_id"]) & (docs["text_hash"] == met["text_hash"]) & docs["text"].isNotNull())
    sets = texts.select("class", "text").dropDuplicates(["class"]).mapInArrow(_set_rows, "class binary, members binary")
    sets = materialize(sets, "class-sets")

    # Places shared over all bands; the class with the most is the centre of a bucket.
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    sized = members.join(sizes, "bucket")
    popular = sized.groupBy("class").agg(F.sum("n").alias("popularity"))
    scored = materialize(sized.join(popular, "class"), "bucket-members")
    centres = scored.groupBy("bucket").agg(F.max(F.struct("popularity", "class")).alias("c")).select("bucket", F.col("c.class").alias("a"))
    few = scored.filter(F.col("n") <= PAIRED).select("bucket", F.col("class").alias("a"))
    meeting = scored.select("bucket", F.col("class").alias("b")).join(centres.union(few).distinct(), "bucket").filter("a <> b")
    pairs = materialize(meeting.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    labels = components(_confirm(_similar_sketches(pairs, classes), sets))

    met_all = centres.withColumn("done", F.lit(True))
    waiting = scored.join(met_all.withColumnRenamed("a", "class"), ["bucket", "class"], "left")
    waiting = waiting.withColumn("done", F.coalesce("done", F.lit(False)) | (F.col("n") <= PAIRED))
    live = materialize(_open_buckets(waiting, labels), "open-buckets")
    if live.isEmpty():
        return labels
    return components(_block_links(live, sets).union(labels))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    ``component_id`` is the smallest id reachable over links of similarity 0.75
    and more, ``kept`` says whether it is the row's own. Texts without a word
    (null, empty, white space) are linked with nothing. Rows with one id and
    different texts are judged by their texts; a row without an id belongs to
    the component of its text and is kept only where no row of it has an id.
    Other columns are not read. An empty table gives an empty result.
    """
    found = _near_duplicates(_text(docs, id_column, text_column))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _near_duplicates(texts: DataFrame) -> DataFrame:
    sketched = materialize(texts.mapInArrow(_sketch_rows, _SKETCH_SCHEMA), "sketches")
    labels = links(texts, sketched)
    narrow = sketched.select("doc_id", "text_hash", "n_shingles", "class")
    of_class = narrow.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    labelled = of_class.join(labels, F.col("class") == F.col("node"), "left").select("class", "least", F.coalesce("label", "class").alias("component"))
    labelled = materialize(labelled, "class-components")
    least = materialize(labelled.groupBy("component").agg(F.min("least").alias("component_id")), "least-ids")
    ids = materialize(labelled.join(least, "component").select("class", "component_id"), "component-ids")
    alone: Column = F.col("class").isNull()
    return (
        narrow.join(ids, "class", "left")
        .withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, with its columns unchanged.

    Repeated rows of a document that stays all stay only if they differ; equal rows are one document.
    Null and empty texts are like no other and stay; null ids are allowed, and names may be anything.
    """
    texts = _text(docs, id_column, text_column)
    gone = materialize(_near_duplicates(texts).filter("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash")).distinct(), "near-copies")
    names = docs.columns
    # The caller's columns travel in one struct, so that no name can meet those of the other side.
    packed = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        F.col(f"`{id_column}`").cast("bigint").alias("id"),
        F.xxhash64(F.col(f"`{text_column}`")).alias("hash"),
    )
    left = packed.join(gone, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("hash") == F.col("gone_hash")), "left_anti")
    return left.select(*[F.col("row").getField(n).alias(n) for n in names])


NAME = "op6_minhash_near_dup"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The component of every document."""
    return near_duplicates(table(spark, folder, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i+4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""
