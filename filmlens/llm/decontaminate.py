"""Benchmark decontamination by the q-gram lemma and banded alignment.

A passage of length m and a substring of a document at edit distance k or less
share at least (m - q + 1) - k q of the passage's q-grams, and the hits lie on
diagonals (document place less passage place) at most k apart. Diagonals are
cut into bands that overlap by k, so one band holds all hits of a leak. Bands
with enough shared q-grams are retained, and each is verified by an alignment
within the band: the least edit distance of the passage to any substring there.

The benchmark is a stated query set. Spark cuts its items into passages and
writes them; they go to the tasks in blocks of bounded size, one after another:
each block's index is sent out, the documents are scanned once with it, what is
found is written, and the index is released before the next block. So driver
and workers hold one block however large the benchmark is. Documents are not
moved; only the hashes of texts with leaks meet them again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import table
from filmlens.llm.tokens import _power, prefix_sums, slices
from filmlens.sources.staging import materialize

Q = 10
ERROR_PCT = 8
"""Edits allowed per hundred characters of a passage."""
SEGMENT = 80
"""Items of more than one and a half times this length are searched in overlapping passages of it."""
BAND = 16
BLOCK_CHARS = 1 << 21
"""Characters of passages that are sent to the tasks at once."""
_TABLE_BITS = 22
_FAR = 1 << 20
_ITEM = ["item_id", "item_hash"]
_LEAK = "doc_id bigint, text_hash string, item_id bigint, item_hash bigint, edits int"


def normalise(text: str) -> str:
    return " ".join(text.lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _qgrams(codes: np.ndarray) -> np.ndarray:
    """A hash for each place at which Q characters start."""
    n = len(codes) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(codes.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(1))
    value = (sums[Q:] - sums[:-Q]) * _power("down", len(sums))[:n]
    return value ^ (value >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)


def passages(text: str) -> list[str]:
    """The pieces of a normalised item that are searched."""
    if len(text) <= SEGMENT * 3 // 2:
        return [text]
    starts = list(range(0, len(text) - SEGMENT, SEGMENT // 2)) + [len(text) - SEGMENT]
    return [text[s : s + SEGMENT] for s in starts]


def budget(length: int) -> int:
    """Edits allowed in a passage; as many as leave the lemma a shared q-gram to ask for."""
    return max(0, min(length * ERROR_PCT // 100, (length - Q) // Q))


@dataclass
class Index:
    """The q-grams of one block of passages, sorted by hash."""

    item: list[tuple[int | None, int | None]]
    codes: list[np.ndarray]
    edits: np.ndarray
    need: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    passage: np.ndarray
    place: np.ndarray
    seen: np.ndarray

    @classmethod
    def build(cls, parts: list[tuple[tuple[int | None, int | None], np.ndarray]]) -> Index:
        lengths = np.array([len(c) for _, c in parts])
        edits = np.array([budget(n) for n in lengths])
        grams = [_qgrams(c) for _, c in parts]
        owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g), dtype=np.int32) for g in grams])
        values = np.concatenate(grams)
        order = np.argsort(values, kind="stable")
        hashes, first = np.unique(values[order], return_index=True)
        seen = np.zeros(1 << _TABLE_BITS, bool)
        seen[hashes >> np.uint64(64 - _TABLE_BITS)] = True
        return cls(
            [i for i, _ in parts], [c for _, c in parts], edits, np.maximum(lengths - Q + 1 - Q * edits, 1),
            hashes, np.append(first, len(values)), owner[order], place[order], seen,
        )

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the text, passages and places of the passages of all equal q-grams."""
        at = np.flatnonzero(self.seen[grams >> np.uint64(64 - _TABLE_BITS)])
        k = np.searchsorted(self.hashes, grams[at])
        k[k == len(self.hashes)] = 0
        same = self.hashes[k] == grams[at]
        at, k = at[same], k[same]
        n = self.first[k + 1] - self.first[k]
        total = np.concatenate(([0], np.cumsum(n)))
        entry = np.arange(total[-1]) - np.repeat(total[:-1] - self.first[k], n)
        return np.repeat(at, n), self.passage[entry].astype(np.int64), self.place[entry].astype(np.int64)


def banded_distance(passage: np.ndarray, regions: np.ndarray, edits: int) -> np.ndarray:
    """Least edit distance of the passage to a substring of each region that starts within its band.

    ``regions`` has one row per candidate: character i of the passage is compared
    with columns i to i + width - 1; 0 stands for no character.
    """
    m, width = len(passage), regions.shape[1] - len(passage) + 1
    far = np.int32(_FAR)
    steps = np.arange(width, dtype=np.int32)
    row = np.zeros((len(regions), width), np.int32)
    for i in range(m):
        window = regions[:, i : i + width]
        cost = np.where((window == passage[i]), 0, 1).astype(np.int32)
        best = row + cost
        best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)  # a passage character left out
        # A text character left out: along the row, one more for each step.
        row = np.minimum.accumulate(best - steps, axis=1) + steps
    row[row > edits] = far
    return row.min(axis=1)


def _found(index: Index, texts: list[str]) -> list[dict[tuple[int | None, int | None], int]]:
    """For each normalised text, the items in it, each with the least edits of its passages."""
    found: list[dict[tuple[int | None, int | None], int]] = [{} for _ in texts]
    gap = "\x00" * (SEGMENT * 3)
    joined = gap.join(["", *texts, ""])
    codes = _codes(joined)
    at, passage, place = index.hits(_qgrams(codes))
    if not len(at):
        return found
    edits = index.edits[passage]
    diagonal = at - place
    band = diagonal // BAND
    again = diagonal % BAND <= edits
    n_bands = len(codes) // BAND + 2
    key = np.concatenate([passage * n_bands + band, (passage * n_bands + band - 1)[again]])
    key, counts = np.unique(key[key >= 0], return_counts=True)
    owner = key // n_bands
    key, owner = key[counts >= index.need[owner]], owner[counts >= index.need[owner]]
    if not len(key):
        return found
    starts = np.concatenate(([0], np.cumsum([len(t) + len(gap) for t in texts]))) + len(gap)
    for p in np.unique(owner):
        k, m = int(index.edits[p]), len(index.codes[p])
        low = (key[owner == p] % n_bands) * BAND - k
        width = BAND + 3 * k + 1
        place = low[:, None] + np.arange(m + width - 1)
        inside = (place >= 0) & (place < len(codes))
        regions = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], 0)
        distance = banded_distance(index.codes[p], regions, k)
        # The last diagonal of a band lies in its text or in the gap behind it; the first may lie in the gap before.
        text = np.searchsorted(starts, low + k + BAND + k, side="right") - 1
        for t, d in zip(text, distance, strict=True):
            if d <= k:
                found[t][index.item[p]] = min(int(d), found[t].get(index.item[p], k))
    return found


def cut_benchmark(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """Rows ``item_id``, ``item_hash``, ``passage`` of all items (written); ``item_hash`` stands for a missing id.

    Items without text, or with fewer than ``Q`` characters, cannot be told from
    chance and give no row. Repeated items count once; items without an id are
    told apart by their texts.
    """
    item, text = F.col(f"`{item_column}`").cast("bigint"), F.col(f"`{text_column}`")
    rows = benchmark.select(item.alias("item_id"), F.when(item.isNull(), F.xxhash64(text)).alias("item_hash"), text.alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, raw in slices(batches):
            pieces = [[p for p in passages(normalise(t.decode("utf-8"))) if len(p) >= Q] for t in raw]
            at = pa.array([r for r, some in enumerate(pieces) for _ in some], pa.int64())
            flat = pa.array([p for some in pieces for p in some], pa.string())
            yield pa.RecordBatch.from_arrays([*(part.column(c).take(at) for c in _ITEM), flat], names=[*_ITEM, "passage"])

    cuts = rows.filter("text IS NOT NULL").distinct().mapInArrow(cut, "item_id bigint, item_hash bigint, passage string")
    return materialize(cuts.distinct(), "leak-passages")


def blocks(cuts: DataFrame, size: int = BLOCK_CHARS) -> Iterator[Index]:
    """Indexes of about ``size`` characters of passages each; rows are dealt by hash, so an item of any length is spread."""
    total = cuts.agg(F.sum(F.char_length("passage"))).first()[0] or 0
    n = -(-total // size)
    for b in range(n):
        rows = cuts.filter(F.pmod(F.xxhash64(*cuts.columns), F.lit(n)) == b).collect()
        if rows:
            yield Index.build([((r.item_id, r.item_hash), _codes(r.passage)) for r in rows])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows ``doc_id``, ``text_hash`` (md5), ``item_id``, ``item_hash``, ``edits`` (written): every document and benchmark item that is found in it.

    ``item_hash`` is null but for items without an id. Null and empty texts hold
    nothing; null ids are allowed; rows that repeat both id and text, and items
    found in several places, give one row with the least edits. Very long texts
    are searched whole. Either table may be empty. Other columns are not read,
    whatever their names.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_column}`")
    narrow = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.md5(text).alias("text_hash"), text.alias("text"))
    least = lambda df: df.groupBy("doc_id", "text_hash", *_ITEM).agg(F.min("edits").alias("edits"))
    parts = []
    for index in blocks(cut_benchmark(benchmark), block_chars):
        shared = spark.sparkContext.broadcast(index)

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, raw in slices(batches):
                found = _found(shared.value, [normalise(t.decode("utf-8")) if t else "" for t in raw])
                at = pa.array([r for r, items in enumerate(found) for _ in items], pa.int64())
                hit = [(*item, edits) for items in found for item, edits in items.items()]
                columns = [pa.array([h[i] for h in hit], kind) for i, kind in enumerate([pa.int64(), pa.int64(), pa.int32()])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(at), part.column("text_hash").take(at), *columns], names=["doc_id", "text_hash", *_ITEM, "edits"])

        parts.append(materialize(least(narrow.mapInArrow(rows, _LEAK)), "leaks"))
        shared.destroy()
    if len(parts) > 1:
        return materialize(least(reduce(DataFrame.union, parts)), "leaks")
    return parts[0] if parts else spark.createDataFrame([], _LEAK)


def report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``doc_id``, ``contaminated``, ``n_items``, ``item_ids`` (ascending), ``edits`` (the least).

    Null and empty texts hold nothing; rows that repeat an id are judged by
    their own texts, and null ids are allowed. Items without an id are counted
    in ``n_items`` and have no place in ``item_ids``. Other columns are not
    read. With an empty benchmark, or one without usable items, nothing is
    contaminated.
    """
    leaks = find_leaks(docs, benchmark, id_column, text_column, block_chars)
    ids, unnamed = F.array_sort(F.collect_set("item_id")), F.size(F.collect_set("item_hash"))
    judged = materialize(leaks.groupBy("text_hash").agg(ids.alias("ids"), unnamed.alias("unnamed"), F.min("edits").alias("edits")), "leaks-by-text")
    ours = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.md5(F.col(f"`{text_column}`")).alias("text_hash"))
    ids = F.coalesce("ids", F.array().cast("array<bigint>"))
    n = (F.size(ids) + F.coalesce("unnamed", F.lit(0))).cast("bigint")
    return ours.join(judged, "text_hash", "left").select("doc_id", (n > 0).alias("contaminated"), n.alias("n_items"), ids.alias("item_ids"), "edits")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with their columns unchanged.

    Rows with null or empty texts stay; rows that repeat an id are judged by
    their own texts, and copies of a text go or stay together. Very long texts
    are searched whole. With an empty benchmark all rows stay. Columns may have
    any names.
    """
    text = F.col(f"`{text_column}`")
    leaks = find_leaks(docs.select(F.lit(0).alias("doc_id"), text.alias("text")), benchmark, block_chars=block_chars)
    gone = materialize(leaks.select("text_hash").distinct(), "leaking-texts")
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("row"), F.md5(text).alias("key"))
    left = packed.join(gone, F.col("key") == F.col("text_hash"), "left_anti")
    return left.select(*[F.col("row").getField(n).alias(n) for n in docs.columns])


NAME = "op3_decontaminate"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The benchmark items found in every document."""
    return report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


# Edit distances over all substrings have no practical SQL form; tests hold the query against brute force.
ORACLE_SQL = None
