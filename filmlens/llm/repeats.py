"""Windows that occur more than once in a table of texts, found exactly and without sending all windows.

Every window of ``width`` symbols has an anchor: the place of its least gram
hash. Equal windows have equal anchors at equal places, so only windows around
an anchor that occurs twice can be repeated. Consecutive windows with one
anchor form a run, and a run's region is all they cover; a run is one row.

* An anchor whose runs all have one region (by one 64-bit hash of the region,
  beside that of the anchor's gram) needs no more: copies of a text, however
  many, are settled by aggregates.
* Other anchors keep their distinct regions, each from its first occurrence
  only. These are the groups that a suffix structure is built on: the anchor is
  the prefix that groups suffixes, and ``mark`` (given by the caller) builds the
  structure of a batch of groups of bounded size.
* Where an anchor has too many distinct regions for one task, the prefix is
  lengthened to the whole window: one row per window, counted by aggregates.

Joins are on hashes of content, with plain keys that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlens.llm.tokens import _power, mix64, prefix_sums, range_hash, slices
from filmlens.sources.staging import materialize

MAX_REGIONS = 2000
"""Distinct regions of one anchor that are handled in one task."""
BATCH_SYMBOLS = 200_000

LATER = "later"
"""A window is marked if its content also starts earlier."""
ANY = "any"
"""A window is marked if its content also starts anywhere else."""


@dataclass(frozen=True)
class Kind:
    """How texts become symbols, and what finds their repeats.

    ``split`` gives the symbols of many texts, each text's first symbol (and the
    end), and a function that cuts the bytes of a range of symbols. ``mark``
    builds a suffix structure on contents in the order of their texts, and gives
    which of their windows are marked, and each content's first window (and the
    end).
    """

    width: int
    gram: int
    split: Callable[[Sequence[bytes | None]], tuple[np.ndarray, np.ndarray, Callable[[int, int], bytes]]]
    mark: Callable[[list[bytes], str], tuple[np.ndarray, np.ndarray]]


def _anchors(values: np.ndarray, span: int) -> np.ndarray:
    """For each place, that of the least value among the ``span`` from there on; the first of equal ones."""
    best, at, reach = values, np.arange(len(values)), 1

    def joined(shift: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = best[: len(best) - shift], best[shift:]
        left = a <= b
        return np.where(left, a, b), np.where(left, at[: len(at) - shift], at[shift:])

    while reach * 2 <= span:
        best, at = joined(reach)
        reach *= 2
    if span > reach:
        best, at = joined(span - reach)
    return at


def runs(kind: Kind, texts: Sequence[bytes | None]) -> dict[str, np.ndarray]:
    """The runs of the texts: text, start (first window), n (windows), anchor, region, offset of the anchor."""
    symbols, first, _ = kind.split(texts)
    n = len(symbols)
    empty = {k: np.zeros(0, np.int64) for k in ("text", "start", "n", "anchor", "region")}
    if n < kind.width:
        return empty
    sums = prefix_sums(symbols)
    places = np.arange(n - kind.gram + 1)
    grams = mix64((sums[kind.gram :] - sums[: -kind.gram]) * _power("down", len(sums))[: len(places)])
    at = _anchors(grams, kind.width - kind.gram + 1)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))[: len(at)]
    valid = np.arange(len(at)) + kind.width <= first[owner + 1]
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (owner[1:] != owner[:-1]) | ~valid[:-1])) & valid
    start = np.flatnonzero(new)
    if not len(start):
        return empty
    last = np.concatenate((start[1:], [len(at)]))
    # Invalid windows only stand at the end of a text, so they follow its last run.
    inside = np.concatenate(([0], np.cumsum(valid)))
    count = inside[last] - inside[start]
    anchor = at[start]
    again = prefix_sums(mix64(symbols + np.uint64(0x632BE59BD9B4E019)))
    region = mix64(range_hash(again, start, start + count + kind.width - 1) ^ mix64((anchor - start).astype(np.uint64) * np.uint64(0x9E3779B1) + count.astype(np.uint64)))
    text = owner[start]
    return {"text": text, "start": start - first[text], "n": count, "anchor": grams[anchor].view(np.int64), "region": region.view(np.int64)}


def _run_rows(kind: Kind) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            found = runs(kind, texts)
            at = pa.array(found["text"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(found["anchor"]), pa.array(found["region"]), part.column("doc_id").take(at), part.column("text_hash").take(at), *(pa.array(found[c].astype(np.int32)) for c in ("start", "n"))],
                names=["anchor", "region", "doc_id", "text_hash", "start", "n"],
            )

    return rows


def _cut_rows(kind: Kind) -> Callable:
    """Contents of the listed regions of each text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            _, first, cut = kind.split(texts)
            for i, wanted in enumerate(part.column("wanted").to_pylist()):
                content = [cut(first[i] + w["start"], first[i] + w["start"] + w["n"] + kind.width - 1) for w in wanted]
                k = pa.array(np.full(len(wanted), i))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([w["anchor"] for w in wanted], pa.int64()), pa.array([w["region"] for w in wanted], pa.int64()),
                        part.column("doc_id").take(k), part.column("text_hash").take(k),
                        pa.array([w["start"] for w in wanted], pa.int32()), pa.array([w["single"] for w in wanted], pa.bool_()), pa.array(content, pa.binary()),
                    ],
                    names=["anchor", "region", "doc_id", "text_hash", "start", "single", "content"],
                )

    return rows


_MARKS = "doc_id bigint, text_hash bigint, start int, n int"


def _group_rows(kind: Kind, mode: str) -> Callable:
    """Regions, sorted by anchor, in batches of whole groups; marked windows leave as intervals."""

    def solve(rows: list) -> pa.RecordBatch:
        # Text order inside the batch; a missing id comes first.
        order = sorted(range(len(rows)), key=lambda i: (rows[i][1] is not None, rows[i][1] or 0, rows[i][2], rows[i][3]))
        rows = [rows[i] for i in order]
        marked, first = kind.mark([r[5] for r in rows], mode)
        owner = np.repeat(np.arange(len(rows)), np.diff(first))
        if mode == ANY:
            marked &= np.array([r[4] for r in rows], bool)[owner]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))) | np.concatenate(([False], (owner[1:] != owner[:-1]) & marked[1:] & marked[:-1], [False])))
        pieces = [(a, b) for a, b in zip(edge[:-1], edge[1:], strict=True) if marked[a]]
        k = [int(owner[a]) for a, _ in pieces]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][1] for i in k], pa.int64()), pa.array([rows[i][2] for i in k], pa.int64()),
                pa.array([rows[i][3] + int(a - first[i]) for i, (a, _) in zip(k, pieces, strict=True)], pa.int32()),
                pa.array([int(b - a) for a, b in pieces], pa.int32()),
            ],
            names=["doc_id", "text_hash", "start", "n"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list = []
        held, group = 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "doc_id", "text_hash", "start", "single", "content")]
            for row in zip(*columns, strict=True):
                if row[0] != group and held >= BATCH_SYMBOLS:
                    yield solve(waiting)
                    waiting, held = [], 0
                group = row[0]
                waiting.append(row)
                held += len(row[5])
        if waiting:
            yield solve(waiting)

    return rows


def _window_rows(kind: Kind) -> Callable:
    """One row per window of a region, by two hashes of its content."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, contents in slices(batches, "content"):
            symbols, first, _ = kind.split(contents)
            counts = np.maximum(np.diff(first) - kind.width + 1, 0)
            owner = np.repeat(np.arange(len(contents)), counts)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            at = first[owner] + inside
            keys = [mix64(range_hash(prefix_sums(s), at, at + kind.width)).view(np.int64) for s in (symbols, mix64(symbols + np.uint64(0x632BE59BD9B4E019)))]
            take = pa.array(owner)
            start = np.asarray(part.column("start"))[owner] + inside
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, keys), part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(start.astype(np.int32)), part.column("single").take(take)],
                names=["k1", "k2", "doc_id", "text_hash", "start", "single"],
            )

    return rows


def marked_starts(docs: DataFrame, kind: Kind, mode: str) -> DataFrame:
    """``doc_id``, ``text_hash``, ``marks``: for each text with marked windows, their starts as a list of (start, n).

    ``docs`` has doc_id, text and text_hash. Rows with the same id and text are
    one text; the order of texts is by id (missing first), then by hash.
    """
    rows = docs.filter("text IS NOT NULL").mapInArrow(_run_rows(kind), "anchor bigint, region bigint, doc_id bigint, text_hash bigint, start int, n int")
    # Runs are read twice: written, they need not be found in the texts again.
    rows = materialize(rows, "runs")
    place = F.struct("doc_id", "text_hash", "start")
    anchors = rows.groupBy("anchor").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.min("region").alias("r0"), F.max("region").alias("r1"))
    # Structs with a missing id compare as equal only if all fields are: no null-safe test is needed on min and max.
    repeated = anchors.filter(~F.col("first").eqNullSafe(F.col("last"))).select("anchor", "first", (F.col("r0") != F.col("r1")).alias("open"))
    # Written first, so that both sides of the join have a shuffle of their own and a hot anchor's rows can be split.
    repeated = materialize(repeated, "repeated-anchors")
    hits = rows.join(repeated, "anchor").select("anchor", "region", "doc_id", "text_hash", "start", "n", "open", place.eqNullSafe(F.col("first")).alias("is_first"))
    hits = materialize(hits, "repeated-runs")
    closed = hits.filter("NOT open") if mode == ANY else hits.filter("NOT open AND NOT is_first")
    found = closed.select("doc_id", "text_hash", "start", "n")

    opened = hits.filter("open")
    regions = opened.groupBy("anchor", "region").agg(F.min(F.struct("doc_id", "text_hash", "start", "n")).alias("f"), F.max(F.struct("doc_id", "text_hash", "start", "n")).alias("l"))
    regions = materialize(regions.select("anchor", "region", "f", F.col("f").eqNullSafe(F.col("l")).alias("single")), "regions")
    # Further occurrences of a region, or all of it where any other one counts.
    several = regions.filter("NOT single").select("anchor", "region", "f")
    more = opened.join(several, ["anchor", "region"])
    if mode == LATER:
        more = more.filter(~F.struct("doc_id", "text_hash", "start", "n").eqNullSafe(F.col("f")))
    found = found.union(more.select("doc_id", "text_hash", "start", "n"))

    wanted = regions.groupBy(F.col("f.doc_id").alias("w_id"), F.col("f.text_hash").alias("w_hash")).agg(
        F.collect_list(F.struct("anchor", "region", F.col("f.start").alias("start"), F.col("f.n").alias("n"), "single")).alias("wanted")
    )
    same = docs["doc_id"].eqNullSafe(F.col("w_id")) & (docs["text_hash"] == F.col("w_hash"))
    texts = docs.filter("text IS NOT NULL").join(wanted, same).select("doc_id", "text_hash", "text", "wanted")
    cut = texts.mapInArrow(_cut_rows(kind), "anchor bigint, region bigint, doc_id bigint, text_hash bigint, start int, single boolean, content binary")
    cut = materialize(cut.dropDuplicates(["anchor", "region"]), "region-contents")
    sizes = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("size"))
    large = sizes.filter(F.col("size") > MAX_REGIONS).select("anchor")
    grouped = cut.join(large, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    found = found.union(grouped.mapInArrow(_group_rows(kind, mode), _MARKS))
    windows = cut.join(large, "anchor", "left_semi").mapInArrow(_window_rows(kind), "k1 bigint, k2 bigint, doc_id bigint, text_hash bigint, start int, single boolean")
    counted = windows.groupBy("k1", "k2").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(~F.col("first").eqNullSafe(F.col("last")))
    again = windows.join(counted, ["k1", "k2"])
    again = again.filter("single") if mode == ANY else again.filter(~place.eqNullSafe(F.col("first")))
    found = found.union(again.select("doc_id", "text_hash", "start", F.lit(1).alias("n")))
    return found.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("marks"))


def covered(marks: Sequence[dict], width: int, size: int) -> np.ndarray:
    """Which of the ``size`` symbols of a text lie in a marked window."""
    change = np.zeros(size + 1, np.int64)
    for m in marks:
        change[m["start"]] += 1
        change[m["start"] + m["n"] + width - 1] -= 1
    return np.cumsum(change[:-1]) > 0


def with_marks(docs: DataFrame, kind: Kind, mode: str) -> DataFrame:
    """``docs`` (doc_id, text, text_hash) with ``marks``, null where there are none."""
    marks = materialize(marked_starts(docs, kind, mode), "marks")
    found = marks.select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"), "marks")
    same = docs["doc_id"].eqNullSafe(F.col("m_id")) & (docs["text_hash"] == F.col("m_hash"))
    return docs.join(found, same, "left").select("doc_id", "text", "marks")


def narrow(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(f"`{text_column}`")
    return docs.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
