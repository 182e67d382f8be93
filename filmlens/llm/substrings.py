"""Substring dedup on words by prefix-partitioned suffix trees.

Suffixes are grouped by a prefix: the gram of 6 words that anchors a window of
20. Groups that are small enough for one task are built as subtrees on their
distinct regions, as sorted leaves with the lengths that neighbours share; the
internal nodes at depth 20 are the maximal repeats of 20 words and more, cut at
that depth. A group too large gets the longest prefix, all 20 words, at which a
subtree is a single node whose leaves need only be counted. Every leaf but the
first of such a node, by document and place, is a copy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm import repeats
from filmlens.llm.common import table
from filmlens.llm.suffixes import Suffixes, doubled
from filmlens.llm.tokens import find_words, slices

WINDOW = 20
GRAM = 6


def _split(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray, Callable[[int, int], bytes]]:
    words = find_words(texts)
    data = words.data.tobytes()

    def cut(a: int, b: int) -> bytes:
        return b" ".join(data[s:e] for s, e in zip(words.start[a:b].tolist(), words.end[a:b].tolist(), strict=True))

    return words.hashes, words.first, cut


def deep_nodes(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """The subtree's internal nodes at full depth: first and last leaf of each, as places in suffix order.

    Neighbouring leaves hang below one such node if they share a whole window;
    a leaf that shares one with neither neighbour hangs below none.
    """
    order = suffixes.order
    joined = suffixes.shared(order[:-1], order[1:]) >= suffixes.depth
    edges = np.flatnonzero(np.diff(np.concatenate(([False], joined, [False])).astype(np.int8)))
    return edges[0::2], edges[1::2]


def _mark(contents: list[bytes], mode: str) -> tuple[np.ndarray, np.ndarray]:
    numbers: dict[bytes, int] = {}
    parts = [[numbers.setdefault(w, len(numbers)) for w in c.split(b" ")] for c in contents]
    levels, rank = doubled(np.array([x for p in parts for x in p], np.int64), WINDOW)
    suffixes = Suffixes.build(levels, rank, [len(p) for p in parts], WINDOW)
    first, last = deep_nodes(suffixes)
    # The leaves of a node stand in the order of their places: all but the first are copies.
    change = np.zeros(len(suffixes.order) + 1, np.int64)
    change[first + (mode == repeats.LATER)] += 1
    change[last + 1] -= 1
    marked = np.zeros(len(suffixes.order), bool)
    marked[suffixes.order] = np.cumsum(change[:-1]) > 0
    return marked, suffixes.first


KIND = repeats.Kind(WINDOW, GRAM, _split, _mark)


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        words = find_words(texts)
        data = words.data.tobytes()
        counts, removed, kept = words.counts, [], []
        for i, marks in enumerate(part.column("marks").to_pylist()):
            a, b = words.first[i], words.first[i + 1]
            stays = ~repeats.covered(marks, WINDOW, int(b - a)) if marks else np.ones(b - a, bool)
            at = a + np.flatnonzero(stays)
            kept.append(b" ".join(data[s:e] for s, e in zip(words.start[at].tolist(), words.end[at].tolist(), strict=True)).decode("utf-8"))
            removed.append(int(b - a) - len(at))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(counts), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"]
        )


def dedupe(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed``, and ``kept``, the words that stay, joined by spaces.

    A word goes if it lies in a window of 20 words that also starts earlier: in
    a document with a smaller id, or before in the same one. Null and empty
    texts have no words. Repeated rows are one document and lose the same words;
    rows with one id and different texts are ordered by a hash of their texts, a
    missing id comes first. Other columns are not read.
    """
    marked = repeats.with_marks(repeats.narrow(docs, id_column, text_column), KIND, repeats.LATER)
    return marked.mapInArrow(_kept_rows, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


NAME = "op2_substring_dedup"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document, by digest."""
    kept = dedupe(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS p
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
), windows AS (
  SELECT doc_id, p, string_agg(w, ' ') OVER o AS s, count(*) OVER o AS n
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), later AS (
  SELECT doc_id, p FROM windows WHERE n = 20 QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1
), gone AS (
  SELECT DISTINCT doc_id, p + k AS p FROM later, range(0, 20) t(k)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY p) AS s FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
), counts AS (
  SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.s, '')) AS kept_sha256
FROM documents d LEFT JOIN counts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
