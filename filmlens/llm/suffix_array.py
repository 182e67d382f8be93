"""Substring dedup on bytes by longest-previous-factor arrays.

Suffixes are put in order by their first 200 bytes, in groups that share the
anchor of their windows. The previous and next smaller places in suffix order
give every suffix its longest previous factor, the previous and next larger ones
its mirror, the longest next factor; both are cut at 200 bytes, and a string of
200 bytes has a copy if they reach that. By default later copies go and the
first one stays; ``keep_first=False`` removes every occurrence of what occurs
twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm import repeats
from filmlens.llm.common import table
from filmlens.llm.suffixes import Suffixes, doubled, previous_smaller
from filmlens.llm.tokens import mix64, slices

WINDOW = 200
GRAM = 40

_BYTES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def _split(texts: Sequence[bytes | None]) -> tuple[np.ndarray, np.ndarray, Callable[[int, int], bytes]]:
    whole = b"".join(t or b"" for t in texts)
    first = np.concatenate(([0], np.cumsum([len(t or b"") for t in texts]))).astype(np.int64)
    return _BYTES[np.frombuffer(whole, np.uint8)], first, lambda a, b: whole[a:b]


def byte_suffixes(contents: list[bytes]) -> Suffixes:
    data = np.frombuffer(b"".join(contents), np.uint8)
    numbers, short = data.astype(np.uint64), []
    for length in (1, 2, 4):
        short.append((length, numbers))
        numbers = numbers[:-length] << np.uint64(8 * length) | numbers[length:]
    levels, rank = doubled(np.unique(numbers, return_inverse=True)[1], WINDOW, known=8)
    return Suffixes.build(short + levels, rank, [len(c) for c in contents], WINDOW)


def longest_factors(suffixes: Suffixes, later: bool = False) -> np.ndarray:
    """For each window, the longest start of it that also starts at an earlier place (``later``: at a later one).

    In suffix order no earlier suffix shares more with a suffix than the nearest
    earlier one on either side, the previous and the next smaller place.
    """
    order, n = suffixes.order, len(suffixes.order)
    places = -order if later else order
    before = previous_smaller(places)
    after = n - 1 - previous_smaller(places[::-1])[::-1]
    out = np.zeros(n, np.int64)
    for found in (before, after):
        own = np.flatnonzero((found >= 0) & (found < n))
        out[order[own]] = np.maximum(out[order[own]], suffixes.shared(order[own], order[found[own]]))
    return out


def _mark(contents: list[bytes], mode: str) -> tuple[np.ndarray, np.ndarray]:
    suffixes = byte_suffixes(contents)
    marked = longest_factors(suffixes) >= WINDOW
    if mode == repeats.ANY:
        marked |= longest_factors(suffixes, later=True) >= WINDOW
    return marked, suffixes.first


KIND = repeats.Kind(WINDOW, GRAM, _split, _mark)


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in slices(batches):
        sizes, removed, spans, kept = [], [], [], []
        for text, marks in zip(texts, part.column("marks").to_pylist(), strict=True):
            data = text or b""
            gone = repeats.covered(marks, WINDOW, len(data)) if marks else np.zeros(len(data), bool)
            edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
            sizes.append(len(data))
            removed.append(int(gone.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[0::2], edges[1::2], strict=True)])
            kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )


def dedupe(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_first: bool = True) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (removed runs of bytes), and ``kept`` (bytes).

    A byte goes if it lies in a string of 200 bytes that also starts earlier
    (``keep_first``) or anywhere else. Null texts count as empty. Repeated rows
    are one document and lose the same bytes; rows with one id and different
    texts are different documents, ordered by a hash of their texts, a missing
    id comes first. Other columns are not read.
    """
    marked = repeats.with_marks(repeats.narrow(docs, id_column, text_column), KIND, repeats.LATER if keep_first else repeats.ANY)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"
    return marked.mapInArrow(_kept_rows, schema)


NAME = "op9_suffix_array_dedup"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document once all repeated strings are gone, by digest."""
    kept = dedupe(table(spark, folder, "documents"), keep_first=False)
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# Bytes are written as two hexadecimal digits each.
ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents
), windows AS (
  SELECT doc_id, p, md5(substr(h, CAST(2 * p + 1 AS BIGINT), 400)) AS k FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 199, 0))) AS p FROM d)
), twice AS (
  SELECT doc_id, p FROM windows QUALIFY count(*) OVER (PARTITION BY k) > 1
), starts AS (
  SELECT doc_id, p, CASE WHEN p - lag(p) OVER o <= 200 THEN 0 ELSE 1 END AS new FROM twice WINDOW o AS (PARTITION BY doc_id ORDER BY p)
), runs AS (
  SELECT doc_id, min(p) AS a, max(p) + 200 AS b FROM (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM starts) GROUP BY doc_id, r
), pieces AS (
  SELECT doc_id, coalesce(lag(b) OVER o, 0) AS a, a AS b FROM runs WINDOW o AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT d.doc_id, coalesce(max(r.b), 0), any_value(d.n) FROM d LEFT JOIN runs r USING (doc_id) GROUP BY d.doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS h FROM pieces JOIN d USING (doc_id) GROUP BY doc_id
), counted AS (
  SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.h, ''))) AS kept_sha256
FROM d LEFT JOIN kept k USING (doc_id) LEFT JOIN counted USING (doc_id)
"""
