"""Quality rules as a short-circuit cascade, cheapest rejection first.

Each rule is a condition on features of the text: true rejects it. The cost of a
rule (seconds a row for it and the features it needs) and its selectivity (share
of rows rejected) are measured on a sample; rules then run in the order of
rejections per second. In the cascade a feature is bound where the first rule
needs it, behind all earlier rules, and is computed once and only for texts that
come so far. The verdict does not depend on the order, only the work does.

Everything is a built-in column expression: one scan, no shuffle.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import WORD, let, table, words
from filmlens.sources.staging import materialize

SAMPLE_ROWS = 2000
"""Rows on which costs and selectivities are estimated; they set the order of rules only."""

ROUNDS = 3
"""Timed runs of each rule."""

MIN_WORDS = 50
MAX_REPEAT_PCT = 50


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives a condition on the features named by ``needs`` (null counts as false)."""

    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Mapping[str, Column]], Column]


@dataclass(frozen=True)
class Estimate:
    rule: str
    seconds_per_row: float
    rejected_share: float

    @property
    def rank(self) -> float:
        """Rejections per second of work."""
        return self.rejected_share / max(self.seconds_per_row, 1e-12)


def _repeat_words(found: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the list."""
    last = F.size(found) - 2

    def covered(order: Column) -> Column:
        # Equal windows are neighbours in the sorted order.
        def twin(entry: Column, i: Column) -> Column:
            same = lambda k: F.coalesce(F.get(order, k)["h"] == entry["h"], F.lit(False))
            return same(i - 1) | same(i + 1)

        starts = F.sort_array(F.transform(F.filter(order, twin), lambda e: e["p"]))
        fresh = lambda acc, p: F.least(F.lit(3), p - acc["last"])
        return F.aggregate(
            starts,
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + fresh(acc, p)).alias("n")),
            lambda acc: acc["n"],
        )

    windows = F.transform(
        F.slice(found, 1, F.greatest(last, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(found, i + 1), F.get(found, i + 2)).alias("h"), i.alias("p")),
    )
    return let(F.sort_array(windows), covered)


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))


# How each feature follows from the text and from what is bound before it:
# "words" and "lines" are lists, all others are counts.
_FROM: dict[str, tuple[tuple[str, ...], Callable[[Column, Mapping[str, Column]], Column]]] = {
    "words": ((), lambda text, f: words(text)),
    "lines": ((), lambda text, f: _lines(text)),
    "n_words": (("words",), lambda text, f: F.size(f["words"]).cast("bigint")),
    "n_repeat_words": (("words",), lambda text, f: _repeat_words(f["words"]).cast("bigint")),
    "word_chars": ((), lambda text, f: F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint")),
    "n_symbols": ((), lambda text, f: F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint")),
    "n_lines": (("lines",), lambda text, f: F.size(f["lines"]).cast("bigint")),
    "n_dup_lines": (("lines",), lambda text, f: (F.size(f["lines"]) - F.size(F.array_distinct(f["lines"]))).cast("bigint")),
    "n_letters": ((), lambda text, f: F.regexp_count(text, F.lit(r"\p{L}")).cast("bigint")),
    "n_capitals": ((), lambda text, f: F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint")),
}
FEATURES = tuple(name for name in _FROM if name not in ("words", "lines"))
"""``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_lines`` (lines with a word), ``n_dup_lines``
(such lines equal to an earlier one), ``n_repeat_words`` (words in 3-word windows found twice or more, the first
occurrence included), ``n_letters``, ``n_capitals``."""

REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _bound(text: Column, needs: Sequence[str], bound: Mapping[str, Column], body: Callable[[Mapping[str, Column]], Column]) -> Column:
    """``body`` with the needed features bound, each computed once."""
    for name in needs:
        if name not in bound:
            before, value = _FROM[name]
            return _bound(
                text, before, bound,
                lambda f: let(value(text, f), lambda x: _bound(text, needs, {**f, name: x}, body)),
            )
    return body(bound)


def features(text: Column) -> Column:
    """A struct of all features of one text; a null text counts as an empty one."""
    whole = F.coalesce(text, F.lit(""))
    return _bound(whole, FEATURES, {}, lambda f: F.struct(*[f[name].alias(name) for name in FEATURES]))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def default_rules() -> list[Rule]:
    """Bounds that running prose keeps in any of the languages, by a wide margin."""
    return [
        Rule("too_few_words", ("n_words",), lambda f: f["n_words"] < MIN_WORDS),
        Rule("repetitive", ("n_words", "n_repeat_words"), lambda f: 100 * f["n_repeat_words"] > MAX_REPEAT_PCT * f["n_words"]),
        Rule("symbols", ("n_words", "n_symbols"), lambda f: 4 * f["n_symbols"] > f["n_words"]),
        Rule("word_length", ("n_words", "word_chars"), lambda f: (f["word_chars"] < 2 * f["n_words"]) | (f["word_chars"] > 15 * f["n_words"])),
        Rule("repeated_lines", ("n_lines", "n_dup_lines"), lambda f: 2 * f["n_dup_lines"] > f["n_lines"]),
        Rule("few_letters", ("n_letters", "word_chars"), lambda f: 2 * f["n_letters"] < f["word_chars"]),
        Rule("capitals", ("n_letters", "n_capitals"), lambda f: 2 * f["n_capitals"] > f["n_letters"]),
    ]


def _chain(whole: Column, rules: Sequence[Rule], bound: Mapping[str, Column]) -> Column:
    if not rules:
        return F.lit(None).cast("string")
    rule = rules[0]
    return _bound(whole, rule.needs, bound, lambda f: F.when(rule.rejects(f), F.lit(rule.name)).otherwise(_chain(whole, rules[1:], f)))


def cascade(text: Column, rules: Sequence[Rule]) -> Column:
    """Name of the first rule, in the given order, that rejects the text; null if none does."""
    return _chain(F.coalesce(text, F.lit("")), rules, {})


def estimate(docs: DataFrame, rules: Sequence[Rule], text_column: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and selectivity of each rule on a random sample of about ``sample_rows``, best rank first.

    Each rule is timed alone, so that only the features it reads are computed.
    Rounds over all rules follow each other after one that is not timed; a rule's
    cost is its median, less that of a job without a rule, to the nearest power
    of two, so that small differences between runs do not change the order.
    Equal ranks go by name.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    sample = materialize(docs.select(F.col(f"`{text_column}`").alias("text")).sample(share, seed=1), "rule-sample")
    n = max(sample.count(), 1)
    jobs = {None: F.when(F.length("text") < 0, "none")} | {rule.name: cascade(F.col("text"), [rule]) for rule in rules}
    seconds: dict[str | None, list[float]] = {name: [] for name in jobs}
    rejected = {}
    for timed in range(ROUNDS + 1):
        for name, verdict in jobs.items():
            started = time.monotonic()
            rejected[name] = sample.agg(F.count(verdict).alias("n")).first().n
            if timed:
                seconds[name].append(time.monotonic() - started)
    empty = median(seconds[None])
    cost = lambda name: 2.0 ** round(math.log2(max(median(seconds[name]) - empty, empty / 16, 1e-6) / n))
    return sorted((Estimate(rule.name, cost(rule.name), rejected[rule.name] / n) for rule in rules), key=lambda e: (-e.rank, e.rule))


def order_rules(docs: DataFrame, rules: Sequence[Rule], text_column: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    by_name = {rule.name: rule for rule in rules}
    return [by_name[e.rule] for e in estimate(docs, rules, text_column, sample_rows)]


def assess(
    docs: DataFrame,
    rules: Sequence[Rule] | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per input row: the id, the ``REPORTED`` features, ``base_failed``, ``rejected_by`` and ``kept``.

    The reported features are computed for every row. The verdict is the
    cascade's: it goes on from them, and any other feature is computed only for
    the rows that reach a rule which needs it. ``rejected_by`` is the first rule,
    in the measured order, that rejects the row; the order changes no verdict.

    Null or empty texts have no words and fail. Very long texts are read whole.
    Repeated rows and null ids are judged like any other row. Other columns of
    ``docs`` are not read, so their names do not matter. An empty table gives an
    empty result.
    """
    ordered = order_rules(docs, rules or default_rules(), text_column, sample_rows)
    whole = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    judged = _bound(
        whole, REPORTED, {},
        lambda f: F.struct(*[f[name].alias(name) for name in REPORTED], _chain(whole, ordered, f).alias("rejected_by")),
    )
    found = docs.select(F.col(f"`{id_column}`").alias("doc_id"), judged.alias("f")).select("doc_id", "f.*")
    return found.withColumns({"base_failed": base_failed(), "kept": ~base_failed() & F.col("rejected_by").isNull()})


def filter_quality(
    docs: DataFrame, rules: Sequence[Rule] | None = None, text_column: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The rows of ``docs`` that pass every rule, with their columns unchanged.

    The cascade is one filter on the scan: features of a rule are computed for
    the rows that reach it. Null and empty texts fail. Column names of ``docs``
    may be anything.
    """
    ordered = order_rules(docs, rules or default_rules(), text_column, sample_rows)
    return docs.filter(cascade(F.col(f"`{text_column}`"), ordered).isNull())


NAME = "op1_quality_rules"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Features and verdict of every document."""
    return assess(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


FEATURES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM {source}
), w AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM docs
), g AS (
  SELECT r, p, w AS w1, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY p)
), twice AS (
  SELECT r, w1, w2, w3 FROM g WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) > 1
), starts AS (
  SELECT g.r, g.p FROM g JOIN twice USING (r, w1, w2, w3)
), covered AS (
  SELECT r, count(DISTINCT p + k) AS n_repeat_words FROM starts, (VALUES (0), (1), (2)) t(k) GROUP BY r
), lines AS (
  SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs
), counted AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), f AS (
  SELECT r, doc_id, text, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(length(regexp_replace(text, '\P{L}', '', 'g')) AS BIGINT) AS n_letters,
    CAST(length(regexp_replace(text, '\P{Lu}', '', 'g')) AS BIGINT) AS n_capitals
  FROM docs LEFT JOIN counted USING (r) LEFT JOIN covered USING (r)
), judged AS (
  SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 4 * n_symbols > n_words
      OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines
      OR 2 * n_letters < word_chars OR 2 * n_capitals > n_letters) AS kept
  FROM f
)
"""

ORACLE_SQL = (
    FEATURES_SQL.replace("{source}", "documents")
    + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"
)
