"""Description tokens and exact-term weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlens.functions.stopwords import ENGLISH
from filmlens.operators.lookup import build_lookup, lookup_join
from filmlens.sources.staging import materialize


def tokens(text: str, min_length: int = 3) -> Column:
    """Lower-cased runs of word characters of at least ``min_length``."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"(\w{{{min_length},}})"), 1)


def content_tokens(text: str, min_length: int = 3) -> Column:
    """Tokens without English stop words."""
    return F.filter(tokens(text, min_length), lambda word: ~word.isin(ENGLISH))


def _counted(words: Column) -> Column:
    """``term, tf`` of each different word of an array: the runs of equal words after sorting."""
    nothing = F.array().cast("array<int>")

    def terms(w: Column, starts: Column) -> Column:
        tf = lambda at, k: F.coalesce(F.get(starts, k + 1), F.size(w)) - at
        return F.transform(starts, lambda at, k: F.struct(F.get(w, at).alias("term"), tf(at, k).cast("bigint").alias("tf")))

    def runs(w: Column) -> Column:
        places = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1)).otherwise(nothing)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
        # Arrays of one element bind the sorted words and the starts, which are read at every step.
        return F.get(F.transform(F.array(starts), lambda s: terms(w, s)), F.lit(0))

    return F.get(F.transform(F.array(F.sort_array(words)), runs), F.lit(0))


def term_counts(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Occurrences of each content token per row, with the row's columns ``keys``.

    A row's tokens are sorted and counted within the row, so nothing is shuffled
    and rows with equal keys stay apart.
    """
    return docs.select(*keys, F.inline(_counted(tokens(text)))).filter(~F.col("term").isin(ENGLISH))


def term_tfidf(docs: DataFrame, key: str, text: str, is_train: Column, broadcast_bytes: int | None = None) -> DataFrame:
    """``tf * ln((m + 1) / (df + 1))`` per document and term.

    ``m`` and the document frequencies come from the documents for which
    ``is_train`` holds; a term they do not contain has frequency zero. The
    texts are cut up once: the counts are written and serve both the
    frequencies and the weights. The frequencies tell which terms are common,
    and the lookup keeps those out of its shuffle.
    """
    marked = docs.withColumn("is_train", is_train)
    m = marked.filter("is_train").count()
    counts = materialize(term_counts(marked, [key, "is_train"], text), "term-counts")
    frequency = counts.filter("is_train").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    lookup, _ = build_lookup(frequency, "term", "df", "df", "document-frequency")
    weighed = lookup_join(counts, "term", lookup, "df", spread=[key, "term"], broadcast_bytes=broadcast_bytes)
    df = F.coalesce("df", F.lit(0))
    return weighed.select(key, "term", "tf", df.alias("df"), (F.col("tf") * F.log(F.lit(float(m + 1)) / (df + 1))).alias("tfidf"))
