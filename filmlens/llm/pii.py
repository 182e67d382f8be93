"""Personal data: fixed patterns, and terms that give a protected entity away.

Patterns find the protected entities (addresses, numbers) with their places.
Sanitisation by information content then asks which ordinary terms reveal them:
from the whole corpus it counts in how many different texts a term stands beside
an entity (within ``NEAR_WORDS`` words and ``NEAR_CHARS`` characters), and in how
many the term occurs at all. A term discloses an entity by the posterior
p(entity | term) and by the information log2(p(entity | term) / p(entity)). Terms
above the first threshold are generalised, terms above the second are removed,
wherever they occur.

Copies of one text are one piece of evidence: texts are counted by content. All
of it is built-in column expressions, joins and aggregates with partial
aggregation; a hot entity or term never meets in one task. Work grows with the
length of a text, however many matches are in it: places come from running sums,
and what lies around them from blocks of the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import blocks, let, piece, running, table
from filmlens.sources.staging import materialize

KINDS = ("email", "ip", "card", "phone", "term")
"""In the order in which spans with the same start are listed."""

# Possessive quantifiers and the anchored starts keep each pattern linear in the
# text; they find the same leftmost matches as the plain forms, because a run
# that fails from its first character fails from all others too.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_TERM = r"\p{L}{4,}+"

MIN_TEXTS = 3
"""Different texts in which a term must stand beside an entity before it can count as revealing."""
GENERALISE = 0.5
REMOVE = 0.9
"""Thresholds of p(entity | term)."""
MIN_BITS = 6.0
NEAR_CHARS = 200
NEAR_WORDS = 8
"""A term is beside an entity within so many characters and terms on either side; further words are no evidence."""

_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _ip_valid(match: Column) -> Column:
    part = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
    return match.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def _card_valid(match: Column) -> Column:
    digits = _digits(match)
    return F.char_length(digits).between(14, 19) & F.call_function("luhn_check", digits)


def _phone_valid(match: Column) -> Column:
    return F.char_length(_digits(match)).between(10, 15)


def _places(text: Column, pattern: str, kind: int, valid) -> Column:
    """Spans of the valid matches; the places follow from the lengths of what lies between matches."""
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(gaps, matches, lambda gap, match: F.struct(F.char_length(gap).alias("gap"), match.alias("value")))
    length = lambda x: x["gap"] + F.coalesce(F.char_length(x["value"]), F.lit(0))

    def span(x: Column, before: Column) -> Column:
        start = before + x["gap"]
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + F.char_length(x["value"])).alias("end"), x["value"].alias("value"))

    def placed(parts: Column) -> Column:
        before = let(F.transform(parts, length), lambda lengths: running(lengths, F.lit(0), lambda a, x: a + x))
        return F.filter(F.zip_with(parts, before, span), lambda s: s["value"].isNotNull() & valid(s["value"]))

    return let(parts, placed)


def base_spans(text: Column) -> Column:
    """Spans of the four patterns by start, then kind; none for a null text."""
    text = F.coalesce(text, F.lit(""))
    none = F.array().cast(_SPAN)
    has = lambda ok, spans: F.when(ok, spans).otherwise(none)
    return F.sort_array(
        F.concat(
            has(F.contains(text, F.lit("@")), _places(text, _EMAIL, 0, lambda m: F.lit(True))),
            has(text.rlike(r"[0-9]\.[0-9]"), _places(text, _IP, 1, _ip_valid)),
            has(text.rlike(r"[0-9][\x20-]?[0-9]"), _places(text, _CARD, 2, _card_valid)),
            has(F.contains(text, F.lit("+")), _places(text, _PHONE, 3, _phone_valid)),
        )
    )


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({_TERM})"), 1)


def _mentions(spanned: DataFrame) -> DataFrame:
    """One row per term and entity mention: entity, hash of the text, term. Only what stands beside an entity leaves its row."""

    def beside(whole: Column) -> Column:
        parts, n = whole["parts"], whole["n"]
        return F.transform(
            "spans",
            lambda s: F.struct(
                whole["text_hash"].alias("text_hash"),
                s["kind"].alias("kind"),
                s["value"].alias("value"),
                piece(parts, F.greatest(s["start"] - NEAR_CHARS, F.lit(0)), s["start"]).alias("left"),
                piece(parts, s["end"], F.least(s["end"] + NEAR_CHARS, n)).alias("right"),
                (s["start"] > NEAR_CHARS).alias("left_cut"),
                (n - s["end"] > NEAR_CHARS).alias("right_cut"),
            ),
        )

    whole = F.struct(blocks(F.col("text")).alias("parts"), F.char_length("text").alias("n"), F.xxhash64("text").alias("text_hash"))
    # Exploded as one expression: a named list would be computed again by the filter that Spark infers for it.
    one = spanned.select(F.explode(F.when(F.size("spans") > 0, let(whole, beside))).alias("s"))
    digits = _digits(F.col("s.value"))
    value = F.when(F.col("s.kind") == 0, F.lower("s.value")).when(F.col("s.kind") == 1, F.col("s.value")).otherwise(digits)
    # Words cut by the edge of the neighbourhood are left out.
    left = let(
        _terms(F.col("s.left")),
        lambda w: let(F.when(F.col("s.left_cut") & (F.size(w) > 0), F.slice(w, 2, F.size(w))).otherwise(w), lambda v: F.slice(v, F.greatest(F.size(v) - NEAR_WORDS, F.lit(0)) + 1, NEAR_WORDS)),
    )
    right = let(
        _terms(F.col("s.right")),
        lambda w: F.slice(F.when(F.col("s.right_cut") & (F.size(w) > 0), F.slice(w, 1, F.size(w) - 1)).otherwise(w), 1, NEAR_WORDS),
    )
    entity = F.concat_ws(":", F.col("s.kind"), value).alias("entity")
    return one.select(entity, F.col("s.text_hash").alias("text_hash"), F.explode(F.array_distinct(F.concat(left, right))).alias("term"))


def disclosure(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Terms seen beside an entity in at least ``MIN_TEXTS`` texts that may reach the first threshold, with their disclosure.

    Columns: term, entity, n_together, n_term, n_entity, posterior, bits.
    """
    return _disclosure(_spanned(docs, id_column, text_column))


def _spanned(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    return docs.select(F.col(f"`{id_column}`").alias("doc_id"), text.alias("text")).withColumn("spans", base_spans(F.col("text")))


def _word_rows(spanned: DataFrame) -> DataFrame:
    """Distinct terms of every text, with the document."""
    hashed = F.struct(F.xxhash64("text").alias("h"), F.array_distinct(_terms(F.col("text"))).alias("terms"))
    # The text stays behind, and the hash is taken once.
    pairs = let(hashed, lambda x: F.transform(x["terms"], lambda t: F.struct(x["h"].alias("text_hash"), t.alias("term"))))
    return spanned.select("doc_id", F.explode(pairs).alias("x")).select("doc_id", "x.*")


def _disclosure(spanned: DataFrame) -> DataFrame:
    mentions = materialize(_mentions(spanned), "mentions")
    together = mentions.groupBy("term", "entity").agg(F.count_distinct("text_hash").alias("n_together")).filter(F.col("n_together") >= MIN_TEXTS)
    # A term beside many entities is in at least so many texts: where this alone
    # keeps the posterior below the threshold, its texts need not be counted.
    at_least = mentions.groupBy("term").agg(F.count_distinct("text_hash").alias("n_near"))
    candidates = together.join(at_least, "term").filter(F.col("n_together") >= GENERALISE * F.col("n_near"))
    candidates = materialize(candidates.select("term", "entity", "n_together"), "term-candidates")
    schema = "term string, entity string, n_together bigint, n_term bigint, n_entity bigint, posterior double, bits double"
    if candidates.isEmpty():
        return spanned.sparkSession.createDataFrame([], schema)
    wanted = candidates.select("term").distinct()
    n_term = _word_rows(spanned).join(wanted, "term").groupBy("term").agg(F.count_distinct("text_hash").alias("n_term"))
    n_entity = mentions.groupBy("entity").agg(F.count_distinct("text_hash").alias("n_entity"))
    n_texts = F.lit(max(spanned.count(), 1)).cast("double")
    posterior = F.least(F.col("n_together") / F.col("n_term"), F.lit(1.0))
    return (
        candidates.join(n_term, "term")
        .join(n_entity, "entity")
        .withColumn("posterior", posterior)
        .withColumn("bits", F.log2(F.col("posterior") * n_texts / F.col("n_entity")))
        .select("term", "entity", "n_together", "n_term", "n_entity", "posterior", "bits")
    )


def _revealing(spanned: DataFrame) -> DataFrame | None:
    """Documents with their revealing terms (``removed``: above the second threshold), or None."""
    strong = _disclosure(spanned).filter((F.col("posterior") >= GENERALISE) & (F.col("bits") >= MIN_BITS))
    flagged = materialize(strong.groupBy("term").agg(F.max("posterior").alias("posterior")), "revealing-terms")
    if flagged.isEmpty():
        return None
    rows = _word_rows(spanned).join(flagged, "term")
    found = rows.groupBy(F.col("doc_id").alias("_t_id"), F.col("text_hash").alias("_t_hash")).agg(
        F.collect_set("term").alias("terms"), F.collect_set(F.when(F.col("posterior") >= REMOVE, F.col("term"))).alias("removed")
    )
    # A written table: the join with the texts is a broadcast only where this is small.
    return materialize(found, "documents-with-terms")


def _all_spans(spanned: DataFrame) -> DataFrame:
    """Adds ``all_spans``, with the revealing terms, and ``removed``."""
    found = _revealing(spanned)
    if found is None:
        return spanned.withColumns({"all_spans": F.col("spans"), "removed": F.array().cast("array<string>")})
    key = F.col("doc_id").eqNullSafe(F.col("_t_id")) & (F.xxhash64("text") == F.col("_t_hash"))
    joined = spanned.join(found, key, "left")
    terms = _places(F.col("text"), _TERM, 4, lambda m: F.array_contains("terms", F.lower(m)))
    return joined.withColumns(
        {
            "all_spans": F.when(F.col("terms").isNull(), F.col("spans")).otherwise(F.sort_array(F.concat("spans", terms))),
            "removed": F.coalesce("removed", F.array().cast("array<string>")),
        }
    )


def _listed(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"], s["end"])))


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: counts by kind, digest of the base spans, and all spans.

    A null text counts as an empty one: no spans. Repeated rows are found and
    listed alike; null ids are allowed. Only the two named columns are read.
    """
    spanned = _spanned(docs, id_column, text_column)
    of_kind = lambda kind: lambda s: s["kind"] == kind
    counts = {f"n_{k}": F.size(F.filter("spans", of_kind(i))).cast("bigint") for i, k in enumerate(KINDS[:4])}
    found = _all_spans(spanned).withColumns(counts)
    n_term = (F.size("all_spans") - F.size("spans")).cast("bigint")
    return found.select("doc_id", *counts, n_term.alias("n_term"), F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"), _listed(F.col("all_spans")).alias("spans"))


def _rewritten(text: Column, spans: Column, removed: Column) -> Column:
    """The text with its spans replaced; overlapping spans are replaced together by the first one's mark."""
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def mark(s: Column) -> Column:
        gone = (s["kind"] == 4) & F.array_contains(removed, F.lower(s["value"]))
        return F.when(gone, F.lit("")).otherwise(F.element_at(marks, s["kind"] + 1))

    def parts(bound: Column) -> Column:
        found, ends, whole = bound["spans"], bound["ends"], bound["parts"]
        # A span counts if all spans before it have ended.
        upto = running(ends, F.lit(0), lambda a, x: F.greatest(a, x))
        placed = F.zip_with(found, upto, lambda s, at: F.struct(s.alias("s"), at.alias("at")))
        kept = F.filter(placed, lambda x: x["s"]["start"] >= x["at"])
        pieces = F.transform(kept, lambda x: F.concat(piece(whole, x["at"], x["s"]["start"]), mark(x["s"])))
        return F.concat(F.array_join(pieces, ""), piece(whole, F.array_max(ends), bound["n"]))

    bound = let(
        spans,
        lambda found: F.struct(
            found.alias("spans"), F.transform(found, lambda s: s["end"]).alias("ends"), blocks(text).alias("parts"), F.char_length(text).alias("n")
        ),
    )
    return F.when(F.size(spans) == 0, text).otherwise(let(bound, parts))


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with personal data in the text column replaced; all rows and other columns stay.

    A pattern becomes its mark (``[EMAIL]``), a revealing term ``[TERM]`` or
    nothing. Texts without any span, null and empty ones too, are unchanged.
    """
    names = docs.columns
    packed = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names if n != text_column]).alias("_row"),
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{text_column}`").alias("_raw"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    ).withColumn("spans", base_spans(F.col("text")))
    done = _all_spans(packed)
    clean = F.when(F.col("_raw").isNotNull(), _rewritten(F.col("text"), F.col("all_spans"), F.col("removed")))
    return done.select(*[clean.alias(n) if n == text_column else F.col("_row").getField(n).alias(n) for n in names])


NAME = "op8_pii"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Spans of personal data of every document."""
    return find(table(spark, folder, "documents"))


# The term statistics have no practical SQL form; tests hold the query against brute force.
ORACLE_SQL = None
