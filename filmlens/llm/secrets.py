"""Secret scan: candidate strings, and a random forest that removes false findings.

Candidates are found by what stands before them or by their look: the value
behind a secret's name and ``=`` or ``:``, of any length and alphabet; the
password in an address ``scheme://user:password@``; and runs of 16 or more key
characters with a digit among them. Each gets features of five kinds: length; character transitions (changes between small
letters, capitals and digits, and the make-up of the string); dictionary
coverage (share of its letters that are words of the corpus, the dictionary
being counted over all texts); path (slashes, dots, extensions, addresses); and
neighbouring words (words such as "token" before it, assignment, quotes). A
random forest is fitted on labelled findings, a bounded sample of them, and
scores every candidate.

Labelled findings are given as a table, or seeded by rules that are certain on
their face: assigned to a name that says it is a secret, against plain numbers,
addresses and strings made of words. All work is column expressions, joins with
measured tables and the forest of Spark ML; a value that occurs in many
documents is judged once.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import blocks, let, piece, running, table
from filmlens.sources.staging import materialize

_KEY = "A-Za-z0-9_+/=-"
_NAME = r"(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key|auth)[a-z0-9_]{0,16}[\"']?\s{0,3}[:=]\s{0,3}[\"']?"
_SECRET_NAME = rf"(?i){_NAME}\z"
_LOGIN = r"[a-z][a-z0-9+.-]{1,15}://[^\s/:@\"']{0,64}:(?=[^\s/@\"']+@)"
_CONTEXT_OF = rf"(?i:[a-z0-9_-]{{0,32}}?{_NAME}|[a-z][a-z0-9+.-]{{1,15}}://[^\s/:@\"']{{0,64}}:)(?=.)"
"""The context at the start of a match, of which the closing quote or ``@`` is not a part."""
# A quoted value goes to its quote; any other to a blank or a sign that parts values, without a full stop or bracket behind it.
_VALUE = r"(?:(?<=\")[^\"\n]++(?=\")|(?<=')[^'\n]++(?=')|[^\s\"'<>,;&]*[^\s\"'<>,;&.)])"
# One pass over the text: a name, an address or a run starts where no key character stands before it.
_CANDIDATE = (
    rf"(?<![{_KEY}])(?:(?i:[a-z0-9_-]{{0,32}}?{_NAME}){_VALUE}|(?i:{_LOGIN})[^\s/@\"']+"
    rf"|(?=[A-Za-z_+/=-]*+[0-9])[{_KEY}]{{16,}}+)"
)
_NEAR = r"(?i)token|secret|passw|credential|api|auth|key|bearer|private"
BEFORE, AFTER = 90, 12
WORD_TEXTS = 3
"""Texts in which a word must occur to be in the dictionary."""
MAX_LABELLED = 20_000
"""Most labelled findings of each class the forest is fitted on (a sample by hash)."""
TREES, DEPTH, SEED = 20, 6, 11
THRESHOLD = 0.5

_FOUND = "array<struct<start:int,value:string,before:string,after:string>>"
FEATURES = [
    "length", "changes", "digit_share", "capital_share", "mark_share", "hex", "vowel_share", "distinct_share", "coverage",
    "slashes", "dots_beside", "extension", "address", "near_words", "named", "assigned", "quoted", "login",
]


def _candidates_of(text: Column) -> Column:
    """Place, value and neighbourhood of every candidate, in work that grows with the length of the text."""

    def parted(gap: Column, match: Column) -> Column:
        # What is found by its context counts from the end of the context, which belongs to the gap.
        lead = F.char_length(F.regexp_extract(match, rf"^{_CONTEXT_OF}", 0))
        value = F.substring(match, lead + 1, F.char_length(match))
        return F.struct((F.char_length(gap) + F.coalesce(lead, F.lit(0))).alias("gap"), value.alias("value"))

    both = F.zip_with(F.split(text, _CANDIDATE, -1), F.regexp_extract_all(text, F.lit(_CANDIDATE), F.lit(0)), parted)
    length = lambda x: x["gap"] + F.coalesce(F.char_length(x["value"]), F.lit(0))

    def placed(bound: Column) -> Column:
        found, parts, n = bound["found"], bound["parts"], bound["n"]

        def one(x: Column, at: Column) -> Column:
            begin = at + x["gap"]
            end = begin + F.char_length(x["value"])
            before = piece(parts, F.greatest(begin - BEFORE, F.lit(0)), begin)
            return F.struct(begin.alias("start"), x["value"].alias("value"), before.alias("before"), piece(parts, end, F.least(end + AFTER, n)).alias("after"))

        starts = let(F.transform(found, length), lambda lengths: running(lengths, F.lit(0), lambda a, x: a + x))
        return F.filter(F.zip_with(found, starts, one), lambda s: s["value"].isNotNull())

    bound = F.struct(both.alias("found"), blocks(text).alias("parts"), F.char_length(text).alias("n"))
    return F.when(text.rlike(_CANDIDATE), let(bound, placed)).otherwise(F.array().cast(_FOUND))


def candidates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per candidate: doc_id, start (code points), value, and the characters before and after."""
    narrow = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text")).filter("text IS NOT NULL")
    # The text stays behind: only what is found in it is repeated by candidate.
    return narrow.select("doc_id", F.explode(_candidates_of(F.col("text"))).alias("f")).select("doc_id", "f.*")


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z]{4,}+)"), 1)


def _coverage(values: DataFrame, texts: DataFrame) -> DataFrame:
    """``value`` and the share of its characters in words of the dictionary."""
    pieces = values.select("value", F.explode(_pieces(F.col("value"))).alias("piece"))
    wanted = materialize(pieces.select("piece").distinct(), "pieces")
    # Candidates themselves are no texts: a key that is repeated is not a word for it.
    hashed = F.struct(F.xxhash64("text").alias("h"), F.array_distinct(_pieces(F.regexp_replace("text", _CANDIDATE, " "))).alias("pieces"))
    pairs = let(hashed, lambda x: F.transform(x["pieces"], lambda t: F.struct(x["h"].alias("text_hash"), t.alias("piece"))))
    words = texts.select(F.explode(pairs).alias("x")).select("x.*")
    counted = words.join(wanted, "piece").groupBy("piece").agg(F.count_distinct("text_hash").alias("n"))
    dictionary = materialize(counted.filter(F.col("n") >= WORD_TEXTS).select("piece"), "dictionary")
    covered = pieces.join(dictionary, "piece").groupBy("value").agg(F.sum(F.char_length("piece")).alias("covered"))
    share = F.coalesce("covered", F.lit(0)) / F.char_length("value")
    return values.join(covered, "value", "left").select("value", share.alias("coverage"))


def _value_features() -> dict[str, Column]:
    v, n = F.col("value"), F.char_length("value")
    share = lambda pattern: F.regexp_count(v, F.lit(pattern)) / n
    changes = F.regexp_count(v, F.lit(r"[a-z](?![a-z])|[A-Z](?![A-Z])|[0-9](?![0-9])"))
    return {
        "length": n.cast("double"),
        "changes": changes / n,
        "digit_share": share("[0-9]"),
        "capital_share": share("[A-Z]"),
        "mark_share": share("[_+/=-]"),
        "hex": v.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)\z").cast("double"),
        "vowel_share": share("[aeiouAEIOU]"),
        "distinct_share": F.size(F.array_distinct(F.split(v, ""))) / F.least(n, F.lit(64)),
        "slashes": F.regexp_count(v, F.lit("/")).cast("double"),
    }


def _place_features() -> dict[str, Column]:
    before, after = F.col("before"), F.col("after")
    one = lambda c: c.cast("double")
    login = before.rlike(r"(?i)[a-z][a-z0-9+.-]{1,15}://[^\s/:@\"']{0,64}:\z") & after.rlike("^@")
    return {
        "dots_beside": one(before.rlike(r"[.]\z") | after.rlike(r"^[.]\S")),
        "extension": one(after.rlike(r"^[.][a-z]{2,4}\b")),
        "address": one(~login & (after.rlike("^@") | before.rlike(r"@\z|://\S*\z|www[.]\S*\z"))),
        "near_words": F.regexp_count(before, F.lit(_NEAR)).cast("double"),
        "named": one(before.rlike(_SECRET_NAME)),
        "assigned": one(before.rlike(r"[=:]\s{0,3}[\"']?\z")),
        "quoted": one(before.rlike(r"[\"']\z") & after.rlike("^[\"']")),
        "login": one(login),
    }


def seed_labels() -> Column:
    """1 for findings that are secrets on their face, 0 for such that are not, null for all others."""
    number = F.col("value").rlike(r"^[0-9_+/=-]+\z")
    plain = number | (F.col("address") > 0) | (F.col("coverage") >= 0.6) | (F.col("distinct_share") * F.least(F.col("length"), F.lit(64)) < 6)
    sure = ((F.col("named") > 0) & (F.col("length") >= 20)) | (F.col("login") > 0)
    return F.when(plain, 0).when(sure, 1)


def describe(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """All candidates with their features (written)."""
    found = materialize(candidates(docs, id_column, text_column), "secret-candidates")
    texts = docs.select(F.col(f"`{text_column}`").alias("text")).filter("text IS NOT NULL")
    values = materialize(found.select("value").distinct(), "secret-values")
    coverage = materialize(_coverage(values, texts).withColumns(_value_features()), "value-features")
    return materialize(found.join(coverage, "value").withColumns(_place_features()), "secret-features")


def scan(docs: DataFrame, labelled: DataFrame | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per candidate: ``doc_id``, ``start``, ``end``, ``value_sha256``, ``score``, ``secret``.

    ``labelled`` has value and secret (0 or 1; other rows are not used);
    without it the seed rules label the findings. With labels of one class
    only, or none, no forest is fitted: labelled findings keep their label and
    all others are secrets, as a scan without removal would have them. Null and
    empty texts have no candidates, and very long ones are searched whole.
    Repeated rows repeat their findings; null ids are allowed. A value labelled
    both ways is a secret; equal scores stay equal. Of an empty table nothing is
    returned. Only the two named columns are read, whatever the others' names.
    """
    described = describe(docs, id_column, text_column)
    if labelled is None:
        marked = described.withColumn("label", seed_labels())
    else:
        known = labelled.filter("secret IN (0, 1)").groupBy("value").agg(F.max("secret").cast("int").alias("label"))
        marked = described.join(known, "value", "left")
    usable = marked.filter("label IS NOT NULL").select("label", *FEATURES).distinct()
    # A bounded table in a fixed order, so that the forest is the same each time.
    parts = [usable.filter(F.col("label") == c).orderBy(F.xxhash64(*FEATURES), *FEATURES).limit(MAX_LABELLED) for c in (0, 1)]
    sample = materialize(parts[0].union(parts[1]), "labelled-findings")
    classes = {r.label for r in sample.select("label").distinct().collect()}
    if len(classes) == 2:
        assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(
            labelCol="label", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED, subsamplingRate=0.8, featureSubsetStrategy="onethird", maxMemoryInMB=64
        )
        model = forest.fit(assemble.transform(sample.coalesce(1).sortWithinPartitions("label", *FEATURES)))
        scored = model.transform(assemble.transform(marked)).withColumn("score", vector_to_array("probability")[1])
    else:
        scored = marked.withColumn("score", F.coalesce(F.col("label").cast("double"), F.lit(1.0)))
    end = F.col("start") + F.char_length("value")
    return scored.select("doc_id", "start", end.alias("end"), F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= THRESHOLD).alias("secret"))


NAME = "op4_secret_scan"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate of every document, with its score."""
    return scan(table(spark, folder, "documents"))


# A fitted forest has no SQL form; tests hold the candidates and features against brute force.
ORACLE_SQL = None
