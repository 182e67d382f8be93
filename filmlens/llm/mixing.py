"""Mixing sources to target weights by Poisson replication.

A source of weight w is to make up w / (sum of weights) of the mix. Its mean
repetition rate is its share of the wanted size over its present size. Each
document draws its number of copies from the Poisson distribution of that mean:
the distribution function is inverted at a number hashed from the document's id
and the seed, so a repeated task draws the same copies again and no state is
shared. A large rate is drawn as a sum of Poisson counts of bounded mean, each
at a hash of its own. Documents are exploded by their counts and the copies are
put into a global order by another hash: a range shuffle whose keys are evenly
spread, so a hot source, or a document with many copies, is dealt over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.llm.common import table
from filmlens.sources.staging import materialize

WEIGHTS: Mapping[str, float] = {"src0": 4.0, "src1": 2.0, "src2": 2.0}
DEFAULT_WEIGHT = 1.0
EPOCHS = 1.0
SEED = 20240607
PART_RATE = 100.0
"""Largest mean of one Poisson draw; a larger rate is split into equal parts."""


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts: the middle of one of 2^52 cells."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + 0.5) / float(2**52)


def poisson_steps(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... of the Poisson distribution, until the rest is below 2^-60."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    start = F.struct((-rate).alias("log"), F.exp(-rate).alias("total"), F.array(F.exp(-rate)).alias("steps"))

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + F.log(rate) - F.log(k.cast("double"))
        total = acc["total"] + F.exp(log)
        return F.struct(log.alias("log"), total.alias("total"), F.concat(acc["steps"], F.array(total)).alias("steps"))

    steps = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["steps"])
    return F.when(rate > 0, steps).otherwise(F.array(F.lit(1.0)))


def source_rates(
    docs: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    default_weight: float = DEFAULT_WEIGHT,
    epochs: float = EPOCHS,
    source_column: str = "source",
    text_column: str = "text",
    max_rate: float | None = None,
) -> DataFrame:
    """One row per source: size (characters), weight, and mean repetition rate, as large as the weights ask, or at most ``max_rate`` where that is given.

    Rows without a source form a source of their own with the default weight. A
    source without any character cannot be brought to a weight and keeps rate 1.
    """
    name = F.col(f"`{source_column}`")
    sizes = docs.groupBy(name.alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(F.char_length(F.col(f"`{text_column}`"))), F.lit(0)).cast("bigint").alias("n_chars")
    )
    weight = F.lit(float(default_weight))
    for key in sorted(weights):
        weight = F.when(F.col("source") == key, F.lit(float(weights[key]))).otherwise(weight)
    sizes = materialize(sizes.withColumn("weight", weight), "source-sizes")
    whole = sizes.filter("n_chars > 0").agg(F.sum("n_chars").alias("all_chars"), F.sum("weight").alias("all_weights")).first()
    if not whole.all_weights:
        return sizes.withColumn("rate", F.lit(1.0))
    wanted = F.col("weight") / F.lit(float(whole.all_weights)) * F.lit(epochs * float(whole.all_chars))
    rate = F.when(F.col("n_chars") > 0, wanted / F.col("n_chars")).otherwise(F.lit(1.0))
    return sizes.withColumn("rate", rate if max_rate is None else F.least(rate, F.lit(max_rate)))


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] = WEIGHTS,
    default_weight: float = DEFAULT_WEIGHT,
    epochs: float = EPOCHS,
    seed: int = SEED,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    max_rate: float | None = None,
) -> DataFrame:
    """The columns of ``docs`` with ``copy`` (1, 2, ...) and ``shuffle_key``, in the order of the latter.

    Rows with the same id draw the same number of copies; a null id draws as
    the text "null". Null sources are one source, null and empty texts count as
    size zero and are replicated with their source; very long ones are moved like
    any other. Copies of rows that share an id have equal keys, and their order
    among each other is not defined. An empty table gives an empty mix. Columns
    named ``copy`` or ``shuffle_key`` are replaced; other names may be anything.
    Every source reaches its weight, however small it is, unless ``max_rate`` is given.
    """
    rates = source_rates(docs, weights, default_weight, epochs, source_column, text_column, max_rate)
    # The written table's size is known to the planner: it is broadcast only where it is small.
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE).cast("int"), F.lit(1))
    steps = materialize(rates.select(F.col("source").alias("of_source"), parts.alias("parts"), poisson_steps(F.col("rate") / parts).alias("steps")), "source-steps")
    names = [n for n in docs.columns if n not in ("copy", "shuffle_key")]
    # The caller's columns travel in one struct, so that no name can meet those below.
    packed = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("null")).alias("id"),
        F.col(f"`{source_column}`").alias("source"),
    )
    drawn = packed.join(steps, F.col("source").eqNullSafe(F.col("of_source")), "left").withColumn("u", uniform(F.lit(seed), F.col("id")))
    below = lambda u: F.size(F.filter("steps", lambda c: c < u))
    others = F.transform(F.sequence(F.lit(2), F.col("parts")), lambda part: uniform(F.lit(seed), F.col("id"), part))
    more = F.aggregate(others, F.lit(0), lambda n, u: n + below(u))
    count = below(F.col("u")) + F.when(F.col("parts") > 1, more).otherwise(0)
    copies = drawn.select("row", "id", F.explode(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))).alias("copy"))
    key = F.md5(F.concat_ws(":", F.lit(seed + 1), F.col("id"), F.col("copy")))
    keyed = copies.select(*[F.col("row").getField(n).alias(n) for n in names], "copy", key.alias("shuffle_key"))
    return keyed.orderBy("shuffle_key")


NAME = "op5_mix_sources"


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents at the production weights."""
    return mix(table(spark, folder, "documents"))


MIX_SQL = f"""
sizes AS (
  SELECT source, coalesce(sum(length(text)), 0) AS n_chars,
    CASE source WHEN 'src0' THEN 4.0 WHEN 'src1' THEN 2.0 WHEN 'src2' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM mixed_from GROUP BY source
), rates AS (
  SELECT source, CASE WHEN n_chars > 0 THEN weight / (SELECT sum(weight) FROM sizes WHERE n_chars > 0)
    * (SELECT sum(n_chars) FROM sizes)::DOUBLE / n_chars ELSE 1.0 END AS rate
  FROM sizes
), parts AS (
  SELECT source, greatest(ceil(rate / {PART_RATE}), 1)::BIGINT AS parts, rate / greatest(ceil(rate / {PART_RATE}), 1) AS rate FROM rates
), steps AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM parts, range(0, 400) t(k)
), hashed AS (
  SELECT d.*, row_number() OVER () AS r, unnest(range(1, coalesce(parts, 1) + 1)) AS part,
    '{SEED}:' || coalesce(doc_id::VARCHAR, 'null') AS key
  FROM mixed_from d LEFT JOIN parts p ON p.source IS NOT DISTINCT FROM d.source
), drawn AS (
  SELECT *, (('0x' || substr(md5(CASE WHEN part = 1 THEN key ELSE key || ':' || part END), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM hashed
), counted AS (
  SELECT r, any_value(d.doc_id) AS doc_id, any_value(text) AS text, any_value(lang) AS lang, any_value(d.source) AS source, any_value(n_chars) AS n_chars,
    sum((SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.upto < d.u))::BIGINT AS n
  FROM drawn d GROUP BY r
), mixed AS (
  SELECT doc_id, text, lang, source, n_chars, k::INTEGER AS copy,
    md5('{SEED + 1}:' || coalesce(doc_id::VARCHAR, 'null') || ':' || k::VARCHAR) AS shuffle_key
  FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM counted)
)
"""

ORACLE_SQL = f"WITH mixed_from AS (SELECT * FROM documents), {MIX_SQL} SELECT * FROM mixed"
