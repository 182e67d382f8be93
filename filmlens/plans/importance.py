"""What a fitted model owes to its inputs: permutation importance and ablation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filmlens.operators.relational import hash_number
from filmlens.operators.temporal import previous_row
from filmlens.plans.evaluation import regression_metrics
from filmlens.sources.staging import materialize

HASHES = 1 << 32
BUCKETS = 1024


def permuted_rows(df: DataFrame, key: str, value: str, out: str, seed: int = 42) -> DataFrame:
    """Each row with the ``value`` of the row before it in the order of a hash of the key; the first has the last one's.

    That is one permutation of the whole column, the same whenever it is run. The
    order is cut into buckets of the hash, so no task sorts all rows.
    """
    placed = df.withColumn("__hash", hash_number([key], seed))
    shifted = previous_row(placed.withColumn("__value", F.struct(value)), [], ["__hash", key], "__value", "__before", HASHES / BUCKETS)
    last = placed.agg(F.max_by(F.struct(value), F.struct("__hash", key)).alias("__last"))
    return shifted.crossJoin(F.broadcast(last)).select(*df.columns, F.coalesce("__before", "__last")[value].alias(out))


def permutation_importance(
    model: Model, df: DataFrame, groups: Mapping[str, Sequence[int]], label: str, key: str, vector: str, prediction: str, seed: int = 42
) -> DataFrame:
    """``group, rmse, rmse_increase, r2_drop`` when the vector places of a group are permuted among the rows.

    All groups use one permutation, made once; a row is then scored once as it is
    and once per group, in one pass over the written rows. The places of a group
    move together, so what they say jointly is lost, and nothing else. ``key``
    should be unique.
    """
    narrow = df.select(key, label, vector_to_array(vector).alias("__own"))
    both = materialize(permuted_rows(narrow, key, "__own", "__other", seed), "permuted")
    places = [(name, list(indexes)) for name, indexes in groups.items()]
    variants = [F.struct(F.lit(None).cast("string").alias("group"), F.array().cast("array<int>").alias("places"))]
    variants += [F.struct(F.lit(name).alias("group"), F.array(*[F.lit(i) for i in indexes]).cast("array<int>").alias("places")) for name, indexes in places]
    mixed = F.transform("__own", lambda x, i: F.when(F.array_contains("v.places", i), F.get("__other", i)).otherwise(x))
    rows = both.select("*", F.explode(F.array(*variants)).alias("v")).select(label, "v.group", array_to_vector(mixed).alias(vector))
    error = F.col(label) - F.col(prediction)
    scored = model.transform(rows).groupBy("group").agg(F.avg(error * error).alias("mse"), F.var_pop(label).alias("spread"))
    scored = materialize(scored, "permutation-scores")
    base = scored.filter("group IS NULL").select(F.col("mse").alias("base"))
    return scored.filter("group IS NOT NULL").crossJoin(F.broadcast(base)).select(
        "group",
        F.sqrt("mse").alias("rmse"),
        (F.sqrt("mse") - F.sqrt("base")).alias("rmse_increase"),
        F.try_divide(F.col("mse") - F.col("base"), F.col("spread")).alias("r2_drop"),
    ).orderBy(F.desc("rmse_increase"), "group")


def ablation(
    train: DataFrame, test: DataFrame, inputs: Sequence[str], groups: Mapping[str, Sequence[str]], estimator: Estimator, label: str, drop: float = 0.2
) -> DataFrame:
    """Metrics of fits without each group of inputs: ``without, rmse, r2, r2_drop, depends``.

    The first row, without nothing, is the whole model; ``depends`` marks groups
    whose loss costs more than ``drop`` of R2. ``estimator`` reads ``features``.
    """
    runs = {"": list(inputs)} | {name: [c for c in inputs if c not in set(left_out)] for name, left_out in groups.items()}
    scored = test
    predictions = {}
    for i, (name, kept) in enumerate(runs.items()):
        if not kept:
            raise ValueError(f"{name} leaves no input")
        assembler = VectorAssembler(inputCols=kept, outputCol="features")
        fitted = estimator.copy().fit(assembler.transform(train))
        column = fitted.getPredictionCol()
        scored = fitted.transform(assembler.transform(scored)).withColumnRenamed(column, f"pred_{i}").drop("features")
        predictions[name] = f"pred_{i}"
    metrics = materialize(regression_metrics(scored, label, predictions), "ablation")
    base = metrics.filter("model = ''").select(F.col("r2").alias("base"))
    lost = F.col("base") - F.col("r2")
    return metrics.crossJoin(F.broadcast(base)).select(
        F.col("model").alias("without"), "rmse", "r2", lost.alias("r2_drop"), (lost > drop).alias("depends")
    ).orderBy("without")
