"""The weighted two-sided graph of who works with whom, and features of its nodes.

Edges are pairs of a left and a right value (director and actors, say) with the
number of rows that name both. All steps are grouped aggregates and lookup
joins; a node with very many edges is one of the lookup's hot keys, whose edges
are served where they stand instead of meeting in one task.

The rounds read the edges as lists, one row per node of the side with more
nodes: its ranks are joined with lists instead of edges, and an update of that
side finds a node's edges together, so that only one row per node is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filmlens.operators.lookup import Lookup, build_lookup, lookup_join
from filmlens.sources.staging import materialize

DAMPING = 0.85
ROUNDS = 10

LIST_EDGES = 10_000
"""About how many edges a list holds; nodes with more have several lists, and there is at most one such node in this many edges."""


def edges(df: DataFrame, left: str, right: str) -> DataFrame:
    """``left, right, weight`` of every pair that a row names; rows without one of the two name none."""
    named = df.filter(F.col(left).isNotNull() & F.col(right).isNotNull())
    return named.groupBy(F.col(left).alias("left"), F.col(right).alias("right")).agg(F.count(F.lit(1)).alias("weight"))


def degrees(graph: DataFrame, side: str) -> DataFrame:
    """``node, degree, strength``: neighbours and summed weights of the nodes of one side, ``left`` or ``right``."""
    return graph.groupBy(F.col(side).alias("node")).agg(F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("strength"))


@dataclass(frozen=True)
class _Lists:
    """The edges, written as ``<by>, list, others, weights``: nodes of the side ``by`` with their edges to the side ``other``."""

    table: DataFrame
    by: str
    other: str

    def edges(self, *columns: str) -> DataFrame:
        """``<by>, <other>, weight`` and further columns of the lists."""
        each = self.table.select(self.by, *columns, F.explode(F.arrays_zip("others", "weights")).alias("e"))
        return each.select(self.by, *columns, F.col("e.others").alias(self.other), F.col("e.weights").alias("weight"))

    def with_lookup(self, side: str, lookup: Lookup, out: str, *columns: str, broadcast_bytes: int | None = None) -> DataFrame:
        """The edges with the value ``out`` of their node of one side; that of the side ``by`` is joined before the lists become edges."""
        if side == self.other:
            return lookup_join(self.edges(*columns), side, lookup, out, ["left", "right"], broadcast_bytes)
        joined = lookup_join(self.table, side, lookup, out, [side, "list"], broadcast_bytes)
        return _Lists(joined, self.by, self.other).edges(out, *columns)


def _as_lists(graph: DataFrame, by: str, other: str) -> _Lists:
    many = degrees(graph, by).filter(F.col("degree") > LIST_EDGES).select(F.col("node"), F.ceil(F.col("degree") / LIST_EDGES).alias("lists"))
    number = F.pmod(F.xxhash64(other), F.coalesce("lists", F.lit(1)))
    numbered = graph.join(F.broadcast(many), F.col(by) == F.col("node"), "left").withColumn("list", number)
    lists = numbered.groupBy(by, "list").agg(F.collect_list(F.struct(F.col(other).alias("o"), F.col("weight").alias("w"))).alias("e"))
    return _Lists(materialize(lists.select(by, "list", F.col("e.o").alias("others"), F.col("e.w").alias("weights")), "collaboration-lists"), by, other)


def _passed_on(lists: _Lists, source: str, target: str, ranks: Lookup, n_target: int, damping: float, broadcast_bytes: int | None) -> DataFrame:
    """The next ranks of one side: each node of the other side deals its rank by the weights of its edges."""
    served = lists.with_lookup(source, ranks, "__share", broadcast_bytes=broadcast_bytes)
    received = F.sum(F.col("__share") * F.col("weight"))
    return served.groupBy(F.col(target).alias("node")).agg(
        (F.lit((1.0 - damping) / n_target) + F.lit(damping) * received).alias("rank"),
        F.count(F.lit(1)).alias("degree"),
        F.sum("weight").alias("strength"),
    )


def _ranked(
    df: DataFrame, left: str, right: str, rounds: int, damping: float, broadcast_bytes: int | None
) -> tuple[_Lists, DataFrame, DataFrame]:
    """The edges as lists, and the ranks of the left and of the right nodes."""
    graph = materialize(edges(df, left, right), "collaborations")
    sizes = graph.agg(F.count_distinct("left").alias("l"), F.count_distinct("right").alias("r")).first()
    lists = _as_lists(graph, *(("right", "left") if sizes.r >= sizes.l else ("left", "right")))
    share: Column = F.col("rank") / F.col("strength")

    def as_lookup(ranks: DataFrame, name: str) -> Lookup:
        return build_lookup(ranks, "node", "rank", "degree", name)[0].derive("share", share)

    start = degrees(graph, "left").withColumn("rank", F.lit(1.0) / F.lit(max(sizes.l, 1)))
    lefts = as_lookup(start, "ranks-left")
    rights = None
    for _ in range(rounds):
        rights = as_lookup(_passed_on(lists, "left", "right", lefts, max(sizes.r, 1), damping, broadcast_bytes), "ranks-right")
        lefts = as_lookup(_passed_on(lists, "right", "left", rights, max(sizes.l, 1), damping, broadcast_bytes), "ranks-left")
    if rights is None:
        raise ValueError("rounds must be positive")
    return lists, lefts.table.select("node", "rank", "degree", "strength"), rights.table.select("node", "rank", "degree", "strength")


def collaboration_rank(
    df: DataFrame, left: str, right: str, rounds: int = ROUNDS, damping: float = DAMPING, broadcast_bytes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ranks of the left and of the right nodes: ``node, rank, degree, strength`` each.

    A node's rank is ``(1 - damping) / n`` plus ``damping`` times what its
    neighbours deal out: each deals its rank over its edges by weight. The left
    side starts with equal ranks; a round updates the right side and then the
    left. The ranks of a side sum to one in every round. Each update is written,
    so plans do not grow with the rounds, and holds one row per node.
    """
    return _ranked(df, left, right, rounds, damping, broadcast_bytes)[1:]


def collaboration_features(
    df: DataFrame, left: str, right: str, rounds: int = ROUNDS, damping: float = DAMPING, spread: list[str] | None = None
) -> DataFrame:
    """The rows with degree and rank of both their values, and the rows of their pair; null where a value is missing.

    New columns: ``<left>_degree``, ``<left>_rank``, the same for the right, and
    ``pair_count``. No target is read, so they may be computed over all rows.
    """
    lists, *ranked = _ranked(df, left, right, rounds, damping, None)
    lookups = {}
    for side, column, ranks in zip(("left", "right"), (left, right), ranked, strict=True):
        packed = ranks.withColumn("features", F.struct("degree", "rank"))
        lookups[side], _ = build_lookup(packed, "node", "features", "strength", f"collaboration-{column}")

    def named(found: Column, other: Column) -> list[Column]:
        sides = ((left, found), (right, other))
        return [features[f].alias(f"{column}_{f}") for column, features in sides for f in ("degree", "rank")]

    # A pair's own row gets the features of both its nodes, so that rows with both values are moved once.
    pairs = lists.with_lookup(lists.by, lookups[lists.by], "__by")
    pairs = lookup_join(pairs, lists.other, lookups[lists.other], "__other", ["left", "right"])
    of_left, of_right = ("__by", "__other") if lists.by == "left" else ("__other", "__by")
    values = F.struct(*named(F.col(of_left), F.col(of_right)), F.col("weight").alias("pair_count"))
    keyed = pairs.select(F.struct(F.col("left").alias("l"), F.col("right").alias("r")).alias("pair"), values.alias("found"), "weight")
    by_pair, _ = build_lookup(keyed, "pair", "found", "weight", "collaboration-pairs")

    both = F.col(left).isNotNull() & F.col(right).isNotNull()
    whole = df.filter(both).withColumn("__pair", F.struct(F.col(left).alias("l"), F.col(right).alias("r")))
    whole = lookup_join(whole, "__pair", by_pair, "__found", spread).select(*df.columns, "__found.*")
    part = lookup_join(lookup_join(df.filter(~both), left, lookups["left"], "__left", spread), right, lookups["right"], "__right", spread)
    none = F.lit(None).cast("bigint").alias("pair_count")
    return whole.unionByName(part.select(*df.columns, *named(F.col("__left"), F.col("__right")), none))
