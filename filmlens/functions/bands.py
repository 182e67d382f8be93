"""Bins and verdict bands. A null input falls into the last branch unless stated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rating bin edges and their labels.
RATING_EDGES = (5.0, 6.0, 7.0, 8.0)
RATING_LABELS = ("very low (<5)", "low (5-6)", "medium (6-7)", "good (7-8)", "excellent (8+)")

# Upper edges of the R2 bands, in the two scales in use.
R2_EDGES = (0.3, 0.5, 0.7)
R2_LABELS = ("low", "moderate", "good", "suspect")
R2_EDGES_INTRINSIC = (0.4, 0.6)
R2_LABELS_INTRINSIC = ("realistic", "acceptable", "suspect")


def below_edges(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """The label of the first edge the value lies below, else the last label."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one label more than edges is needed")
    chain = F.when(value < edges[0], labels[0])
    for edge, label in zip(edges[1:], labels[1:-1]):
        chain = chain.when(value < edge, label)
    return chain.otherwise(labels[-1])


def rating_bin(score: Column, edges: Sequence[float] = RATING_EDGES, labels: Sequence[str] = RATING_LABELS) -> Column:
    """Rating bin; a null score falls into the last one."""
    return below_edges(score, edges, labels)


def r2_band(r2: Column) -> Column:
    """Plausibility of an R2 for models that may see encoded targets."""
    return below_edges(r2, R2_EDGES, R2_LABELS)


def r2_band_intrinsic(r2: Column) -> Column:
    """Plausibility of an R2 for models on intrinsic predictors only."""
    return below_edges(r2, R2_EDGES_INTRINSIC, R2_LABELS_INTRINSIC)


def correlation_band(corr: Column) -> Column:
    """Strength of a correlation with the target; null is acceptable."""
    size = F.abs(corr)
    return F.when(size > 0.7, "strong").when(size > 0.5, "moderate").when(size > 0.3, "suspicious").otherwise("acceptable")


def encoding_band(corr: Column) -> Column:
    """Verdict on the correlation of an encoding with its own target."""
    return F.when(corr > 0.9, "leakage").when(corr > 0.7, "moderate").otherwise("acceptable")
