"""The queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from filmlens.llm import (
    conversations,
    decontaminate,
    html_text,
    licenses,
    mixing,
    near_dup,
    pii,
    quality,
    resampling,
    secrets,
    substrings,
    suffix_array,
    toxicity,
)

_MODULES = (quality, decontaminate, mixing, near_dup, pii, secrets, toxicity, substrings, suffix_array, html_text, licenses, conversations, resampling)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {module.NAME: module.query for module in _MODULES}


def oracle_sql() -> dict[str, str]:
    return {module.NAME: module.ORACLE_SQL for module in _MODULES if module.ORACLE_SQL}
