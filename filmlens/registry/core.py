"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    run: Run
    oracle: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name`` with its SQL counterpart."""

    def add(run: Run) -> Run:
        if name in ENTRIES:
            raise ValueError(f"query {name} is registered twice")
        ENTRIES[name] = Entry(name, run, oracle)
        return run

    return add


def queries() -> dict[str, Run]:
    return {name: entry.run for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.oracle for name, entry in ENTRIES.items() if entry.oracle is not None}
