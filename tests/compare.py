"""Runs a registered query and its SQL counterpart and compares types and rows."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark_df, con, sql) -> list[str]:
    """Empty when column names, types and the multiset of rows agree."""
    relation = con.sql(sql)
    names = sorted(spark_df.columns)
    if names != sorted(relation.columns):
        return [f"columns {names} vs {sorted(relation.columns)}"]
    spark_types = {n: _TYPES.get(t, t) for n, t in spark_df.dtypes}
    duck_types = {n: str(t) for n, t in zip(relation.columns, relation.types)}
    found = [f"type of {n}: {spark_types[n]} vs {duck_types[n]}" for n in names if spark_types[n] != duck_types[n]]
    ours = _sorted_rows(spark_df.select(*[f"`{n}`" for n in names]).collect())
    theirs = _sorted_rows(con.sql("SELECT " + ", ".join(f'"{n}"' for n in names) + f" FROM ({sql})").fetchall())
    if len(ours) != len(theirs):
        return found + [f"rows {len(ours)} vs {len(theirs)}"]
    # By text, so that types and the sign of zero count too.
    wrong = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
    if wrong:
        found.append(f"{len(wrong)} of {len(ours)} rows differ, first {str(wrong[0])[:400]}")
    if not ours:
        found.append("no rows")
    return found


def main(sf_dir: str, wanted: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.monotonic()
        try:
            df = run(spark, sf_dir)
            if name in oracles:
                found = differences(df, con, oracles[name])
                note = "ok" if not found else "; ".join(found)
            else:
                n = len(df.collect())
                found = [] if n else ["no rows"]
                note = f"rows only: {n}"
        except Exception as e:  # noqa: BLE001
            found = [str(e)[:600]]
            note = "FAILED " + found[0]
        bad += bool(found)
        print(f"{'  ' if not found else '!!'} {name:28s} {time.monotonic() - started:6.2f}s {note}", flush=True)
    print(f"{bad} of {len(entry.queries())} wrong")
    return bad


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
