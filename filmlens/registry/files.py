"""CSV scans and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filmlens.registry.core import query
from filmlens.registry.tables import table
from filmlens.sources.csv_files import read_csv
from filmlens.sources.sinks import save_head, write_csv
from filmlens.sources.staging import staging_path


def _through_csv(df: DataFrame, name: str, **read_options: bool) -> DataFrame:
    path = staging_path(df.sparkSession, name)
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema, **read_options)


@query("scan_csv_escaped", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def scan_csv_escaped(spark: SparkSession, sf: str) -> DataFrame:
    return _through_csv(table(spark, sf, "events"), "events-csv")


@query("scan_csv_multiline", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_csv_multiline(spark: SparkSession, sf: str) -> DataFrame:
    return _through_csv(table(spark, sf, "documents"), "documents-csv", multi_line=True)


@query("scan_csv_plain", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_plain(spark: SparkSession, sf: str) -> DataFrame:
    return _through_csv(table(spark, sf, "customer"), "customer-csv", quote_escape=False)


@query(
    "sink_roundtrip",
    "SELECT p_partkey, p_name, p_size, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100",
)
def sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    path = staging_path(spark, "parts-head")
    save_head(parts, path, 100, [F.desc("p_retailprice"), F.asc("p_partkey")], fmt="json")
    return spark.read.schema(parts.schema).json(path)
