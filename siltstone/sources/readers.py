"""Reads: Bronze JSON with a declared schema, path-derived columns, snapshots, lookups by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.runtime import file_system

BRONZE = (
    "job_posting_id string, timestamp string, url string, company_id string, company_name string, job_title string, job_location string, country_code string, "
    "base_salary struct<min_amount: double, max_amount: double, currency: string, payment_period: string>, job_description_formatted string, "
    "input struct<url: string>, error string, error_code string, _corrupt_record string"
)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def bronze(spark: SparkSession, path: str, schema: str = BRONZE) -> DataFrame:
    """JSON lines of a partition or of a whole tree; a missing or empty folder is an empty table, broken lines keep their
    text in _corrupt_record. JSON-lines files are preferred, whole-file JSON is read where there are none."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    r = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("recursiveFileLookup", True)
    lines = r.option("pathGlobFilter", "*.jsonl").json(path)
    return lines if lines.inputFiles() else r.option("pathGlobFilter", "*.json").option("multiLine", True).json(path)


def with_path_columns(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Columns out of each row's file path: name -> pattern with one group."""
    return df.select("*", *[F.regexp_extract(F.col("_metadata.file_path"), p, 1).alias(n) for n, p in patterns.items()])


def partitions(df: DataFrame, parts: list[str]) -> DataFrame:
    """The partitions that a table has; read from paths alone."""
    return df.select(*parts).distinct()


def key_map(key: str) -> dict[str, str]:
    """"year=2025/month=01" as a map."""
    return dict(p.split("=", 1) for p in key.strip("/").split("/") if "=" in p)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def snapshots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Company snapshots, one JSON object a file, with the date of their name; unreadable files are left out."""
    r = spark.read.schema(schema + ", _corrupt_record string").option("multiLine", True).option("recursiveFileLookup", True).json(path)
    dated = with_path_columns(r, {"snapshot": r"snapshot_(\d{4}-\d{2}-\d{2})"})
    return dated.filter("_corrupt_record is null").drop("_corrupt_record")


def latest_snapshot(df: DataFrame, key: str) -> DataFrame:
    """The newest snapshot of each key."""
    return df.groupBy(key).agg(F.max_by(F.struct(*df.columns), "snapshot").alias("r")).select("r.*")


def point(df: DataFrame, key: str, value: str) -> DataFrame:
    """The row of one id; the filter reaches the scan."""
    return df.filter(F.col(key) == value).limit(1)


def newest(df: DataFrame, parts: list[str], limit: int, required: list[str]) -> DataFrame:
    """At most `limit` rows of the newest partitions that have all required fields."""
    for c in required:
        df = df.filter(F.col(c).isNotNull() & (F.trim(c) != ""))
    return df.orderBy(*[F.desc(p) for p in parts]).limit(limit)


def enabled(config: DataFrame) -> DataFrame:
    """Messages of the sources that are switched on."""
    return config.filter("enabled").drop("enabled").select(F.to_json(F.struct("*")).alias("message")) if "enabled" in config.columns else config.limit(0)
