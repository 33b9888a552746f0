"""Writes: partition overwrite, upsert of late rows, text and table sinks, batches for queues, counts on the way."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.runtime import Scratch, file_system

PARTS = ["year", "month", "day", "hour"]


def overwrite_partitions(df: DataFrame, path: str, parts: list[str] = PARTS) -> None:
    """Replaces just the partitions that df has rows for."""
    (df.repartition(*parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*parts).parquet(path))


def append(df: DataFrame, path: str, parts: list[str] = PARTS) -> None:
    """Adds files to partitions."""
    df.repartition(*parts).write.mode("append").option("compression", "snappy").partitionBy(*parts).parquet(path)


def upsert(df: DataFrame, path: str, key: str, newest: Column, parts: list[str] = PARTS) -> DataFrame:
    """Late rows into their partitions: rows there and new rows united, the newest per key kept (null keys all), the
    result staged in shared storage and only then written over those partitions. Returns counts of the run.
    Running the same batch twice changes nothing."""
    spark = df.sparkSession
    scratch = Scratch(spark, "upsert")
    new = scratch.keep(df, "new")
    touched = new.select(*parts).distinct()
    fs, p = file_system(spark, path)
    every = new.withColumn("_old", F.lit(0))
    if fs.exists(p):
        old = spark.read.parquet(path)
        old = old.select(*[F.col(c).cast(t) for c, t in new.dtypes if c in old.columns]).join(F.broadcast(touched), parts, "left_semi")
        every = every.unionByName(old.withColumn("_old", F.lit(1)), allowMissingColumns=True)
    row = F.struct(*[F.col(c) for c in new.columns], "_old")
    best = every.filter(F.col(key).isNotNull()).groupBy(*parts, key).agg(F.max_by(row, F.struct(newest, F.xxhash64(*[F.to_json(F.struct(*new.columns))]))).alias("r"))
    final = best.select("r.*").unionByName(every.filter(F.col(key).isNull()).dropDuplicates())
    staged = scratch.keep(final, "final")
    combined = every.count()  # before its files are replaced
    overwrite_partitions(staged.drop("_old"), path, parts)
    return staged.agg(F.count("*").alias("final_rows"), F.sum("_old").alias("from_existing")).withColumn("combined_rows", F.lit(combined))


def single_file(df: DataFrame, path: str) -> None:
    """One file; for results of known small size."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def json_lines(df: DataFrame, path: str, metadata: list[str], result: list[str]) -> None:
    """Rows as {metadata, result} objects, one a line."""
    df.select(F.to_json(F.struct(F.struct(*metadata).alias("metadata"), F.struct(*result).alias("result"))).alias("value")).write.mode("overwrite").text(path)


def register(spark: SparkSession, name: str, path: str) -> None:
    """An external table over written Parquet, partitions recovered."""
    spark.sql(f"create table if not exists `{name}` using parquet location '{path}'")
    if spark.catalog.getTable(name) and spark.read.parquet(path).inputFiles():
        try:
            spark.sql(f"msck repair table `{name}`")
        except Exception as e:  # a table without partitions has none to recover
            if "NOT_A_PARTITIONED_TABLE" not in str(e):
                raise


def fan_out(df: DataFrame, key: str, size: int) -> DataFrame:
    """(batch_index, total_batches, ids): keys in order in batches of `size`. Ranks come from range partitions, so no
    task sorts all keys."""
    scratch = Scratch(df.sparkSession, "fan-out")
    parts = scratch.keep(df.select(key).repartitionByRange(F.col(key)).withColumn("_pid", F.spark_partition_id()))
    sizes = parts.groupBy("_pid").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    local = parts.withColumn("_k", F.row_number().over(W.partitionBy("_pid").orderBy(key)) - 1).join(starts, "_pid")
    total = F.ceil(F.lit(sizes.agg(F.sum("_n")).first()[0] or 0) / size)
    rank = F.col("_before") + F.col("_k")
    return local.groupBy(F.floor(rank / size).alias("batch_index")).agg(F.array_sort(F.collect_list(key)).alias("ids")).select("batch_index", total.alias("total_batches"), "ids")


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """df with row counts taken while it is written, instead of by reading it again."""
    o = Observation(name)
    return df.observe(o, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(df.columns[0]).isNull()).alias("null_keys")), o


def markdown(df: DataFrame, title: str) -> str:
    """A small result as a Markdown table."""
    rows = df.collect()
    head = "| " + " | ".join(df.columns) + " |\n|" + "---|" * len(df.columns)
    return f"# {title}\n\n{head}\n" + "\n".join("| " + " | ".join("" if v is None else json.dumps(v, default=str).strip('"') for v in r) + " |" for r in rows) + "\n"
