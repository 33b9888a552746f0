"""Streams: files landed in micro-batches, messages deduplicated, late rows upserted, states kept per key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siltstone.sources.sinks import upsert


def file_stream(spark: SparkSession, path: str, schema: str, max_files: int = 100) -> DataFrame:
    """New Parquet files of a folder; max_files a batch is the throttle."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def land(stream: DataFrame, path: str, checkpoint: str, key: str, newest: str, parts: list[str]) -> StreamingQuery:
    """Upserts every micro-batch into a partitioned table: a re-scrape replaces the older row, a batch run twice changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert(batch, path, key, F.col(newest), parts)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def once_within(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first of messages with equal keys; state is dropped once the watermark is `delay` past."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, width: str, delay: str, by: list[str]) -> DataFrame:
    """Rows per window and group, rows later than the watermark left out."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def unprocessed(batch: DataFrame, ledger: DataFrame, key: str, now: Column) -> DataFrame:
    """Rows whose key isn't in the ledger, or whose entry has outlived its time (a ttl column of timestamps)."""
    return batch.join(ledger.filter(F.col("ttl") > now).select(key).distinct(), key, "left_anti")


def ledger_entries(batch: DataFrame, key: str, now: Column, days: int = 90) -> DataFrame:
    """What a processed batch adds to the ledger."""
    return batch.select(key).distinct().select(key, now.alias("processed_at"), (now + F.expr(f"interval {days} days")).alias("ttl"))


def refresh(status: DataFrame, fetched: DataFrame, key: str, now: Column, good_days: int = 180, bad_days: int = 1) -> DataFrame:
    """Fetch results (key, ok, error) merged into the status table (key, status, next_refresh, created_at, last_error):
    next refresh late after success and soon after failure; created_at is kept, rows without news stay."""
    new = fetched.groupBy(key).agg(F.bool_or("ok").alias("ok"), F.max("error").alias("error"))
    both = status.join(new, key, "full_outer")
    told = F.col("ok").isNotNull()
    return both.select(
        key,
        F.when(told, F.when(F.col("ok"), "success").otherwise("failed")).otherwise(F.col("status")).alias("status"),
        F.when(told, now + F.when(F.col("ok"), F.expr(f"interval {good_days} days")).otherwise(F.expr(f"interval {bad_days} days"))).otherwise(F.col("next_refresh")).alias("next_refresh"),
        F.coalesce("created_at", now).alias("created_at"),
        F.when(told & ~F.col("ok"), F.col("error")).when(told, None).otherwise(F.col("last_error")).alias("last_error"),
    )


def job_states(events: DataFrame) -> DataFrame:
    """Events (job_id, pass_num, status, at) folded into one row per job: each pass's newest status and the overall one."""
    last = events.groupBy("job_id", "pass_num").agg(F.max_by("status", F.struct("at", "status")).alias("status"))
    p = last.groupBy("job_id").pivot("pass_num", [1, 2, 3]).agg(F.first("status"))
    cols = [F.coalesce(F.col(f"`{k}`"), F.lit("PENDING")).alias(f"pass{k}") for k in (1, 2, 3)]
    s = p.select("job_id", *cols)
    has = lambda v: (F.col("pass1") == v) | (F.col("pass2") == v) | (F.col("pass3") == v)
    overall = F.when(has("FAILED"), "FAILED").when((F.col("pass1") == "COMPLETED") & (F.col("pass2") == "COMPLETED") & (F.col("pass3") == "COMPLETED"), "COMPLETED")
    return s.withColumn("overall", overall.when(has("COMPLETED") | has("IN_PROGRESS"), "IN_PROGRESS").otherwise("PENDING"))


def split_dead(batch: DataFrame, errors: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with their errors, so that a batch isn't failed as a whole."""
    marked = batch.withColumn("errors", errors)
    return marked.filter("errors is null or errors = ''").drop("errors"), marked.filter("errors <> ''")


def not_cached(wanted: DataFrame, results: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Work whose result isn't stored yet."""
    return wanted if force else wanted.join(results.select(*keys).distinct(), keys, "left_anti")


def semaphore(events: DataFrame, capacity: int) -> DataFrame:
    """Acquire and release events (lock, at, holder, kind) replayed in order: granted is false where the lock was full.
    A lock's events are few and need their order, so each lock is one group."""

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        held, granted = set(), []
        for holder, kind in pdf.sort_values(["at", "holder"])[["holder", "kind"]].itertuples(index=False):
            ok = kind == "release" or holder in held or len(held) < capacity
            (held.discard if kind == "release" else held.add)(holder) if ok else None
            granted.append(ok)
        return pdf.sort_values(["at", "holder"]).assign(granted=granted)

    schema = ", ".join(f"{n} {t}" for n, t in events.dtypes)
    return events.groupBy("lock").applyInPandas(replay, schema + ", granted boolean")


def breaker(calls: DataFrame, limit: int = 5, cool_down_s: int = 300) -> DataFrame:
    """A stream of calls (model, at, ok) into (model, at, state): open after `limit` failures in a row, half open after
    the cool-down, closed again by a success. State lives per model in the state store."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        name, fails, opened = state.get if state.exists else ("CLOSED", 0, 0.0)
        rows = []
        for pdf in frames:
            for at, ok in pdf.sort_values("at")[["at", "ok"]].itertuples(index=False):
                t = pd.Timestamp(at).timestamp()
                if name == "OPEN" and t - opened >= cool_down_s:
                    name = "HALF_OPEN"
                if ok:
                    name, fails = ("CLOSED", 0) if name != "OPEN" else (name, fails)
                else:
                    fails += 1
                    if name == "HALF_OPEN" or fails >= limit:
                        name, opened = "OPEN", t
                rows.append((key[0], at, name))
        state.update((name, fails, opened))
        yield pd.DataFrame(rows, columns=["model", "at", "state"])

    return calls.groupBy("model").applyInPandasWithState(fold, "model string, at timestamp, state string", "name string, fails int, opened double", "append", GroupStateTimeout.NoTimeout)


def enrich(jobs: DataFrame, call, pass_num: int) -> DataFrame:
    """Model calls per job in Arrow batches: `call` takes a prompt and gives (answer, tokens); it is pluggable, for no
    model is reached from here."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [call(p) for p in pdf["prompt"]]
            yield pd.DataFrame({"job_id": pdf["job_id"], "pass_num": pass_num, "answer": [a for a, _ in got], "tokens": [n for _, n in got]})

    return jobs.select("job_id", "prompt").mapInPandas(run, "job_id bigint, pass_num int, answer string, tokens int")


def is_orphaned(taken_at: Column, now: Column, ended: Column, minutes: int = 30) -> Column:
    """Whether a lock is held longer than `minutes`, or its holder has ended or isn't there (null)."""
    return (taken_at < now - F.expr(f"interval {int(minutes)} minutes")) | F.coalesce(ended, F.lit(True))


def release_orphans(locks: DataFrame, holders: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """The locks (holder, taken_at, ...) that stay: without those of holders that are unknown, have ended, or hold too long."""
    known = holders.groupBy("holder").agg(F.bool_or("ended").alias("_ended"))
    return locks.join(known, "holder", "left").filter(~is_orphaned(F.col("taken_at"), now, F.col("_ended"), minutes)).drop("_ended")


def with_retries(call, tries: int = 3, first: float = 1.0, wait=None):
    """Calls until it succeeds, waiting twice as long after each failure; the last failure is raised."""
    import time

    for n in range(tries):
        try:
            return call()
        except Exception:
            if n == tries - 1:
                raise
            (wait or time.sleep)(first * 2**n)
