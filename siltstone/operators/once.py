"""Messages delivered at least once, kept exactly once.

A delivery is known by up to two identifiers, company with instant and message id; deliveries that share either,
directly or through others, are one message, named by the smallest of its identifiers. The store holds one winner
per message, in partitions of the month it was received in and a share of the delivery ids, and an index from
identifier to message and partition. A batch looks its identifiers up, ties them together with the messages that
they lead to, joins the winners of the affected partitions with its own deliveries, recomputes one winner per
message and writes new versions of just those partitions; a manifest that is renamed into place makes the change
atomic. The index grows by one part a batch and is merged into one whenever it has COMPACT parts.

Defined results: of equal messages the smallest (received_at, delivery_id) wins; null received_at loses to
any time. A delivery without any identifier is a message of its own. Rows with one delivery_id are one delivery,
so a batch that comes again changes nothing; null delivery_ids are left out. Empty batches change nothing.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.runtime import file_system

ROW = "delivery_id bigint, message_key string, received_at timestamp, part string"
INDEX = "ident string, message_key string, part string, seq int"
SHARES = 4  # of a month's deliveries: the tasks that write it
COMPACT = 8  # parts of the index that are merged into one


def plain_id(c: str) -> Column:
    """An identifier without padding, a decimal zero or leading zeros."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(F.col(c))), r"^0+(?=\d)|\.0+$", ""), F.lit(""))


def slug(c: str) -> Column:
    """The company's name within its page address, however the address is written."""
    return F.nullif(F.regexp_extract(F.lower(F.trim(F.col(c))), r"/company/([^/?#]+)", 1), F.lit(""))


def keyed(messages: DataFrame, companies: DataFrame) -> DataFrame:
    """delivery_id, message_key, received_at, part. A company is known by its id, or through its address by the
    directory of companies (a reference table, one row per company)."""
    directory = companies.select(slug("linkedin_url").alias("_slug"), plain_id("company_id").alias("_cid")).filter("_slug is not null and _cid is not null")
    directory = directory.groupBy("_slug").agg(F.min("_cid").alias("_cid"))
    rows = messages.select(
        "delivery_id",
        plain_id("company_id").alias("_id"),
        slug("company_url").alias("_slug"),
        F.regexp_replace(F.lower(F.trim("message_id")), r"^msg:|[{}\s]", "").alias("_mid"),
        F.unix_micros(F.try_to_timestamp(F.trim("first_seen_at"))).alias("_at"),
        F.col("received_at").cast("timestamp").alias("received_at"),
    )
    company = F.coalesce("_id", "_cid", F.concat(F.lit("/"), F.col("_slug")))
    key = F.when(company.isNotNull() & F.col("_at").isNotNull(), F.concat_ws("@", company, F.col("_at").cast("string")))
    mid = F.concat(F.lit("m:"), F.nullif(F.col("_mid"), F.lit("")))
    alone = F.concat(F.lit("d:"), F.col("delivery_id").cast("string"))
    joined = rows.join(directory, "_slug", "left").filter("delivery_id is not null")
    month = F.coalesce(F.date_format("received_at", "yyyy-MM"), F.lit("none"))
    share = F.pmod(F.xxhash64("delivery_id"), F.lit(SHARES)).cast("string")
    return joined.select("delivery_id", F.coalesce(key, mid, alone).alias("ident"), F.when(key.isNotNull(), mid).alias("other"), "received_at", F.concat_ws("-", month, share).alias("part"))


def same_message(edges: DataFrame, keep) -> DataFrame:
    """(ident, message_key): the smallest identifier that each is tied to, however far; edges (ident, other). keep writes a table."""
    both = keep(edges.unionByName(edges.select(F.col("other").alias("ident"), F.col("ident").alias("other"))).distinct(), "edges")
    label = keep(both.groupBy("ident").agg(F.min(F.least("ident", "other")).alias("message_key")), "label-0")
    n = 0
    while True:
        n += 1
        near = both.join(label.select(F.col("ident").alias("other"), "message_key"), "other").groupBy("ident").agg(F.min("message_key").alias("near"))
        new = label.join(near, "ident").select("ident", F.least("message_key", "near").alias("message_key"), (F.col("near") < F.col("message_key")).alias("moved"))
        new = keep(new, f"label-{n}")
        label = new.select("ident", "message_key")
        if not new.filter("moved").limit(1).count():
            return label


class MessageStore:
    """Winners, identifier index and surplus deliveries under one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.fs, path = file_system(spark, self.root)
        self.fs.mkdirs(path)
        self._path = spark._jvm.org.apache.hadoop.fs.Path

    def manifest(self) -> dict:
        """The newest committed state: sequence number, partition folders, index and surplus folders."""
        names = [f.getPath().getName() for f in self.fs.listStatus(self._path(self.root))]
        done = sorted(n for n in names if n.startswith("manifest-"))
        if not done:
            return {"seq": 0, "parts": {}, "index": [], "surplus": []}
        return json.loads("".join(r.value for r in self.spark.read.text(f"{self.root}/{done[-1]}").collect()))

    def _commit(self, state: dict) -> None:
        seq, tmp = state["seq"], self._path(f"{self.root}/_new-{state['seq']}")
        out = self.fs.create(tmp, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not self.fs.rename(tmp, self._path(f"{self.root}/manifest-{seq:09d}")):
            raise RuntimeError(f"another writer committed batch {seq}")

    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _index(self, state: dict) -> DataFrame:
        """The newest row of each identifier."""
        rows = self._read(state["index"], INDEX)
        return rows.groupBy("ident").agg(F.max_by(F.struct("message_key", "part"), "seq").alias("r")).select("ident", "r.message_key", "r.part") if len(state["index"]) > 1 else rows.drop("seq")

    def merge(self, incoming: DataFrame) -> None:
        """Takes in one batch of keyed deliveries."""
        state = self.manifest()
        seq = state["seq"] + 1
        base = f"{self.root}/v{seq:09d}"

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{base}/{name}")
            return self.spark.read.schema(df.schema).parquet(f"{base}/{name}")

        incoming = keep(incoming.groupBy("delivery_id").agg(F.min(F.struct("received_at", "ident", "other", "part")).alias("r")).select("delivery_id", "r.*"), "incoming")
        # what the batch's identifiers lead to, and what those lead to
        ids = incoming.select(F.explode(F.array_compact(F.array("ident", "other"))).alias("ident")).distinct()
        known = self._read([], "ident string, message_key string, part string")
        if state["index"]:
            index, n = self._index(state), 0
            while True:
                known = keep(index.join(ids, "ident", "left_semi"), f"known-{n}")
                more = known.select(F.col("message_key").alias("ident")).distinct().join(ids, "ident", "left_anti")
                if not more.limit(1).count():
                    break
                ids, n = keep(ids.unionByName(more), f"ids-{n}"), n + 1
        edges = incoming.select("ident", F.coalesce("other", "ident").alias("other")).unionByName(known.select("ident", F.col("message_key").alias("other")))
        label = same_message(edges, keep)
        # names of partitions: months by shares, however many messages there are
        touched = {r.part for r in known.select("part").distinct().collect()}
        fresh = {r.part for r in incoming.select("part").distinct().collect()}
        affected = sorted(touched | fresh)
        held = self._read([p for a in affected for p in state["parts"].get(a, [])], ROW)
        old = held.join(label.select(F.col("ident").alias("message_key"), F.col("message_key").alias("now")), "message_key", "left")
        old = old.select("delivery_id", F.coalesce("now", "message_key").alias("message_key"), "received_at", "part")
        every = old.unionByName(incoming.join(label, "ident").select("delivery_id", "message_key", "received_at", "part"))
        first = F.struct(F.col("received_at").isNull().alias("late"), "received_at", "delivery_id", "part")
        best = every.groupBy("message_key").agg(F.min(first).alias("w"))
        won = keep(best.select("w.delivery_id", "message_key", "w.received_at", F.col("w.part").alias("part")), "winners")
        # partitions are as many as months times shares, each written by one task
        won.repartition("part").sortWithinPartitions("message_key").withColumn("p", F.col("part")).write.mode("overwrite").partitionBy("p").parquet(f"{base}/data")
        lost = every.select("delivery_id").distinct().join(won.select("delivery_id"), "delivery_id", "left_anti")
        lost.write.mode("overwrite").parquet(f"{base}/surplus")
        # every identifier of a touched message with its message's name and partition; names are identifiers too
        rows = label.join(won.select("message_key", "part"), "message_key").select("ident", "message_key", "part", F.lit(seq).alias("seq"))
        rows.write.mode("overwrite").parquet(f"{base}/index")
        parts = dict(state["parts"])
        for a in affected:
            path = f"{base}/data/p={a}"
            parts[a] = [path] if self.fs.exists(self._path(path)) else []
        new = {"seq": seq, "parts": parts, "index": [*state["index"], f"{base}/index"], "surplus": [*state["surplus"], f"{base}/surplus"]}
        if len(new["index"]) >= COMPACT:
            self._index(new).withColumn("seq", F.lit(seq)).write.mode("overwrite").parquet(f"{base}/index-all")
            self.surplus(new).write.mode("overwrite").parquet(f"{base}/surplus-all")
            new |= {"index": [f"{base}/index-all"], "surplus": [f"{base}/surplus-all"]}
        self._commit(new)

    def winners(self) -> DataFrame:
        """One row per message."""
        return self._read([p for ps in self.manifest()["parts"].values() for p in ps], ROW)

    def surplus(self, state: dict | None = None) -> DataFrame:
        """Every delivery that isn't a winner, once."""
        return self._read((state or self.manifest())["surplus"], "delivery_id bigint").distinct()


def run_batches(messages: DataFrame, companies: DataFrame, root: str, rounds: int = 3) -> MessageStore:
    """Feeds all deliveries to a new store in the order of their batches, gathered into `rounds` merges: batches are numbered
    by the minute and hold a handful of deliveries each. The result doesn't depend on how they are gathered."""
    store = MessageStore(messages.sparkSession, root)
    order = F.coalesce(F.regexp_extract("batch_id", r"(\d+)\D*$", 1).try_cast("bigint"), F.lit(0))
    cuts = messages.select(order.alias("b")).agg(F.percentile_approx("b", [i / rounds for i in range(1, rounds)], 1000)).first()[0] or []
    edges = [None, *sorted(set(cuts)), None]
    for low, high in zip(edges, edges[1:], strict=False):
        inside = F.lit(True)
        inside = inside & (order > low) if low is not None else inside
        inside = inside & (order <= high) if high is not None else inside
        store.merge(keyed(messages.filter(inside), companies))
    return store
