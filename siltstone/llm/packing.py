"""Items of varying length in containers of fixed capacity.

Bulk-synchronous best fit. Documents are range-sorted by size and ranked within equal sizes; open
containers are kept sorted by the gap they have left. A sweep goes down the sizes: every run of equal
documents is matched with its successor, the smallest gap that holds it, ranks settle which document of the
run goes to which container of equal gaps, the gaps shrink, and the sweep repeats until the run is placed
or opens new containers. Documents of one size are interchangeable, and so are containers with one gap, so
the sweep runs over runs: at most one per size and gap, bounded by the capacity and not by the documents.
Placing the documents is then one equi-join on size with their rank inside the run.

Defined results: null and blank texts have no tokens and are in no container. A text longer than the
capacity fills whole containers with its first pieces and its last piece is an item like any other; no
other text is split. Repeated rows with one doc_id are one document. Equal sizes are ordered by doc_id.
"""

from __future__ import annotations

import base64
import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltstone.runtime import Scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the split pattern of the public byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOADED: dict[str, object] = {}


def _encoder(path: str):
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, tokens of every text that isn't blank; whole texts, counted in Arrow batches."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(tokenizer).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "tokens": [len(enc(t)) for t in pdf["text"]]})

    rows = docs.select("doc_id", "text").filter("doc_id is not null and text is not null and trim(text) <> ''")
    counted = rows.mapInPandas(count, "doc_id bigint, tokens bigint")
    return counted.groupBy("doc_id").agg(F.max("tokens").alias("tokens"))


def ranked(items: DataFrame, groups: list[str], order: list[str], out: str = "rank") -> DataFrame:
    """Adds each row's 0-based rank by `order` within `groups` without a task that holds a whole group: rows are
    range-partitioned on groups and order, ranked within partitions, and shifted by the counts of the partitions before."""
    parts = items.repartitionByRange(*groups, *order).withColumn("_pid", F.spark_partition_id())
    scratch = Scratch(items.sparkSession, "rank")
    parts = scratch.keep(parts, "parts")
    sizes = parts.groupBy("_pid", *groups).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*groups).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    local = parts.withColumn("_local", F.row_number().over(W.partitionBy("_pid", *groups).orderBy(*order)) - 1)
    return local.join(sizes.withColumn("_before", before).drop("_n"), ["_pid", *groups]).withColumn(out, F.col("_local") + F.col("_before")).drop("_pid", "_local", "_before")


def sweep(runs: list[tuple[int, int]], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit of runs (size, documents), largest size first.

    Returns (size, first rank, last rank, first container, documents per container): documents of these ranks fill
    the containers from the first on, so many to each.
    """
    gaps: list[int] = []  # open gaps, ascending
    at: dict[int, list[tuple[int, int]]] = {}  # gap -> container ranges [first, last)
    out, opened = [], 0

    def put(gap: int, first: int, last: int) -> None:
        if gap > 0 and last > first:
            if gap not in at:
                bisect.insort(gaps, gap)
                at[gap] = []
            at[gap].append((first, last))

    for size, n in sorted(runs, reverse=True):
        rank = 0
        while rank < n:
            i = bisect.bisect_left(gaps, size)
            if i < len(gaps):
                gap = gaps[i]
                first, last = at[gap].pop()
                if not at[gap]:
                    del at[gap]
                    gaps.pop(i)
            else:
                gap, fit = capacity, capacity // size
                first, last = opened, opened + -(-(n - rank) // fit)
                opened = last
            # each container takes documents until none fits: its shrunken gap is the smallest that still holds one
            fit = gap // size
            whole = min(last - first, (n - rank) // fit)
            if whole:
                out.append((size, rank, rank + whole * fit - 1, first, fit))
                rank += whole * fit
                put(gap - fit * size, first, first + whole)
                first += whole
            if first < last and rank < n:
                left = n - rank
                if left < fit:
                    out.append((size, rank, n - 1, first, left))
                    rank = n
                    put(gap - left * size, first, first + 1)
                    first += 1
            put(gap, first, last)
    return out


def pack(sizes: DataFrame, specs: DataFrame, scratch: Scratch) -> DataFrame:
    """spec_id, container_id, doc_id, piece_no, tokens for documents (doc_id, tokens) and capacities (spec_id, capacity_tokens)."""
    specs = specs.filter("spec_id is not null and capacity_tokens > 0").groupBy("spec_id").agg(F.max("capacity_tokens").cast("bigint").alias("capacity"))
    # capacities are parameters: a handful of rows, taken in as literals
    wanted = [F.struct(F.lit(r.spec_id).cast("int").alias("spec_id"), F.lit(r.capacity).cast("bigint").alias("capacity")) for r in specs.collect()]
    if not wanted:
        wanted = [F.struct(F.lit(None).cast("int").alias("spec_id"), F.lit(None).cast("bigint").alias("capacity"))]
    both = sizes.filter("tokens > 0").select("doc_id", "tokens", F.inline(F.array(*wanted))).filter("spec_id is not null")
    whole = F.expr("if(tokens > capacity, (tokens - 1) div capacity, 0)")
    items = both.select("spec_id", "doc_id", "capacity", whole.alias("whole"), (F.col("tokens") - whole * F.col("capacity")).alias("size"))
    items = scratch.keep(ranked(items, ["spec_id", "size"], ["doc_id"]), "items")
    runs = items.groupBy("spec_id", "capacity", "size").agg(F.count("*").alias("n"))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = sweep([(int(s), int(n)) for s, n in zip(pdf["size"], pdf["n"], strict=True)], int(pdf["capacity"].iloc[0]))
        out = pd.DataFrame(rows, columns=["size", "low", "high", "first", "per"])
        out.insert(0, "spec_id", pdf["spec_id"].iloc[0])
        return out

    # one group is one capacity; it has at most `capacity` runs
    placed = scratch.keep(runs.groupBy("spec_id").applyInPandas(place, "spec_id int, size bigint, low bigint, high bigint, first bigint, per bigint"), "runs")
    # a run's slices are cut at a common width, so that the join stays an equi-join however many slices a size has
    width = 4096
    cut = placed.withColumn("block", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"high div {width}"))))
    joined = items.withColumn("block", F.expr(f"rank div {width}")).join(cut, ["spec_id", "size", "block"]).filter("rank between low and high")
    last = joined.select("spec_id", (F.col("first") + F.expr("(rank - low) div per")).alias("container_id"), "doc_id", F.col("whole").cast("int").alias("piece_no"), F.col("size").alias("tokens"))
    # whole pieces have containers of their own, numbered from -1 down
    long = items.filter("whole > 0").select("spec_id", "doc_id", "capacity", F.explode(F.sequence(F.lit(0), F.col("whole").cast("int") - 1)).alias("piece_no"))
    full = ranked(long, ["spec_id"], ["doc_id", "piece_no"]).select("spec_id", (-1 - F.col("rank")).alias("container_id"), "doc_id", "piece_no", F.col("capacity").alias("tokens"))
    return last.unionByName(full)


def fill(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """spec_id, n_containers, n_items, tokens, unused share and the lower bound of containers."""
    per = packed.groupBy("spec_id").agg(F.count_distinct("container_id").alias("n_containers"), F.count("*").alias("n_items"), F.sum("tokens").alias("tokens"))
    out = per.join(F.broadcast(specs.select("spec_id", F.col("capacity_tokens").cast("bigint").alias("capacity"))), "spec_id")
    return out.select("spec_id", "n_containers", "n_items", "tokens", F.round(1 - F.col("tokens") / (F.col("n_containers") * F.col("capacity")), 6).alias("unused_share"), F.expr("(tokens + capacity - 1) div capacity").alias("least_containers"))
