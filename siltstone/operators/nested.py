"""Deeply nested JSON records as related flat tables.

Each record is parsed once, in Python batches, into triples of path, ordinals and value: a path names the
fields on the way down with [] for each array level, the ordinals are the positions in those arrays. Paths
are grouped by their repeated ancestor (the path up to its last []), and each group is pivoted into one
table whose key is the record and the ordinals, so a child's key begins with its parent's. A record's triples
come about in one place, so they are grouped and pivoted there, and nothing is shuffled.

Defined results: text that isn't valid JSON (broken off, null, blank) gives no triples. Null elements keep
their position and give no value. Where a field is declared repeated, a lone object counts as an array of
one, text holding a JSON array or object as that, and other text or scalars as an element whose `name`
field is the text.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRIPLE = "record_id bigint, path string, ordinals array<int>, value string, kind string"


def triples_of(text: str | None, repeated: dict[str, str]) -> Iterator[tuple[str, list[int], str | None, str]]:
    """Path, ordinals, value and JSON type of every leaf and every element of a record."""
    try:
        if not text:
            return
        root = json.loads(text)
    except (ValueError, RecursionError):
        return
    stack = [("", [], root, None)]
    while stack:
        path, at, value, key = stack.pop()
        if key in repeated:
            if isinstance(value, str):
                try:
                    inner = json.loads(value)
                except (ValueError, RecursionError):
                    inner = None
                value = inner if isinstance(inner, list | dict) else [value]
            if value is not None and not isinstance(value, list):
                value = [value]
        if isinstance(value, list):
            name = repeated.get(key)
            for i, x in reversed(list(enumerate(value))):
                if name and x is not None and not isinstance(x, dict | list):
                    x = {name: x}
                stack.append((path + "[]", [*at, i], x, None))
        elif isinstance(value, dict):
            if path.endswith("[]"):
                yield path, at, None, "object"
            for k, x in reversed(list(value.items())):
                stack.append((f"{path}.{k}" if path else k, at, x, k))
        elif value is None:
            yield path, at, None, "null"
        elif isinstance(value, bool):
            yield path, at, "true" if value else "false", "boolean"
        elif isinstance(value, str):
            yield path, at, value, "string"
        else:
            yield path, at, str(int(value)) if isinstance(value, float) and value.is_integer() else str(value), "number"


def triples(df: DataFrame, key: str, text: str, repeated: dict[str, str] | None = None) -> DataFrame:
    """All triples of a table's JSON texts; repeated maps array fields to the name field of their elements."""
    repeated = repeated or {}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(int(k), *t) for k, x in zip(pdf["k"], pdf["x"], strict=True) if pd.notna(k) for t in triples_of(x, repeated)]
            yield pd.DataFrame(out, columns=["record_id", "path", "ordinals", "value", "kind"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("x")).mapInPandas(parse, TRIPLE)


def ancestor(path: str) -> str:
    """The repeated ancestor of a path: all up to its last []."""
    head, mark, _ = path.rpartition("[]")
    return head + mark


GROUPED = "record_id bigint, grp string, ordinals array<int>, fields map<string, string>"


def grouped(df: DataFrame, key: str, text: str, repeated: dict[str, str] | None = None, wanted: str | None = None) -> DataFrame:
    """GROUPED rows: one for each element of each repeated ancestor (grp; "" for the record itself) with the leaves below it,
    by their path from there ("" for an array's plain values). wanted: a pattern of the paths to keep."""
    repeated = repeated or {}
    needed = re.compile(wanted) if wanted else None

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, x in zip(pdf["k"], pdf["x"], strict=True):
                if pd.isna(k):
                    continue
                rows: dict[tuple, dict[str, str]] = {}
                for path, at, value, _ in triples_of(x, repeated):
                    if needed and not needed.search(path):
                        continue
                    group = ancestor(path)
                    row = rows.setdefault((group, tuple(at)), {})
                    if value is not None:
                        row[path[len(group) :].lstrip(".")] = value
                out.extend((int(k), g, list(at), row) for (g, at), row in rows.items())
            yield pd.DataFrame(out, columns=["record_id", "grp", "ordinals", "fields"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("x")).mapInPandas(parse, GROUPED)


def groups(rows: DataFrame) -> dict[str, list[str]]:
    """The leaves of every group: as many as the records' schema has, whatever their number."""
    got = rows.select("grp", F.explode_outer(F.map_keys("fields")).alias("leaf")).distinct().groupBy("grp").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    return {r.grp: list(r.leaves) for r in got.collect()}


def pivot(rows: DataFrame, group: str, leaves: dict[str, str]) -> DataFrame:
    """One table: record_id, ordinals, the parent's ordinals and, for each output column, the leaf of that path below the group."""
    mine = rows.filter(F.col("grp") == group)
    parent = F.slice("ordinals", 1, F.greatest(F.size("ordinals") - 1, F.lit(0)))
    return mine.select("record_id", "ordinals", parent.alias("parent_ordinals"), *[F.try_element_at("fields", F.lit(leaf)).alias(out) for out, leaf in leaves.items()])


def tables(rows: DataFrame) -> dict[str, DataFrame]:
    """Every group as its table, by the group's path; columns are named by the leaves' paths with underscores, clashes numbered."""
    out = {}
    for group, leaves in groups(rows).items():
        names: dict[str, str] = {}
        for leaf in leaves:
            base = re.sub(r"\W+", "_", leaf).strip("_").lower() or "value"
            base = f"{base}_" if base in ("record_id", "ordinals", "parent_ordinals") else base
            name = next(n for n in (base, *(f"{base}_{i}" for i in range(2, len(leaves) + 2))) if n not in names)
            names[name] = leaf
        out[group] = pivot(rows, group, names)
    return out


# The repeated fields of pass results, with the field that names their elements.
PASS_ARRAYS = {"must_have_skills": "skill", "benefits": "benefit", "evidence": "quote", "terms": "tier"}
# Child tables of pass results: kind, end of the group's path, naming leaf, and whether it is a child's child.
PASS_TABLES = (("skill", "must_have_skills[]", "skill", False), ("skill_evidence", "must_have_skills[].evidence[]", "quote", True), ("benefit", "benefits[]", "benefit", False), ("benefit_term", "benefits[].terms[]", "tier", True))
TOKENS = r"enrichment_input_tokens(?:\.value)?$"


def pass_items(results: DataFrame, scratch) -> DataFrame:
    """pass_file_id, child_kind, pos, sub_pos, item_text: roots, skills, evidence, benefits and terms of pass results."""
    rows = scratch.keep(grouped(results, "pass_file_id", "payload", PASS_ARRAYS, rf"^result\b.*(?:\b(?:skill|quote|benefit|tier)$|{TOKENS})"), "grouped")
    entry = rows.select("record_id", "grp", "ordinals", F.explode("fields").alias("leaf", "value")).filter(F.col("leaf").rlike(rf"(?:^|\.){TOKENS}"))
    digits = F.regexp_replace("value", r"\.0+$|[\s,_']", "")
    path = F.concat_ws(".", "grp", "leaf")
    roots = entry.filter(digits.rlike(r"^\d+$")).groupBy("record_id").agg(F.min_by(digits, F.struct(F.length(path), path, "ordinals")).alias("item_text"))
    out = roots.select("record_id", F.lit("root").alias("child_kind"), F.lit(-1).alias("pos"), F.lit(-1).alias("sub_pos"), "item_text")
    # an element's position is its last ordinal, a parent's the last but one, whatever arrays lie above
    last, before = F.element_at("ordinals", -1), F.try_element_at("ordinals", F.lit(-2))
    case = [(F.concat(F.lit("."), "grp").endswith(f".{end}"), kind, leaf, child) for kind, end, leaf, child in PASS_TABLES]
    pick = lambda f: F.coalesce(*[F.when(cond, f(kind, leaf, child)) for cond, kind, leaf, child in case])
    items = rows.filter("size(ordinals) > 0").select(
        "record_id",
        pick(lambda kind, leaf, child: F.lit(kind)).alias("child_kind"),
        pick(lambda kind, leaf, child: before if child else last).alias("pos"),
        pick(lambda kind, leaf, child: last if child else F.lit(-1)).alias("sub_pos"),
        pick(lambda kind, leaf, child: F.try_element_at("fields", F.lit(leaf))).alias("item_text"),
    )
    out = out.unionByName(items.filter("child_kind is not null and item_text is not null"))
    return out.select(F.col("record_id").alias("pass_file_id"), "child_kind", F.col("pos").cast("int"), F.col("sub_pos").cast("int"), "item_text")
