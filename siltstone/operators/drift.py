"""Schemas that drift between the files of a feed: changes reported, lines read into one table.

Each file's schema is taken from all its lines: fields with a non-null value, JSON type, names inside
objects, and a digest of all words of the values, a bitmap of one size. For each file and the one before it,
fields that went and fields that came are the nodes of two schema graphs, with edges to name parts, types, inner
names and value digests. Similarity flooding spreads match scores along those edges until they settle: a pair of
fields takes the evidence of its attributes' pairs and gives its own belief back to them, and pairs of name parts
and types are shared by all fields that have them. The settled score alone admits a pair, and a consistent
one-to-one selection, best first, gives the renames. Renames over all feeds tie names to canonical fields.

Defined results: lines that aren't JSON objects, and null feeds or files, count for nothing. A field that
is null in all lines isn't there. Files of one feed compare by file_seq; gaps compare with the next lower.
A field of mixed types has its most frequent type, ties by name. Repeated lines change nothing.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 8  # numbers of 63 bits in a digest of values
LEAST = 0.4  # settled score of a rename


def entries(feed: DataFrame) -> DataFrame:
    """One row per line and non-null field: where it stands, JSON type, inner names, value as text."""
    parsed = feed.select("line_id", "feed_id", "file_id", "file_seq", "line_no", "arrived_at", F.try_parse_json("payload").alias("_v"))
    rows = feed.sparkSession.sql(
        "select line_id, feed_id, file_id, file_seq, e.key as field, schema_of_variant(e.value) as t, e.value as v from {lines}, lateral variant_explode(_v) as e where e.key is not null",
        lines=parsed,
    )
    kind = (
        F.when(F.col("t").startswith("OBJECT"), "object").when(F.col("t").startswith("ARRAY"), "array").when(F.col("t") == "STRING", "string")
        .when(F.col("t") == "BOOLEAN", "boolean").when(F.col("t") != "VOID", "number")
    )
    return rows.withColumn("type", kind).filter("type is not null").withColumn("text", F.col("v").cast("string")).drop("v")


def file_schemas(lines: DataFrame) -> DataFrame:
    """One row per file and field."""
    value = F.when(F.col("type") == "object", F.coalesce(F.get_json_object("text", "$.value"), F.col("text"))).otherwise(F.col("text"))
    # words of whole values; numbers count by their length, other long codes by their form
    words = F.transform(F.split(F.lower(value), r"[^\p{L}0-9_]+"), lambda w: F.when(w.rlike(r"^[0-9]+$"), F.concat(F.lit("#"), F.length(w))).when(w.rlike(r"^[a-z]\d{3,}$"), F.lit("#code")).otherwise(w))
    keys = ["feed_id", "file_id", "file_seq", "field", "type"]
    per = lines.select(*keys, F.regexp_extract_all("t", F.lit(r"(\w+): "), 1).alias("inner"), F.explode_outer(F.array_distinct(words)).alias("w"))
    h = F.xxhash64("w")
    met = per.withColumn("slot", F.pmod(h, F.lit(SLOTS)).cast("int")).withColumn("lot", F.expr("if(w = '' or w is null, 0L, shiftleft(1L, cast(pmod(shiftright(xxhash64(w), 8), 63) as int)))"))
    # a bitmap and a set of inner names per file, field and type: of one size, whatever the lines
    digest = met.groupBy(*keys).agg(*[F.bit_or(F.when(F.col("slot") == i, F.col("lot")).otherwise(0)).alias(f"s{i}") for i in range(SLOTS)], F.array_sort(F.array_distinct(F.flatten(F.collect_set("inner")))).alias("inner"))
    lines_of = lines.groupBy(*keys).agg(F.count("*").alias("n"))
    top = digest.join(lines_of, keys).groupBy(*keys[:-1]).agg(F.max_by(F.struct("type", "inner", F.array(*[f"s{i}" for i in range(SLOTS)]).alias("shape")), F.struct("n", "type")).alias("b"))
    return top.select("feed_id", "file_id", "file_seq", "field", "b.type", "b.inner", "b.shape")


def name_parts(name: str) -> list[str]:
    """Words of a field's name, lower case, whatever the style."""
    return [w for w in re.split(r"[^a-z0-9]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()) if w]


def part_alike(a: str, b: str) -> float:
    """How alike two words of names are: equal, abbreviation, or a common stem."""
    if a == b:
        return 1.0
    short, long = sorted((a, b), key=len)
    if len(short) >= 3 and long.startswith(short):
        return 0.9
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(short))
    return 0.8 if n >= 5 and n >= 0.6 * len(short) else 0.0


# Words of names that tell the form and not the fact.
FORM = frozenset("json flag value is has id of list text num count the by in".split())


def telling(word: str) -> float:
    """How much a word of a name tells of the fact: words of form hardly, participles and the like little."""
    return 0.15 if word in FORM else 0.3 if re.fullmatch(r"\w{3,}(?:ed|able|ing)", word) else 1.0


def ones(shape: list[int]) -> int:
    return sum((x & (1 << 63) - 1).bit_count() for x in shape)


def values_alike(a: list[int], b: list[int]) -> float:
    """How alike two digests are, less where they hold few words: true and false, or numbers, tell little."""
    both, either = ones([x & y for x, y in zip(a, b, strict=True)]), ones([x | y for x, y in zip(a, b, strict=True)])
    full = either > 0.9 * 63 * SLOTS  # a full bitmap tells nothing
    return 0.0 if not either or full else both / either * min(1.0, both / 12)


def flood(gone: list[dict], came: list[dict], rounds: int = 1000, eps: float = 1e-6, share: float = 0.5) -> dict[tuple[str, str], float]:
    """Similarity flooding between the fields that went and those that came; scores between 0 and 1.

    Pairs of fields are tied to pairs of their name parts, types, inner names and value digests. In turn every attribute
    pair moves by `share` towards the best of its fields' beliefs, and every field pair takes its attributes' evidence:
    name parts weighted by how much they tell, digests beside them, type and inner names as a nudge.
    """
    base: dict[tuple, float] = {}
    fields: dict[tuple[str, str], dict] = {}
    users: dict[tuple, list[tuple[str, str]]] = {}

    def attribute(pair: tuple[str, str], key: tuple, score: float) -> tuple:
        base[key] = score
        users.setdefault(key, []).append(pair)
        return key

    for g in gone:
        for c in came:
            pair = (g["field"], c["field"])
            x, y = name_parts(pair[0]), name_parts(pair[1])
            fields[pair] = {
                "sides": [[(telling(w), [attribute(pair, ("part", *sorted((w, v))), part_alike(w, v)) for v in other]) for w in side] for side, other in ((x, y), (y, x))],
                "values": attribute(pair, ("values", *pair), values_alike(g["shape"], c["shape"])),
                "type": attribute(pair, ("type", g["type"], c["type"]), 1.0 if g["type"] == c["type"] else 0.5),
                "inner": attribute(pair, ("inner", *pair), len(set(g["inner"]) & set(c["inner"])) / len(set(g["inner"]) | set(c["inner"])) if g["inner"] or c["inner"] else 0.0),
            }
    now = dict(base)

    def believed(f: dict) -> float:
        # the part of each name's telling words that the other name has, against the name that tells less
        got = [sum(w * max((now[k] for k in keys), default=0.0) for w, keys in side) for side in f["sides"]]
        whole = [sum(w for w, _ in side) for side in f["sides"]]
        name = min(1.0, min(got) / max(1e-9, min(whole)))
        evidence = 1 - (1 - 0.85 * name) * (1 - 0.8 * now[f["values"]])
        return evidence * (0.9 + 0.07 * now[f["type"]] + 0.03 * now[f["inner"]])

    belief = {p: believed(f) for p, f in fields.items()}
    for _ in range(rounds):
        # what no value, name or type says stays at nothing: attributes move only within what they could be
        for k, pairs in users.items():
            now[k] = base[k] * ((1 - share) + share * max(belief[p] for p in pairs))
        new = {p: believed(f) for p, f in fields.items()}
        moved = max((abs(new[p] - belief[p]) for p in new), default=0.0)
        belief = new
        if moved < eps:
            return belief
    raise RuntimeError("similarity flooding doesn't settle")


def select_renames(gone: list[dict], came: list[dict], least: float = LEAST) -> list[tuple[str, str]]:
    """A one-to-one selection, best settled score first, of pairs that reach `least`."""
    scores = flood(gone, came)
    out, used_g, used_c = [], set(), set()
    for (g, c), v in sorted(scores.items(), key=lambda x: (-x[1], x[0])):
        if v >= least and g not in used_g and c not in used_c:
            out.append((g, c))
            used_g.add(g)
            used_c.add(c)
    return sorted(out)


def changes(schemas: DataFrame) -> DataFrame:
    """file_id, field_name, change_kind, old_name: each file against the one before it in its feed."""
    files = schemas.select("feed_id", "file_id", "file_seq").distinct()
    # a feed's files in order, linked by an equi-join on the rank; ranks are windowed over files, not lines
    from pyspark.sql import Window as W

    linked = files.withColumn("prev_id", F.lag("file_id").over(W.partitionBy("feed_id").orderBy("file_seq", "file_id"))).filter("prev_id is not null")
    cols = [F.struct("field", "type", "inner", "shape").alias("f")]
    new = schemas.select("file_id", *cols).join(linked.select("file_id"), "file_id").select("file_id", "f", F.lit(1).alias("side"))
    old = linked.select(F.col("prev_id"), F.col("file_id").alias("to")).join(schemas.select(F.col("file_id").alias("prev_id"), *cols), "prev_id").select(F.col("to").alias("file_id"), "f", F.lit(0).alias("side"))
    both = new.unionByName(old).groupBy("file_id", "f.field").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("old"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("new")
    )
    same = both.filter("old is not null and new is not null and old.type <> new.type").select("file_id", F.col("field").alias("field_name"), F.lit("retyped").alias("change_kind"), F.col("field").alias("old_name"))
    moved = both.filter("old is null or new is null")

    def match(pdf: pd.DataFrame) -> pd.DataFrame:
        fid = int(pdf["file_id"].iloc[0])
        gone = [o for o, n in zip(pdf["old"], pdf["new"], strict=True) if o is not None and n is None]
        came = [n for o, n in zip(pdf["old"], pdf["new"], strict=True) if n is not None and o is None]
        gone = sorted(({"field": x["field"], "type": x["type"], "inner": list(x["inner"]), "shape": [int(v) for v in x["shape"]]} for x in gone), key=lambda x: x["field"])
        came = sorted(({"field": x["field"], "type": x["type"], "inner": list(x["inner"]), "shape": [int(v) for v in x["shape"]]} for x in came), key=lambda x: x["field"])
        pairs = select_renames(gone, came) if gone and came else []
        old_type, new_type = {x["field"]: x["type"] for x in gone}, {x["field"]: x["type"] for x in came}
        out = [(fid, c, "renamed", g) for g, c in pairs] + [(fid, c, "retyped", g) for g, c in pairs if old_type[g] != new_type[c]]
        out += [(fid, x["field"], "removed", x["field"]) for x in gone if x["field"] not in {g for g, _ in pairs}]
        out += [(fid, x["field"], "added", None) for x in came if x["field"] not in {c for _, c in pairs}]
        return pd.DataFrame(out, columns=["file_id", "field_name", "change_kind", "old_name"])

    # one group is one file: as many rows as its fields changed
    found = moved.groupBy("file_id").applyInPandas(match, "file_id bigint, field_name string, change_kind string, old_name string")
    return same.unionByName(found)


def canonical_names(found: DataFrame, schemas: DataFrame) -> DataFrame:
    """field, canonical: names tied by renames share the one that most files use. Names are few: one per spelling of a field."""
    ties = found.filter("change_kind = 'renamed'").select(F.col("old_name").alias("a"), F.col("field_name").alias("b")).distinct()
    used = schemas.groupBy("field").agg(F.count("*").alias("n"))
    label = used.select("field", F.struct(F.col("n"), F.col("field")).alias("best"))
    edges = ties.unionByName(ties.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # names are few, so chains of renames are followed on the driver's side of a small table until nothing moves
    while True:
        near = edges.join(label.withColumnRenamed("field", "b"), "b").select(F.col("a").alias("field"), "best")
        new = label.unionByName(near).groupBy("field").agg(F.max("best").alias("best"))
        new = schemas.sparkSession.createDataFrame(new.collect(), new.schema)
        if not new.exceptAll(label).limit(1).count():
            return new.select("field", F.col("best.field").alias("canonical"))
        label = new


def unified(lines: DataFrame, names: DataFrame) -> DataFrame:
    """One consistent table: line_id, feed_id, file_id and a column per canonical field: boolean where any file has booleans,
    else array<string> where any has arrays, else double where all are numbers, else string; objects are unwrapped to their
    value. Values that can't be cast are null."""
    inner = F.when(F.col("type") == "object", F.coalesce(F.get_json_object("text", "$.value"), F.col("text"))).otherwise(F.col("text"))
    flat = lines.join(F.broadcast(names), "field").withColumn("text", inner)
    flags = names.join(lines.filter("type = 'boolean'").select("field").distinct(), "field").select("canonical", F.lit(True).alias("is_flag")).distinct()
    lists = names.join(lines.filter("type = 'array'").select("field").distinct(), "field").select("canonical", F.lit(True).alias("is_list")).distinct()
    flat = flat.join(F.broadcast(flags), "canonical", "left").join(F.broadcast(lists), "canonical", "left")
    text = F.trim("text")
    flag = F.when(F.lower(text).isin("true", "1", "yes"), "true").when(F.lower(text).isin("false", "0", "no"), "false")
    as_list = F.when(text.startswith("["), text).otherwise(F.to_json(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")))
    value = F.when(F.col("is_flag"), flag).when(F.col("is_list"), as_list).otherwise(text)
    one = flat.select("line_id", "feed_id", "file_id", "canonical", value.alias("value")).filter("value is not null")
    numbers = {r.canonical for r in flat.groupBy("canonical").agg(F.count_if(F.col("type") != "number").alias("n")).filter("n = 0").collect()}
    kinds = {r.canonical: (r.is_flag, r.is_list) for r in flat.select("canonical", "is_flag", "is_list").distinct().collect()}

    def typed(c: str):
        text = F.min(F.when(F.col("canonical") == c, F.col("value")))
        is_flag, is_list = kinds[c]
        return (text == "true" if is_flag else F.from_json(text, "array<string>") if is_list else text.try_cast("double") if c in numbers else text).alias(c)

    # one column per canonical field
    return one.groupBy("line_id", "feed_id", "file_id").agg(*[typed(c) for c in sorted(kinds)]) if kinds else one.select("line_id", "feed_id", "file_id")
