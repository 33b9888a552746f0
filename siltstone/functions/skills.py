"""Terms of a hierarchical catalog found in text."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A small catalog of this domain, for tests and for use without a catalog file: family, group, canonical and variations.
DEFAULT = {
    "languages": {"general": [("python", ["python3"]), ("scala", []), ("java", []), ("rust", []), ("sql", ["ansi sql"])]},
    "processing": {"batch": [("spark", ["apache spark", "pyspark"]), ("dbt", []), ("trino", [])], "stream": [("flink", ["apache flink"]), ("kafka", ["apache kafka"])], "compute": [("ray", [])]},
    "platform": {"containers": [("docker", []), ("kubernetes", ["k8s"])], "iac": [("terraform", [])], "orchestration": [("airflow", ["apache airflow"])], "vcs": [("git", [])]},
    "storage": {"formats": [("parquet", []), ("iceberg", ["apache iceberg"])], "databases": [("postgres", ["postgresql"])]},
    "bi": {"tools": [("looker", [])]},
}


def flatten(catalog: dict) -> list[tuple[str, str, str, str]]:
    """(family, group, canonical, term) of a catalog tree; entries are (canonical, variations) or dicts with sub_skills.
    The key "config" and values that aren't trees are skipped; sub-skills without a name are, too."""
    out = []

    def add(family: str, group: str, name: str | None, variations: list | None) -> None:
        if name:
            out.extend((family, group, name, t.strip().lower()) for t in [name, *(variations or [])] if t and t.strip())

    for family, groups in catalog.items():
        if family == "config" or not isinstance(groups, dict):
            continue
        for group, entries in groups.items():
            if isinstance(entries, dict):
                add(family, group, entries.get("canonical", group), entries.get("variations"))
                for sub in entries.get("sub_skills") or []:
                    add(family, group, sub.get("canonical"), sub.get("variations"))
            elif isinstance(entries, list):
                for name, variations in entries:
                    add(family, group, name, variations)
    return out


def dimension(spark: SparkSession, catalog: dict | None = None) -> DataFrame:
    """The catalog as a table: one row per term. Catalogs are reference data of some thousand terms."""
    return spark.createDataFrame(flatten(catalog or DEFAULT), "family string, group_name string, canonical string, term string")


def detect(df: DataFrame, title: str, text: str, catalog: dict | None = None) -> DataFrame:
    """Adds skills_canonical, skills_families and skills_raw_hits: sorted distinct finds of whole terms in title and text.
    Null and blank texts find nothing. One compiled alternation per task, Arrow batches."""
    terms = flatten(catalog or DEFAULT)
    by: dict[str, list[tuple[str, str]]] = {}
    for family, _, canonical, term in terms:
        by.setdefault(term, []).append((canonical, family))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # overlapping terms all count, so each match looks ahead; longer terms are tried at each place in turn
        starts = re.compile(r"\b(?=(" + "|".join(re.escape(t) for t in sorted(by, key=len, reverse=True)) + r")\b)")
        prefixes = {t: [p for p in by if t.startswith(p) and re.match(re.escape(p) + r"\b", t)] for t in by}
        for pdf in batches:
            hits = []
            for t in pdf["_text"]:
                found = {p for m in starts.finditer(t.lower()) for p in prefixes[m.group(1)]} if isinstance(t, str) else set()
                hits.append(sorted(found))
            yield pdf.drop(columns="_text").assign(
                skills_canonical=[sorted({c for h in hs for c, _ in by[h]}) for hs in hits],
                skills_families=[sorted({f for h in hs for _, f in by[h]}) for hs in hits],
                skills_raw_hits=hits,
            )

    keep = [c for c in df.columns if c not in ("skills_canonical", "skills_families", "skills_raw_hits")]
    schema = ", ".join(f"`{n}` {t}" for n, t in df.select(*keep).dtypes) + ", skills_canonical array<string>, skills_families array<string>, skills_raw_hits array<string>"
    return df.select(*keep, F.concat_ws(" ", title, text).alias("_text")).mapInPandas(run, schema)


def match_terms(df: DataFrame, key: str, text: str, terms: DataFrame) -> DataFrame:
    """(key, canonical, family): the same finds by joining the runs of words of each text with the terms, in SQL; runs are as
    long as the longest term."""
    # a catalog has some thousand terms: one small job
    longest = terms.agg(F.max(F.size(F.split(F.trim("term"), r"\s+")))).first()[0] or 1
    words = F.split(F.regexp_replace(F.lower(F.col(text)), r"[^a-z0-9_]+", " "), " ")
    rows = df.select(key, words.alias("w"))

    def runs(n: int):
        return F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))

    every = F.array_distinct(F.concat(*[F.when(F.size("w") >= n, runs(n)).otherwise(F.array().cast("array<string>")) for n in range(1, longest + 1)]))
    return rows.select(key, F.explode(every).alias("term")).join(F.broadcast(terms), "term").select(key, "canonical", "family").distinct()
