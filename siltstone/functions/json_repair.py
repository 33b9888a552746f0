"""JSON objects recovered from model answers: as they are, from a fence, by balancing braces, or after known clutter is removed."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FENCE = re.compile(r"```(?:json)?\s*(.*?)```", re.DOTALL | re.IGNORECASE)
_CLUTTER = re.compile(r"<think>.*?</think>|</?(?:reasoning|answer|response|output)>|^\s*(?:here is|here's|sure|certainly)[^{]*", re.DOTALL | re.IGNORECASE)
_TRAILING = re.compile(r",(\s*[}\]])")


def _load(text: str) -> dict | None:
    try:
        value = json.loads(text)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _balanced(text: str) -> str | None:
    """The first complete {...}, strings and escapes respected."""
    begin = text.find("{")
    if begin < 0:
        return None
    depth, quoted, escaped = 0, False, False
    for k in range(begin, len(text)):
        c = text[k]
        if escaped:
            escaped = False
        elif c == "\\":
            escaped = quoted
        elif c == '"':
            quoted = not quoted
        elif not quoted and c in "{}":
            depth += 1 if c == "{" else -1
            if not depth:
                return text[begin : k + 1]
    return None


def repair(text: str | None) -> tuple[str | None, str | None]:
    """The object as compact JSON and no error, or none and the reason. Only objects are accepted."""
    if not isinstance(text, str) or not text.strip():
        return None, "empty"
    fence = _FENCE.search(text)
    bare = _CLUTTER.sub("", text)
    for attempt in (text, fence and fence.group(1), _balanced(text), _balanced(bare), _TRAILING.sub(r"\1", _balanced(bare) or "")):
        if attempt and (value := _load(attempt.strip())) is not None:
            return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False), None
    return None, "no JSON object"


@F.pandas_udf(T.StructType([T.StructField("object", T.StringType()), T.StructField("error", T.StringType())]))
def repair_json(texts: pd.Series) -> pd.DataFrame:
    """repair() over Arrow batches."""
    return pd.DataFrame([repair(t) for t in texts], columns=["object", "error"])
