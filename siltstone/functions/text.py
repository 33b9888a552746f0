"""Text functions: markup, words, keys and similarity."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def html_to_text(c: Column) -> Column:
    """Text without tags, white space as single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"[ \t\n\f\r]+", " "))


def words(c: Column, least: int = 3) -> Column:
    """Lower-case words of at least so many characters."""
    return F.filter(F.split(F.regexp_replace(F.lower(c), r"[^a-z0-9_\s-]", " "), r"\s+"), lambda w: F.length(w) >= least)


def ngrams(array: Column, n: int, joint: str = "_") -> Column:
    """Running groups of n elements."""
    last = F.size(array) - n
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(array, i + 1, n), joint))).otherwise(F.array().cast("array<string>"))


def bucket(c: Column, n: int = 50) -> Column:
    """The MD5 of a text as a number, modulo n; 0 for null. Taken by Horner's rule over four 32-bit words."""
    h = F.md5(c)
    word = lambda k: F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("bigint")
    step, out = (1 << 32) % n, F.lit(0).cast("bigint")
    for k in range(4):
        out = (out * step + word(k)) % n
    return F.when(c.isNull(), 0).otherwise(out).cast("int")


def short_key(c: Column) -> Column:
    """First 16 hexadecimal digits of a text's MD5."""
    return F.substring(F.md5(c), 1, 16)


def content_key(*cols: str) -> Column:
    """MD5 of a row's content, fields in order of name."""
    return F.md5(F.to_json(F.struct(*[F.col(c) for c in sorted(cols)])))


def category(c: Column, keywords: dict[str, list[str]], default: str = "other") -> Column:
    """The first category one of whose keywords a text holds."""
    out = F.lit(default)
    for name, ks in reversed(list(keywords.items())):
        hit = F.lit(False)
        for k in ks:
            hit = hit | F.contains(F.lower(c), F.lit(k))
        out = F.when(hit, name).otherwise(out)
    return F.when(c.isNull(), default).otherwise(out)


def normal_title(c: Column) -> Column:
    """A job title without seniority words, lower case."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"\b(senior|sr\.?|junior|jr\.?|lead|staff|principal|graduate|entry-level|mid-level)(\s|$)", ""), r"\s+", " "))


def has_words(c: Column, wanted: list[str]) -> Column:
    """Whether a text holds all words, whole and in any case."""
    out = F.lit(True)
    for w in wanted:
        out = out & c.rlike(rf"(?i)(^|[^A-Za-z0-9_]){w}([^A-Za-z0-9_]|$)")
    return out


@F.pandas_udf(T.DoubleType())
def likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two texts; no built-in measures it."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if isinstance(x, str) and isinstance(y, str) else None for x, y in zip(a, b, strict=True)], dtype="float64")


# Words that say nothing of a technology.
GENERIC = ("work", "working", "good", "strong", "great", "experience", "skills", "ability", "knowledge")


def probably_non_tech(term: Column) -> Column:
    """Whether a lower-case term is a figure, speaks of hiring, has hardly a letter, or is made of generic words only."""
    words = F.filter(F.split(term, " "), lambda x: ~x.isin(*GENERIC))
    return term.rlike(r"^[0-9.,%$€£ ]+$") | term.rlike(r"\b(years?|months?|benefits?|salary|team|company|office)\b") | (F.length(F.regexp_replace(term, "[^a-z]", "")) < 2) | (F.size(words) == 0)
