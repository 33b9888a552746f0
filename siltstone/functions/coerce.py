"""Values of mixed types coerced to one type, as columns. Every function gives null where it can't read its input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_bool(c: Column) -> Column:
    """"true" and "false" as booleans, all else null."""
    return F.when(c == "true", True).when(c == "false", False)


def loose_bool(text: Column) -> Column:
    """JSON text read for its truth: booleans as they are; strings true for true, yes and 1; numbers unless 0; arrays and
    objects unless empty; null stays null."""
    t = F.trim(text)
    word = F.lower(F.trim(F.regexp_replace(t, '^"|"$', "")))
    return (
        F.when(text.isNull() | (t == "null"), None)
        .when(t.isin("true", "false"), t == "true")
        .when(t.startswith('"'), word.isin("true", "yes", "1"))
        .when(t.rlike(r"^[\[{]"), ~t.rlike(r"^(\[\s*\]|\{\s*\})$"))
        .otherwise(F.coalesce(t.try_cast("double") != 0, word.isin("true", "yes", "1")))
    )


def number(c: Column) -> Column:
    """A number without thousands commas and currency signs."""
    return F.nullif(F.trim(F.translate(c, ",$€£", "")), F.lit("")).try_cast("double")


def text(c: Column) -> Column:
    """Trimmed text, blank as null."""
    return F.nullif(F.trim(c), F.lit(""))


def items(c: Column) -> Column:
    """A JSON array of strings, or a comma list, as trimmed non-blank strings."""
    listed = F.when(F.trim(c).startswith("["), F.from_json(c, "array<string>")).otherwise(F.split(c, ","))
    return F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def whole(c: Column) -> Column:
    """"1001344.0" and the like as whole numbers, cut towards zero."""
    return c.try_cast("double").try_cast("bigint")


def json_or_null(array: Column) -> Column:
    """JSON text of an array, null where it is null or empty."""
    return F.when(F.size(array) > 0, F.to_json(array))


def score(c: Column) -> Column:
    """A number, or the number in an object's value field."""
    return F.coalesce(F.get_json_object(c, "$.value").try_cast("double"), F.regexp_extract(c, r"^\s*(-?[0-9.]+)\s*$", 1).try_cast("double"))


def day(c: Column) -> Column:
    """The date that a text begins with."""
    return F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).cast("date")


def populated(c: Column) -> Column:
    """Whether a text says anything."""
    return c.isNotNull() & ~F.lower(F.trim(c)).isin("", "-", "[]", "not_mentioned", "none", "n/a")


def short_model(c: Column) -> Column:
    """A model id up to its colon, dots as dashes."""
    return F.replace(F.get(F.split(c, ":"), F.lit(0)), F.lit("."), F.lit("-"))


def prompt(c: Column, limit: int) -> Column:
    """Text of at most `limit` characters, marked where it was cut, "N/A" for null."""
    t = F.coalesce(c, F.lit("N/A"))
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit), F.lit("... [TRUNCATED]"))).otherwise(t)
