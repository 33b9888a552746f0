"""Instants out of timestamp texts of many forms.

Every form is one branch of a single regular expression with named groups. One replace call writes the
groups of whichever branch matched into fixed slots; ranges are checked and the instant is assembled by
integer arithmetic on days. Nothing leaves the JVM.

Defined results: null, blank or unreadable text, a day without a time, impossible calendar values, unknown
zones, local times that a zone skipped or showed twice, and texts without zone from an unknown source all
give a null instant. Fractions finer than microseconds are cut off; missing seconds are 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import fence

# Abbreviations that name one offset, in minutes east of UTC.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "IST": 330, "BRT": -180, "BRST": -120, "AST": -240, "ADT": -180, "EST": -300,
    "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420, "JST": 540,
}
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

_ZONE = r"(?: ?(?<z{0}>[+-]\d{{2}}:?\d{{2}}|[+-]\d{{2}}|[A-Z]{{1,5}})| ?\[(?<r{0}>[A-Za-z0-9_+/-]+)\])?"
_CLOCK = r"(?<h{0}>\d{{1,2}}):(?<n{0}>\d{{2}})(?::(?<s{0}>\d{{2}})(?:[.,](?<f{0}>\d{{1,9}}))?)?"
BRANCHES = (
    (r"(?<y{0}>\d{{4}})-(?<m{0}>\d{{1,2}})-(?<d{0}>\d{{1,2}})[Tt ]" + _CLOCK + _ZONE).format(1),
    (r"(?<y{0}>\d{{4}})(?<m{0}>\d{{2}})(?<d{0}>\d{{2}})T(?<h{0}>\d{{2}})(?<n{0}>\d{{2}})(?<s{0}>\d{{2}})?" + _ZONE).format(2),
    (r"(?<d{0}>\d{{1,2}})\.(?<m{0}>\d{{1,2}})\.(?<y{0}>\d{{4}}),? " + _CLOCK + _ZONE).format(3),
    (r"(?<a{0}>\d{{1,2}})/(?<b{0}>\d{{1,2}})/(?<y{0}>\d{{4}}),? " + _CLOCK + r"(?: ?(?<p{0}>[AaPp])\.?[Mm]\.?)?" + _ZONE).format(4),
    (r"(?:[A-Za-z]{{2,9}},? )?(?<d{0}>\d{{1,2}})[ -](?<k{0}>[A-Za-z]{{3,9}})\.?[ -](?<y{0}>\d{{4}}),? " + _CLOCK + r"(?: ?(?<p{0}>[AaPp])[Mm])?" + _ZONE).format(5),
    r"(?<e6>\d{19}|\d{16}|\d{13}|\d{10})",
)
PATTERN = r"^\s*(?:" + "|".join(BRANCHES) + r")\s*$"
SLOTS = "ymdhnsfpzrabke"
MARK = "\u0001"


def _replacement() -> str:
    return MARK.join("".join(f"${{{s}{i}}}" for i in range(1, 7) if f"?<{s}{i}>" in PATTERN) for s in SLOTS)


def known_zones(spark) -> list[str]:
    """The zone names the JVM knows."""
    return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds())


def _offset(micros: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(F.timestamp_micros(micros), zone)) - micros


def instants(df: DataFrame, text: str, zone: str, date_order: str, out: str = "utc_us", keep: list[str] | None = None) -> DataFrame:
    """Adds `out`: microseconds since 1970-01-01 UTC that `text` stands for, or null.

    zone and date_order name columns with the clock and the order of day and month (DMY or MDY) of the row's source;
    they count only for texts that name no zone, and for dates with slashes. keep: columns to return (all of df's).
    """
    keep = keep or df.columns
    zones = known_zones(df.sparkSession)
    slots = F.split(F.regexp_replace(F.col(text), PATTERN, _replacement()), MARK, -1)
    base = fence(df.select(*keep, F.col(zone).alias("_zone"), F.col(date_order).alias("_order"), slots.alias("_slots")))

    def slot(s: str) -> Column:
        return F.when(F.size("_slots") == len(SLOTS), F.get("_slots", F.lit(SLOTS.index(s))))

    number = lambda s: slot(s).try_cast("int")
    first, second, mdy = number("a"), number("b"), F.col("_order") == "MDY"
    month_at = F.instr(F.lit(MONTHS), F.lower(F.substring(slot("k"), 1, 3)))
    parts = base.select(
        *keep,
        "_zone",
        number("y").alias("_y"),
        F.coalesce(number("m"), F.when(mdy, first).otherwise(second), F.when((slot("k") != "") & (month_at % 3 == 1), F.floor(month_at / 3).cast("int") + 1)).alias("_m"),
        F.coalesce(number("d"), F.when(mdy, second).otherwise(first)).alias("_d"),
        number("h").alias("_h12"),
        number("n").alias("_n"),
        F.coalesce(number("s"), F.lit(0)).alias("_s"),
        F.coalesce(F.substring(F.rpad(slot("f"), 6, "0"), 1, 6).try_cast("int"), F.lit(0)).alias("_f"),
        F.lower(slot("p")).alias("_p"),
        slot("z").alias("_z"),
        slot("r").alias("_r"),
        slot("e").alias("_e"),
    )
    abbr = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    sign, digits = F.substring("_z", 1, 1), F.regexp_replace("_z", "[^0-9]", "")
    minutes = F.when(
        F.col("_z").rlike(r"^[+-]"),
        F.when(sign == "-", -1).otherwise(1) * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))),
    ).otherwise(F.try_element_at(abbr, F.col("_z")))
    parts = fence(parts)
    checked = parts.select(
        *keep,
        "_y", "_m", "_d", "_n", "_s", "_f", "_e",
        F.when(F.coalesce(F.col("_p"), F.lit("")) == "", F.when(F.col("_h12") < 24, F.col("_h12")))
        .when(F.col("_h12").between(1, 12), F.col("_h12") % 12 + F.when(F.col("_p") == "p", 12).otherwise(0)).alias("_h"),
        F.when(F.coalesce(F.col("_z"), F.lit("")) != "", minutes).alias("_off"),
        F.when(F.coalesce(F.col("_z"), F.lit("")) != "", None)
        .when(F.coalesce(F.col("_r"), F.lit("")) != "", F.when(F.col("_r").isin(zones), F.col("_r")))
        .otherwise(F.when(F.col("_zone").isin(zones), F.col("_zone"))).alias("_tz"),
    )
    leap = "(_y % 4 = 0 and _y % 100 <> 0 or _y % 400 = 0)"
    length = f"case when _m = 2 then if({leap}, 29, 28) when _m in (4, 6, 9, 11) then 30 else 31 end"
    valid = f"_y between 1 and 9999 and _m between 1 and 12 and _d between 1 and {length} and _h is not null and _n < 60 and _s < 60"
    # days since 1970-01-01 of a proleptic Gregorian date, counted in 400-year cycles from 1 March
    y = "(_y - if(_m <= 2, 1, 0))"
    doy = "((153 * (_m + if(_m > 2, -3, 9)) + 2) div 5 + _d - 1)"
    days = f"(({y} div 400) * 146097 + ({y} % 400) * 365 + ({y} % 400) div 4 - ({y} % 400) div 100 + {doy} - 719468)"
    local = fence(checked).select(
        *keep,
        "_off", "_tz",
        F.expr("case length(_e) when 10 then cast(_e as bigint) * 1000000 when 13 then cast(_e as bigint) * 1000 when 16 then cast(_e as bigint) when 19 then cast(_e as bigint) div 1000 end").alias("_epoch"),
        F.expr(f"case when {valid} then (({days} * 86400L) + _h * 3600 + _n * 60 + _s) * 1000000L + _f end").alias("_local"),
    )
    day = 86_400_000_000
    zoned = F.col("_tz").isNotNull() & F.col("_local").isNotNull()
    sides = fence(local).select(
        *keep, "_off", "_tz", "_epoch", "_local",
        F.when(zoned, _offset(F.col("_local") - day, F.col("_tz"))).alias("_before"),
        F.when(zoned, _offset(F.col("_local") + day, F.col("_tz"))).alias("_after"),
    )
    fits = lambda o: _offset(F.col("_local") - F.col(o), F.col("_tz")) == F.col(o)
    one = (
        F.when(F.col("_before") == F.col("_after"), F.when(fits("_before"), F.col("_local") - F.col("_before")))
        .when(fits("_before") & ~fits("_after"), F.col("_local") - F.col("_before"))
        .when(~fits("_before") & fits("_after"), F.col("_local") - F.col("_after"))
    )
    fixed = F.when(F.abs("_off") <= 18 * 60, F.col("_local") - F.col("_off").cast("bigint") * 60_000_000)
    sides = fence(sides)
    return fence(sides.select(*keep, F.coalesce(F.col("_epoch"), F.when(F.col("_off").isNotNull(), fixed).otherwise(F.when(zoned, one))).alias(out)))


def normalise_fields(df: DataFrame, key: str, fields: list[str], feeds: DataFrame) -> DataFrame:
    """(record_id, field_name, text, source_system, utc_us): one row per field of each row, read with its source's clock."""
    names = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields])
    long = df.select(F.col(key).alias("record_id"), "source_system", F.explode(names).alias("_v")).select("record_id", "source_system", "_v.field_name", "_v.text")
    clocks = feeds.select("source_system", F.col("zone_id").alias("_zone_id"), F.col("date_order").alias("_date_order")).dropDuplicates(["source_system"])
    joined = long.join(clocks, "source_system", "left")
    return instants(joined, "text", "_zone_id", "_date_order", keep=["record_id", "field_name", "text", "source_system"])
