"""Quantities recorded in different units, brought to one unit.

Pay statements are read out of fields and text as (amount, notation, period), a notation being a currency
text with whatever scale it carries ("kUSD", "US cents", "₹ lakh"). Records of one posting tie the
notations together: a notation that is an ISO code of fx_rates is an anchor, each posting's anchored value
is the hub that the posting's other statements are compared with, and every other notation's scale is the
robust centre of those log ratios, snapped to a known conversion (a currency's rate times a power of ten or
a lakh). Notations solved in one round anchor the next. So the notation graph is solved through postings
without forming pairs within a posting.

Defined results: rows in which amount, currency or period is stated nowhere, zero or negative amounts,
and notations that neither the graph nor the fixed values resolve give no row. Repeated rows give one
result each. Where the fields and the text both state a part, the field counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import Scratch, fence

MARK = "\u0001"

# Period texts (lower case, without leading slash) by period code.
PERIODS = {
    "year": ["year", "yearly", "annual", "annually", "yr", "per year", "a year", "p.a.", "per annum", "pro jahr", "im jahr", "par an", "al año", "anual"],
    "month": ["month", "monthly", "mo", "per month", "a month", "mtl.", "mensal", "pro monat", "im monat", "par mois", "al mes", "mensual"],
    "week": ["week", "weekly", "wk", "per week", "a week", "pro woche", "die woche", "par semaine", "a la semana"],
    "day": ["day", "daily", "day rate", "daily rate", "per day", "a day", "p/d", "pro tag", "am tag", "par jour", "al día"],
    "hour": ["hour", "hourly", "hr", "per hour", "an hour", "pro stunde", "die stunde", "stunde", "par heure", "por hora"],
}
# Symbols and names of currencies.
CURRENCIES = {
    "USD": ["usd", "us$", "$", "us dollar", "us dollars"], "EUR": ["eur", "€", "euro", "euros"], "GBP": ["gbp", "£", "pound sterling"],
    "CAD": ["cad", "ca$", "c$"], "BRL": ["brl", "r$"], "INR": ["inr", "₹", "rs.", "rs"], "CHF": ["chf", "sfr.", "sfr"],
}
# Scales written with a currency, as affixes of its texts, and names of subunits.
SCALES = {"k": "1000", "(thousands)": "1000", "cents": "0.01", "centavos": "0.01", "lakh": "100000", "lakhs": "100000"}
NAMED = {"teur": ("EUR", "1000"), "eurocent": ("EUR", "0.01"), "gbx": ("GBP", "0.01"), "pence": ("GBP", "0.01"), "paise": ("INR", "0.01"),
         "rappen": ("CHF", "0.01"), "us cents": ("USD", "0.01"), "lpa": ("INR", "100000"), "lakh": ("INR", "100000"), "lakhs": ("INR", "100000")}

_MONEY = r"(?:US\$|CA\$|C\$|R\$|SFr\.|Rs\.|[$€£₹]|[A-Z]{3}\b)"
_NUMBER = r"\d[\d.,]*(?<![.,])"
_TIMES = "|".join(sorted((p.replace(".", r"\.") for ps in PERIODS.values() for p in ps), key=len, reverse=True))
# One pay statement of a text: a cue that speaks of pay, currency, lowest amount, scale, highest amount, period.
PAY = (
    r"(?s)^.*?(?:\b(?:Pay range|Pay:|Pay|Salary:|From|We offer|Compensation:|CTC|Offer:|Package of|Gehalt ab|Gehalt:|Vergütung:|Vergütung ab))\s+"
    rf"(?<c>{_MONEY})?\s?(?<a>{_NUMBER})\s?(?<k>[kK]\b|lakhs?\b|LPA\b)?"
    rf"(?:\s?(?:-|–|to|bis)\s?(?:{_MONEY})?\s?{_NUMBER}\s?(?<j>[kK]\b|lakhs?\b|LPA\b)?)?"
    rf"\s?(?<e>€|EUR)?(?:\s?(?:brutto|gross))?\s?/?\s?(?<p>(?i:{_TIMES})(?![a-zA-Z]))?.*$"
)
PAY_CURRENCY = rf"(?s)^.*?(?:[Pp]aid in|All amounts in)\s+(?<c>{_MONEY}).*$"
PAY_PERIOD = rf"(?s)^.*?(?:is stated|is quoted)\s+/?(?<p>(?i:{_TIMES})(?![a-zA-Z])).*$"


def _groups(text: Column, pattern: str, names: str) -> Column:
    """The named groups of the first match as an array of strings, null where the pattern doesn't match."""
    got = F.split(F.regexp_replace(text, pattern, MARK + MARK.join(f"${{{n}}}" for n in names)), MARK, -1)
    return F.when(F.size(got) == len(names) + 1, got)


def with_amount(df: DataFrame, text: str, scaled: Column, out: str) -> DataFrame:
    """Adds the number that a column's text writes. The last of two kinds of separator, or a lone one not followed by
    exactly three digits, is the decimal mark; beside a scale ("8,75k") a lone separator always is."""
    c = F.col(text)
    marks = fence(df.withColumn("_marks", F.regexp_replace(c, "[0-9]", "")).withColumn("_tail", F.regexp_extract(c, r"[.,](\d+)$", 1)))
    both = F.col("_marks").contains(".") & F.col("_marks").contains(",")
    lone = (F.length("_marks") == 1) & (scaled | (F.length("_tail") != 3))
    cut = marks.withColumn("_tail", F.when((F.col("_tail") != "") & (both | lone), F.col("_tail")).otherwise(""))
    digits = cut.withColumn("_digits", F.regexp_replace(c, "[.,]", ""))
    head = F.expr("substring(_digits, 1, length(_digits) - length(_tail))")
    return digits.withColumn(out, F.concat_ws(".", head, F.nullif(F.col("_tail"), F.lit(""))).try_cast("decimal(20,4)")).drop("_marks", "_tail", "_digits")


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _period(text: Column) -> Column:
    """The code of a period text, null if it is none."""
    return F.try_element_at(_map({t: code for code, ts in PERIODS.items() for t in ts}), F.trim(F.regexp_replace(F.lower(F.trim(text)), r"^/\s*", "")))


def statements(postings: DataFrame) -> DataFrame:
    """Adds _amount (decimal), _notation and _period, each null where the row states none."""
    field = F.lower(F.trim("salary_currency"))
    text = F.translate("job_summary", "\u00a0\u202f\u2009", "   ")
    split = fence(postings.select(
        "*",
        _groups(field, rf"^(?<c>.+?)\s*(?:[-/]\s*|\s)/?(?<p>{_TIMES})$", "cp").alias("_cp"),
        _groups(text, PAY, "cakjep").alias("_pay"),
        _groups(text, PAY_CURRENCY, "c").alias("_pc"),
        _groups(text, PAY_PERIOD, "p").alias("_pp"),
    ))
    blank = lambda c: F.when(F.trim(c) != "", F.lower(F.trim(c)))
    pay = lambda i: F.get("_pay", F.lit(i))
    vague = ["local", "n/a", "unknown", "none", "-"]
    parts = split.select(
        *postings.columns,
        pay(2).alias("_number"),
        F.coalesce(blank(pay(3)), blank(pay(4)), F.lit("")).alias("_scale"),
        F.coalesce(blank(pay(1)), blank(pay(5))).alias("_unit"),
        F.coalesce(F.get("_cp", F.lit(1)), blank(F.col("salary_currency"))).alias("_field"),
        blank(F.get("_pc", F.lit(1))).alias("_paid"),
        _period(F.col("salary_period")).alias("_p1"),
        _period(F.get("_cp", F.lit(2))).alias("_p2"),
        _period(pay(6)).alias("_p3"),
        _period(F.get("_pp", F.lit(1))).alias("_p4"),
    )
    parts = fence(parts)
    of_field = F.col("salary_min") > 0
    lakh = F.col("_scale").isin("lpa", "lakh", "lakhs")
    parts = parts.select(
        *postings.columns, "_number", "_scale", "_unit", "_paid", "_p1", "_p2",
        F.when(of_field, 1).otherwise(0).alias("_from_field"),
        F.when(~F.col("_field").isin(vague), F.col("_field")).alias("_field"),
        F.coalesce("_p3", F.when(F.col("_scale") == "lpa", "year"), "_p4").alias("_p3"),
        F.when(lakh, "lakh").when(F.col("_scale") == "k", "k").alias("_affix"),
    )
    parts = with_amount(fence(parts), "_number", F.col("_scale") != "", "_stated")
    parts = fence(parts)
    # a field's amount has the field's notation and takes only a currency from the text, whose scale is that of its own amount
    own = F.coalesce("_field", "_unit", F.when(F.col("_affix") == "lakh", "inr"), "_paid")
    texts = F.coalesce("_unit", F.when(F.col("_affix") == "lakh", "inr"), "_paid", "_field")
    return parts.select(
        *postings.columns,
        F.when(F.col("_from_field") == 1, F.col("salary_min").cast("decimal(20,4)")).otherwise(F.col("_stated")).alias("_amount"),
        F.when(F.col("_from_field") == 1, own).when(texts.isNotNull(), F.concat_ws(" ", texts, "_affix")).alias("_notation"),
        F.when(F.col("_from_field") == 1, F.coalesce("_p1", "_p2", "_p3")).otherwise(F.coalesce("_p3", "_p1", "_p2")).alias("_period"),
    )


def posting_key(c: str = "job_posting_id") -> Column:
    """A posting's id however it is written: its last run of ten digits or more without leading zeros, else the trimmed text."""
    digits = F.regexp_extract(F.col(c), r"0*(\d{10,})(?:\.0+)?\D*$", 1)
    return F.when(digits != "", digits).otherwise(F.nullif(F.lower(F.trim(F.col(c))), F.lit("")))


def lexicon() -> dict[str, tuple[str, str]]:
    """What the fixed values say of a notation: currency and scale."""
    out = {n: v for n, v in NAMED.items()}
    for code, texts in CURRENCIES.items():
        for t in texts:
            out[t] = (code, "1")
            for s, x in SCALES.items():
                out |= {f"{t} {s}": (code, x), f"{t}{s}": (code, x)} | ({f"k{t}": (code, x)} if s == "k" else {})
    return out


def solve_notations(stated: DataFrame, fx: DataFrame, periods: DataFrame, support: int = 8, agreement: float = 0.9) -> DataFrame:
    """(notation, currency_code, scale, n, share, offset, origin): what each notation means.

    stated: entity, notation, amount, period. A notation needs `support` entities of which `agreement` snap to one
    conversion (within 2 %), with an offset below 2 % of the typical value; else the fixed values decide. Rounds go on until
    one solves nothing new: there are at most as many as notations.
    """
    per_year = stated.join(F.broadcast(periods.select(F.col("period_code").alias("period"), "per_year")), "period").select(
        "entity", "notation", F.log(F.col("amount").cast("double") * F.col("per_year")).alias("v")
    )
    # one value per posting and notation, however often a posting was scraped
    scratch = Scratch(stated.sparkSession, "notations")
    seen = scratch.keep(per_year.groupBy("entity", "notation").agg(F.percentile_approx("v", 0.5, 1000).alias("v")), "seen")
    scales = F.explode(F.array(*[F.lit(x) for x in ("1", "1000", "0.01", "100000")])).alias("scale")
    # log conversions, each under the 2 % wide buckets that it and its neighbours fall into
    choices = fx.select("currency_code", "usd_rate", scales).select("currency_code", "scale", F.log(F.col("usd_rate") * F.col("scale").cast("double")).alias("w"))
    bucket = lambda c: F.floor(F.col(c) / 0.02)
    choices = choices.withColumn("k", F.explode(F.array(bucket("w") - 1, bucket("w"), bucket("w") + 1)))
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("n", "bigint"), ("share", "double"), ("offset", "double"))]
    solved = fx.select(F.lower("currency_code").alias("notation"), "currency_code", F.lit("1").alias("scale"), F.log("usd_rate").alias("w"), *nothing, F.lit("anchor").alias("origin"))
    while True:
        known = seen.join(F.broadcast(solved.select("notation", "w")), "notation")
        hub = known.groupBy("entity").agg(F.percentile_approx(F.col("v") + F.col("w"), 0.5, 1000).alias("hub"))
        ratio = seen.join(F.broadcast(solved.select("notation")), "notation", "left_anti").join(hub, "entity").withColumn("r", F.col("hub") - F.col("v"))
        centre = ratio.groupBy("notation").agg(F.percentile_approx("r", 0.5, 10000).alias("m")).withColumn("k", bucket("m"))
        near = centre.join(F.broadcast(choices), "k").filter(F.abs(F.col("m") - F.col("w")) < 0.02)
        snapped = near.groupBy("notation").agg(F.min_by(F.struct("currency_code", "scale", "w"), F.abs(F.col("m") - F.col("w"))).alias("to"))
        close = F.abs(F.col("r") - F.col("to.w")) < 0.02
        checked = ratio.join(F.broadcast(snapped), "notation").groupBy("notation", "to").agg(
            F.count("*").alias("n"),
            F.avg(close.cast("int")).alias("share"),
            F.percentile_approx(F.exp("hub") - F.exp(F.col("v") + F.col("to.w")), 0.5).alias("offset"),
            F.percentile_approx(F.exp("hub"), 0.5).alias("typical"),
        )
        new = checked.filter((F.col("n") >= support) & (F.col("share") >= agreement) & (F.abs("offset") < 0.02 * F.col("typical")))
        # a table of notations, cut off from the round before
        new = scratch.keep(new.select("notation", "to.currency_code", "to.scale", "to.w", "n", "share", "offset", F.lit("graph").alias("origin")).coalesce(1), "solved")
        if not new.limit(1).count():
            break
        solved = solved.unionByName(new)
    words = [(t, c, x, "fixed") for t, (c, x) in lexicon().items()]
    fixed = stated.sparkSession.createDataFrame(words, "notation string, currency_code string, scale string, origin string")
    rest = fixed.join(solved.select("notation"), "notation", "left_anti")
    return solved.drop("w").unionByName(rest, allowMissingColumns=True)


def yearly_usd(postings: DataFrame, fx: DataFrame, periods: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(record_id, min_usd_year) of every row that states amount, currency and period; and the notations' meanings."""
    scratch = Scratch(postings.sparkSession, "units")
    needed = ["record_id", "job_posting_id", "salary_min", "salary_currency", "salary_period", "job_summary"]
    rows = statements(postings.select(*needed)).select(
        "record_id", posting_key().alias("entity"), F.col("_amount").alias("amount"), F.col("_notation").alias("notation"), F.col("_period").alias("period")
    )
    # written before it is filtered: a filter pushed through the parsing would repeat it
    rows = scratch.keep(rows, "statements").filter("amount > 0 and notation is not null and period is not null")
    meaning = scratch.keep(solve_notations(rows.filter("entity is not null"), fx, periods).coalesce(1), "notations")
    rate = F.col("usd_rate").cast("decimal(12,6)")
    out = (
        rows.join(F.broadcast(meaning.select("notation", "currency_code", "scale")), "notation")
        .join(F.broadcast(fx.select("currency_code", "usd_rate")), "currency_code")
        .join(F.broadcast(periods.select(F.col("period_code").alias("period"), "per_year")), "period")
        .select("record_id", F.round(F.col("amount") * F.col("scale").cast("decimal(8,2)") * F.col("per_year") * rate, 0).cast("bigint").alias("min_usd_year"))
    )
    return out, meaning
