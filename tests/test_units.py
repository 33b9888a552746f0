import pytest
from pyspark.sql import functions as F

from siltstone.operators import units

SILVER = "record_id bigint, job_posting_id string, salary_min double, salary_currency string, salary_period string, job_summary string"


@pytest.fixture(scope="module")
def dims(spark):
    fx = spark.createDataFrame([("USD", 1.0), ("EUR", 1.08), ("GBP", 1.27), ("CAD", 0.73), ("BRL", 0.18), ("INR", 0.012), ("CHF", 1.12)], "currency_code string, usd_rate double")
    per = spark.createDataFrame([("year", 1), ("month", 12), ("week", 52), ("day", 260), ("hour", 2080)], "period_code string, per_year int")
    return fx, per


CASES = [
    ((80000.0, "USD", "yearly", None), 80000),
    ((35.25, "EUR", "hourly", None), round(35.25 * 2080 * 1.08)),
    ((122.0, "kCAD", "annual", None), round(122000 * 0.73)),
    ((1675.0, "pence", "hourly", None), round(16.75 * 2080 * 1.27)),
    ((60.5, "₹ lakh", "pro Jahr", None), round(6050000 * 0.012)),
    ((10700.0, "USD per month", None, None), 128400),
    ((95000.0, "EUR-yr", None, None), round(95000 * 1.08)),
    ((111500.0, "", "p.a.", "The role is here. Paid in USD."), 111500),
    ((2750.0, None, "MONTH", "All amounts in GBP."), round(2750 * 12 * 1.27)),
    ((54000.0, "€", None, "Clients saved £2M last year. Compensation is stated a year and paid in EUR."), round(54000 * 1.08)),
    ((None, None, None, "Pay: €8,7k /mo. Nice."), round(8700 * 12 * 1.08)),
    ((None, None, None, "Gehalt ab 79,50 € brutto pro Stunde."), round(79.5 * 2080 * 1.08)),
    ((None, None, None, "CTC 62.5-77.5 LPA. A learning stipend of €1,500 a year comes on top."), 75000),
    ((None, None, None, "Offer: Rs. 42.5-56.5 lakhs a year."), 51000),
    ((None, None, None, "We offer R$ 1.520 - 1.785 per day, depending on level."), round(1520 * 260 * 0.18)),
    ((None, None, None, "Compensation: $65.00–89.50 per hour before tax."), 135200),
    ((46.0, None, "per hour", "From SFr. 46.00 per hour."), round(46 * 2080 * 1.12)),
]
NONE = [
    (None, None, None, None), (80000.0, None, None, None), (80000.0, "USD", "n/a", ""), (80000.0, "local", "yearly", "Pay is competitive."), (None, "USD", "yearly", "Sign-on bonus of $5,000 after the trial period."),
    (None, None, None, "Meal card worth R$ 900 a month."), (0.0, "USD", "yearly", None), (-5.0, "USD", "yearly", None), (None, None, None, "Backed by $40M of Series B funding."), (50.0, "XYZ", "hourly", "x" * 3000),
]


def run(spark, dims, rows):
    df = spark.createDataFrame([(i, f"40000{i:05d}", *r) for i, r in enumerate(rows)], SILVER)
    return {r.record_id: r.min_usd_year for r in units.yearly_usd(df.withColumn("usd_rate", F.lit("x")), *dims)[0].collect()}


def test_statements(spark, dims):
    got = run(spark, dims, [c for c, _ in CASES])
    for i, (c, want) in enumerate(CASES):
        assert got.get(i) == want, c


def test_nothing_stated(spark, dims):
    assert run(spark, dims, NONE) == {}
    assert run(spark, dims, []) == {}


def test_graph_solves_unknown_notations(spark, dims):
    # "zorkmid" is in no list: postings tie it to dollars, "grosh" to zorkmid alone, and both scales are found
    rows = []
    for k in range(30):
        usd = 50000.0 + 1000 * k
        pid = f"4{k:09d}"
        if k < 15:
            rows += [(pid, usd, "USD"), (pid, usd / 1000, "zorkmid")]
        else:
            rows += [(pid, usd / 1000, "zorkmid"), (pid, usd * 100, "grosh"), (pid, usd * 100, "grosh")]
    df = spark.createDataFrame([(i, p, a, c, "yearly", None) for i, (p, a, c) in enumerate(rows)], SILVER)
    out, meaning = units.yearly_usd(df, *dims)
    m = {r.notation: (r.currency_code, r.scale, r.origin) for r in meaning.collect()}
    assert m["zorkmid"] == ("USD", "1000", "graph") and m["grosh"] == ("USD", "0.01", "graph")
    assert out.count() == len(rows)


def test_disagreeing_notation_stays_unsolved(spark, dims):
    rows = [(f"4{k:09d}", a, c) for k in range(20) for a, c in ((60000.0, "USD"), (60000.0 * (1 + k), "vague"))]
    df = spark.createDataFrame([(i, p, a, c, "yearly", None) for i, (p, a, c) in enumerate(rows)], SILVER)
    assert "vague" not in {r.notation for r in units.yearly_usd(df, *dims)[1].collect()}


@pytest.mark.parametrize("text,key", [("urn:boards:jobPosting:4000000190", "4000000190"), ("004000000064", "4000000064"), (" 4000000065", "4000000065"), ("4000000065.0", "4000000065"), ("https://boards.example/jobs/view/4000000000?trk=feed", "4000000000"), ("", None), (None, None)])
def test_posting_key(spark, text, key):
    df = spark.createDataFrame([(text,)], "job_posting_id string")
    assert df.select(units.posting_key().alias("k")).first().k == key
