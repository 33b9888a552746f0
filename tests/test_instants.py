from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from siltstone.operators.instants import instants

UTC = timezone.utc
SCHEMA = "id int, t string, z string, o string"


def read(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    return {r.id: r.utc_us for r in instants(df, "t", "z", "o").collect()}


def us(*a, zone=UTC):
    d = datetime(*a, tzinfo=zone).astimezone(UTC) - datetime(1970, 1, 1, tzinfo=UTC)
    return d // timedelta(microseconds=1)


NY = "America/New_York"
CASES = [
    (("2025-01-27T11:31:37.789Z", NY, "MDY"), us(2025, 1, 27, 11, 31, 37, 789000)),
    (("2025-05-19T16:04:28.904187946Z", NY, "MDY"), us(2025, 5, 19, 16, 4, 28, 904187)),
    (("2025-01-09 10:23:43.487 -0300", NY, "MDY"), us(2025, 1, 9, 13, 23, 43, 487000)),
    (("2025-01-06T05:32:00+05:30", NY, "MDY"), us(2025, 1, 6, 0, 2)),
    (("2025-07-04T12:00:00", NY, "MDY"), us(2025, 7, 4, 12, zone=ZoneInfo(NY))),
    (("2025-04-26 08:14:58[Europe/London]", NY, "MDY"), us(2025, 4, 26, 7, 14, 58)),
    (("02/18/2025 11:52 PM", NY, "MDY"), us(2025, 2, 18, 23, 52, zone=ZoneInfo(NY))),
    (("15/12/2024 12:05 AM", "Europe/London", "DMY"), us(2024, 12, 15, 0, 5)),
    (("06.01.2025 01:03", "Europe/Berlin", "DMY"), us(2025, 1, 6, 0, 3)),
    (("Sat, 14 Dec 2024 19:07:21 -0500", NY, "MDY"), us(2024, 12, 15, 0, 7, 21)),
    (("16 Jun 2025 20:15 CEST", NY, "MDY"), us(2025, 6, 16, 18, 15)),
    (("20250414T150101Z", NY, "MDY"), us(2025, 4, 14, 15, 1, 1)),
    (("1736122595", NY, "MDY"), 1736122595 * 10**6),
    (("1747886369830", NY, "MDY"), 1747886369830 * 1000),
    (("1740938149041434", NY, "MDY"), 1740938149041434),
    (("2024-02-29T00:00:00Z", NY, "MDY"), us(2024, 2, 29)),
    (("1969-12-31T23:59:59Z", NY, "MDY"), -(10**6)),
]
NONE = [
    (None, NY, "MDY"), ("", NY, "MDY"), ("just now", NY, "MDY"), ("2025-02-01", NY, "MDY"), ("2025-02-30T10:15:00Z", NY, "MDY"), ("2025-04-11T25:10:00+01:00", NY, "MDY"),
    ("0000-00-00 00:00:00", NY, "MDY"), ("31/31/2025 09:00 AM", NY, "MDY"), ("2025-03-09T02:30:00", NY, "MDY"), ("2025-11-02T01:30:00", NY, "MDY"), ("2025-01-01T00:00:00", None, None),
    ("2025-01-01T00:00:00 XYZ", NY, "MDY"), ("2025-01-01 00:00:00[Mars/Base]", NY, "MDY"), ("2023-02-29T00:00:00Z", NY, "MDY"), ("x" * 5000, NY, "MDY"), ("13/01/2025 13:00 PM", NY, "DMY"),
]


def test_forms(spark):
    got = read(spark, [c for c, _ in CASES])
    for i, (c, want) in enumerate(CASES):
        assert got[i] == want, c


def test_no_instants(spark):
    got = read(spark, NONE)
    for i, c in enumerate(NONE):
        assert got[i] is None, c


def test_repeated_clock_hours_by_brute_force(spark):
    # each local minute of the days around both changes, against all instants of those days
    zone = ZoneInfo("Europe/Berlin")
    seen: dict[str, list[int]] = {}
    for day in (datetime(2025, 3, 29, 22, tzinfo=UTC), datetime(2025, 10, 25, 22, tzinfo=UTC)):
        for m in range(0, 12 * 60, 10):
            t = day + timedelta(minutes=m)
            seen.setdefault(t.astimezone(zone).strftime("%Y-%m-%dT%H:%M:%S"), []).append(int(t.timestamp() * 10**6))
    texts = sorted({(datetime(2025, mo, d, 0) + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%S") for mo, d in ((3, 30), (10, 26)) for m in range(0, 8 * 60, 10)})
    got = read(spark, [(t, "Europe/Berlin", "DMY") for t in texts])
    for i, t in enumerate(texts):
        want = seen.get(t, [])
        assert got[i] == (want[0] if len(want) == 1 else None), t


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([], SCHEMA + ", _h int, utc_us string").drop("utc_us")
    assert instants(df, "t", "z", "o", keep=["id"]).columns == ["id", "utc_us"]
    assert instants(df, "t", "z", "o", keep=["id"]).count() == 0


@pytest.mark.parametrize("order,month", [("MDY", 3), ("DMY", 4)])
def test_date_order(spark, order, month):
    assert read(spark, [("3/4/2025 10:00:00", "UTC", order)])[0] == us(2025, month, 7 - month, 10)
