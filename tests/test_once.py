import random
from datetime import datetime, timedelta

from siltstone.operators import once
from siltstone.runtime import Scratch

SCHEMA = "delivery_id bigint, message_id string, batch_id string, company_id string, company_url string, first_seen_at string, received_at timestamp, extra int"
DIRECTORY = [("10001", "https://boards.example/company/acme"), ("10002", "https://boards.example/company/bolt")]


def companies(spark):
    return spark.createDataFrame(DIRECTORY, "company_id string, linkedin_url string")


def brute(rows):
    best: dict = {}
    for r in rows:
        cid = (r[3] or "").strip().removesuffix(".0") or {u.rsplit("/", 1)[1]: c for c, u in DIRECTORY}.get((r[4] or "").lower().split("/company/")[-1].split("?")[0].strip("/"), r[4])
        key = (cid, r[5])
        v = (r[6], r[0])
        best[key] = min(best.get(key, v), v)
    kept = {v[1] for v in best.values()}
    return {r[0] for r in rows} - kept


def rows_of(n=200, seed=3):
    rnd = random.Random(seed)
    t0, out = datetime(2025, 1, 28), []
    for i in range(n):
        k = 0 if rnd.random() < 0.35 else rnd.randrange(25)  # one message holds a third of all rows
        c = k % 2
        cid = rnd.choice(["1000%d" % (c + 1), " 1000%d" % (c + 1), "1000%d.0" % (c + 1), None])
        url = DIRECTORY[c][1] + rnd.choice(["", "/", "?trk=jobs"]) if cid is None or rnd.random() < 0.5 else None
        at = f"2025-01-{1 + k:02d}T10:00:00Z"
        out.append((i, None, f"b00-{100 + rnd.randrange(9)}", cid, url, at, t0 + timedelta(hours=rnd.randrange(2000)), 1))
    return out


def test_against_brute_force(spark):
    rows = rows_of()
    store = once.run_batches(spark.createDataFrame(rows, SCHEMA), companies(spark), Scratch(spark, "t").root, rounds=4)
    assert {r.delivery_id for r in store.surplus().collect()} == brute(rows)
    assert store.surplus().count() == len(brute(rows))
    assert store.winners().count() == len(rows) - len(brute(rows))


def test_same_batch_again_changes_winners_not(spark):
    rows = rows_of(60, seed=5)
    store = once.MessageStore(spark, Scratch(spark, "t").root)
    keyed = once.keyed(spark.createDataFrame(rows, SCHEMA), companies(spark))
    store.merge(keyed)
    first = {r.delivery_id for r in store.winners().collect()}
    store.merge(keyed.limit(0))
    assert {r.delivery_id for r in store.winners().collect()} == first


def test_only_affected_partitions_are_rewritten(spark):
    store = once.MessageStore(spark, Scratch(spark, "t").root)
    one = [(1, None, "b1", "10001", None, "2025-01-01T10:00:00Z", datetime(2025, 1, 5), 1), (2, None, "b1", "10001", None, "2025-02-01T10:00:00Z", datetime(2025, 2, 5), 1)]
    store.merge(once.keyed(spark.createDataFrame(one, SCHEMA), companies(spark)))
    before = store.manifest()["parts"]
    late = [(3, None, "b2", "10001", None, "2025-02-01T10:00:00Z", datetime(2025, 3, 1), 1)]
    store.merge(once.keyed(spark.createDataFrame(late, SCHEMA), companies(spark)))
    after = store.manifest()["parts"]
    of = lambda parts, month: {k: v for k, v in parts.items() if k.startswith(month)}
    assert of(after, "2025-01") == of(before, "2025-01") and of(after, "2025-02") != of(before, "2025-02")
    assert {r.delivery_id for r in store.winners().collect()} == {1, 2}
    assert [r.delivery_id for r in store.surplus().collect()] == [3]


def test_nulls_and_empty(spark):
    odd = [(1, "msg:A-1", "b1", None, None, None, None, 1), (2, "{a-1}", "b1", None, None, "junk", datetime(2025, 1, 1), 1), (3, None, None, None, None, None, None, 1), (4, None, None, None, None, None, None, 1)]
    store = once.run_batches(spark.createDataFrame(odd, SCHEMA), companies(spark), Scratch(spark, "t").root)
    assert [r.delivery_id for r in store.surplus().collect()] == [1]
    empty = once.run_batches(spark.createDataFrame([], SCHEMA), companies(spark), Scratch(spark, "t").root)
    assert empty.surplus().count() == 0 and empty.winners().count() == 0


def test_both_identifiers_tie_messages(spark):
    """A garbled instant or a missing company doesn't hide a shared message id, in one batch or over several."""
    t0 = datetime(2025, 1, 1)
    rows = [
        (1, "M1", "b00-1", "10001", None, "2025-01-01T10:00:00Z", t0, 1), (2, "{m1}", "b00-2", "10001", None, "garbled", t0 + timedelta(hours=1), 1), (3, "msg:M1", "b00-3", None, None, "2025-01-01T10:00:00Z", t0 + timedelta(hours=2), 1),
        (4, None, "b00-1", "10002", None, "2025-01-01T10:00:00Z", t0 + timedelta(hours=3), 1), (5, "M2", "b00-2", None, None, None, t0 + timedelta(hours=4), 1), (6, "M2", "b00-3", "10002", None, "2025-01-01T10:00:00Z", t0 + timedelta(hours=5), 1),
        (7, None, "b00-3", None, None, None, None, 1),
    ]
    for rounds in (1, 3):
        store = once.run_batches(spark.createDataFrame(rows, SCHEMA), companies(spark), Scratch(spark, "t").root, rounds=rounds)
        assert sorted(r.delivery_id for r in store.surplus().collect()) == [2, 3, 5, 6]
        assert sorted(r.delivery_id for r in store.winners().collect()) == [1, 4, 7]


def test_a_batch_that_comes_again_changes_nothing(spark):
    rows = rows_of(60, seed=9)
    df = once.keyed(spark.createDataFrame(rows, SCHEMA), companies(spark))
    store = once.MessageStore(spark, Scratch(spark, "t").root)
    for _ in range(2):
        store.merge(df)
        assert sorted(r.delivery_id for r in store.surplus().collect()) == sorted(brute(rows))


def test_a_compacted_index_finds_old_messages(spark, monkeypatch):
    monkeypatch.setattr(once, "COMPACT", 2)
    rows = rows_of(80, seed=4)
    store = once.run_batches(spark.createDataFrame(rows, SCHEMA), companies(spark), Scratch(spark, "t").root, rounds=4)
    assert {r.delivery_id for r in store.surplus().collect()} == brute(rows) and len(store.manifest()["index"]) < 3
