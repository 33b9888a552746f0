import random

import pytest

from siltstone.llm import pii

GIVEN = "Emily John Priya Lars Chiara Mateo Aisha Dmitri Hannah Kofi Yuki Pedro".split()
FAMILY = "Johnson Nakamura Okafor Lindqvist Moretti Fernández Kowalski O'Brien Haddad Petrov Weber Silva".split()
TEMPLATES = [
    ("Please email our recruiter {name} at {mail} before the deadline.", ("name", "mail")),
    ("I spoke with {name} yesterday, and the offer is on its way.", ("name",)),
    ("Contact: {name} | {phone} | {mail}", ("name", "phone", "mail")),
    ("Ansprechpartnerin: Frau {name}, {phone}", ("name", "phone")),
    ("Interviews take place at {street}, Suite 12.", ("street",)),
    ("The candidate gave SSN {ssn} on the form.", ("ssn",)),
    ("{name} built the team here.", ("name",)),
]
DECOYS = [
    "Invoice 4411 2280 334 was paid.", "Order 7741077858 left the depot.", "We run Data Nights with the Harbour Office.", "Our Values and Our Team matter. Your Benefits: a bike.",
    "Smith & Partners Group opened a campus.", "Version 12.4.7780 is out.", "Ihre Aufgaben: Berichte pflegen. Ihre Vorteile: Urlaub.", "Apache Spark and Google Cloud are used daily. Our team likes both.",
]
KIND = {"name": "person_name", "mail": "email", "phone": "phone", "street": "street_address", "ssn": "id_number"}


def corpus(n=900, seed=4):
    rnd = random.Random(seed)
    rows, want = [], set()
    for i in range(n):
        if rnd.random() < 0.3:
            rows.append((i, rnd.choice(DECOYS), "clash"))
            continue
        g, f = rnd.choice(GIVEN), rnd.choice(FAMILY)
        v = {
            "name": f"{g} {f}", "mail": f"{pii.letters(g)}.{pii.letters(f)}@firm{rnd.randrange(9)}.example", "phone": f"+1 {rnd.randrange(210, 989)}-555-{rnd.randrange(1000, 9999)}",
            "street": f"{rnd.randrange(1, 999)} {rnd.choice(['Cedar', 'Maple', 'Birch'])} Street", "ssn": f"{rnd.randrange(100, 665)}-{rnd.randrange(10, 99)}-{rnd.randrange(1000, 9999)}",
        }
        text, parts = rnd.choice(TEMPLATES)
        rows.append((i, text.format(**v), "clash"))
        want |= {(i, KIND[p], v[p]) for p in parts}
    return rows, want


@pytest.fixture(scope="module")
def made(spark):
    rows, want = corpus()
    long = "x" * 150 + "@" + "y" * 250 + ".example"
    extra = [(90001, None, ""), (90002, " ", ""), (90003, "z" * 100_000 + " Please email our recruiter Emily Weber at e.weber@firm.example.", ""), (90004, f"Contact: {long} today", ""), (90005, rows[0][1], ""), (90005, "Contact: Emily Silva | +1 415-555-2671 | s@a.example", ""), (None, "Contact: Emily Silva | +1 415-555-2671 | e@a.example", "")]
    return spark.createDataFrame(rows + extra, "doc_id bigint, text string, pii_kind string"), want, long


def test_details_of_names_on_no_list(made):
    docs, want, long = made
    got = {(r.doc_id, r.pii_kind, r.pii_text) for r in pii.details(docs).collect()}
    assert (90004, "email", long) in got and (90003, "email", "e.weber@firm.example") in got and (90003, "person_name", "Emily Weber") in got
    for kind in pii.KINDS:
        found, true = {x for x in got if x[1] == kind and x[0] < 90000}, {x for x in want if x[1] == kind}
        assert len(found & true) >= 0.9 * len(true), (kind, sorted(true - found)[:5])
        assert len(found & true) >= 0.9 * len(found), (kind, sorted(found - true)[:5])


def test_redacted_rows_keep_their_own_text(made):
    docs, _, _ = made
    got: dict = {}
    for r in pii.redacted(docs).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[90001] == [None] and got[90002] == [" "]
    assert got[None] == ["Contact: [PERSON_NAME] | [PHONE] | [EMAIL]"]
    assert "Contact: [PERSON_NAME] | [PHONE] | [EMAIL]" in got[90005] and len(got[90005]) == 2
    assert got[90004] == ["Contact: [EMAIL] today"]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert pii.details(none).count() == 0 and pii.redacted(none).count() == 0


def test_estimates_follow_the_reliable_labelers():
    counts = [("email+++000", 500), ("email++00+0", 300), ("email--0-0-", 400), ("email-00-0-", 200), ("email+00000", 50)]
    soft = pii.estimate(counts)
    assert soft["email+++000"] > 0.95 and soft["email--0-0-"] < 0.05
    weights = pii.train([(p, "a\x1db", "x@y.example") for p, n in counts for _ in range(n)], soft)
    assert pii.score(weights, "email", "email++00+0", "a\x1db", "x@y.example") > 0.5 > pii.score(weights, "email", "email-00-0-", "a\x1db", "x@y.example")


def test_contexts_decide_where_votes_do_not():
    """A span of undecided votes follows the words around it, learned from spans whose votes are clear."""
    soft = {"email+++000": 0.99, "email--0-0-": 0.01, "email000000": 0.5}
    seen = [("email+++000", "good\x1d", "a")] * 300 + [("email--0-0-", "bad\x1d", "a")] * 300 + [("email000000", "other\x1d", "a")] * 20
    w = pii.train(seen, soft)
    assert pii.score(w, "email", "email000000", "good\x1d", "a") > 0.5 > pii.score(w, "email", "email000000", "bad\x1d", "a")


def test_first_and_last():
    assert pii.first_and_last("O’Brien, Emily") == ("emily", "o'brien") and pii.first_and_last("E. M. Weber") == ("e.", "weber")


def _renamed_firms(n=1200, seed=8):
    """Documents whose headings are firms of made-up words that recombine as names do, far more often than there are names."""
    rnd = random.Random(seed)
    heads, tails = [f"{a}{b}" for a in ("Wex", "Orm", "Thorn", "Quil", "Fen") for b in ("ora", "ton", "bek")], ["Joruba", "Jopelshi", "Joterwim", "Lekterba", "Grabapel", "Vanjojo"]
    rows, want = [], set()
    for i in range(n):
        firm, other = f"{rnd.choice(heads)} {rnd.choice(tails)}", f"{rnd.choice(heads)} {rnd.choice(tails)}"
        text = f"Offen: {firm} | apply. The plan of {other} is long. {rnd.choice(heads)} {rnd.choice(tails)}."
        if i % 6 == 0:
            g, f = rnd.choice(GIVEN), rnd.choice(FAMILY)
            text += rnd.choice([f" Contact: {g} {f}, {pii.letters(g)}.{pii.letters(f)}@a.example", f" Please email our recruiter {g} {f} at {pii.letters(g)}.{pii.letters(f)}@a.example soon.", f" I spoke with {g} {f} yesterday."])
            want.add((i, f"{g} {f}"))
        rows.append((i, text))
    return rows, want


def test_firms_that_recombine_are_no_names(spark):
    rows, want = _renamed_firms()
    got = {(r.doc_id, r.pii_text) for r in pii.details(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() if r.pii_kind == "person_name"}
    assert len(got & want) >= 0.9 * len(want), sorted(want - got)[:5]
    assert len(got & want) >= 0.9 * len(got), sorted(got - want)[:5]


def test_spans_that_no_labeler_speaks_for_are_false():
    counts = [("person_name0000000", 9000), ("person_name000-000", 4000), ("person_name0++0000", 9000), ("person_name0+++0+0", 300), ("person_name0++0+00", 400)]
    soft, seeds = pii.estimate(counts), pii.estimate(counts, seeds=True)
    assert soft["person_name0000000"] == soft["person_name000-000"] == 0
    assert seeds["person_name0++0000"] == 0 and seeds["person_name0+++0+0"] > 0.9
