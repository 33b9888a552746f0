import json

import pytest

from siltstone.operators import drift, nested
from siltstone.runtime import Scratch

FEED = "line_id bigint, feed_id bigint, file_id bigint, file_seq int, line_no int, arrived_at timestamp, payload string"


def feed(spark, files):
    rows, n = [], 0
    for f, (feed_id, seq, lines) in enumerate(files, 1):
        for k, line in enumerate(lines):
            n += 1
            rows.append((n, feed_id, f, seq, k + 1, None, line if isinstance(line, str) else json.dumps(line)))
    return spark.createDataFrame(rows, FEED)


def test_changes(spark):
    df = feed(spark, [
        (1, 1, [{"job_id": 1, "internal_mobility_mentioned": True, "career_tracks_json": ["ic"], "latency_ms": 5}, {"job_id": 2, "internal_mobility_mentioned": None}]),
        (1, 2, [{"job_id": 1, "int_mobility": "true", "tracks_offered": ["ic"], "prompt_hash": "x12345"}] * 2),
        (1, 3, [{"job_id": 1, "int_mobility": None, "tracks_offered": "ic, architect", "prompt_hash": None}, "not json", '[1]']),
        (2, 1, [{"job_id": "7"}]),
    ])
    lines = drift.entries(df)
    got = {(r.file_id, r.field_name, r.change_kind) for r in drift.changes(drift.file_schemas(lines)).collect()}
    assert got == {
        (2, "int_mobility", "renamed"), (2, "int_mobility", "retyped"), (2, "tracks_offered", "renamed"), (2, "latency_ms", "removed"), (2, "prompt_hash", "added"),
        (3, "int_mobility", "removed"), (3, "prompt_hash", "removed"), (3, "tracks_offered", "retyped"),
    }


def test_unified_table(spark):
    df = feed(spark, [(1, 1, [{"a_flag_seen": True, "tracks_json": ["x", "y"], "n_calls": 3}]), (1, 2, [{"a_flag_seen": {"value": False, "confidence": 0.3}, "offered_tracks": "x, y", "n_calls": 4.5}])])
    lines = drift.entries(df)
    schemas = drift.file_schemas(lines)
    names = drift.canonical_names(drift.changes(schemas), schemas)
    out = drift.unified(lines, names)
    rows = {r.line_id: r.asDict() for r in out.collect()}
    tracks = next(k for k in rows[1] if "track" in k)
    assert dict(out.dtypes) == {"line_id": "bigint", "feed_id": "bigint", "file_id": "bigint", "a_flag_seen": "boolean", tracks: "array<string>", "n_calls": "double"}
    assert rows[1]["a_flag_seen"] is True and rows[2]["a_flag_seen"] is False and rows[1][tracks] == rows[2][tracks] == ["x", "y"] and rows[2]["n_calls"] == 4.5


def test_long_chains_of_renames(spark):
    chain = ["mobility", "mobility_a", "mobility_a_b", "mob_a_b", "a_b_c", "b_c_d", "c_d_e", "d_e_f"]
    found = spark.createDataFrame([(i, b, "renamed", a) for i, (a, b) in enumerate(zip(chain, chain[1:], strict=False))], "file_id bigint, field_name string, change_kind string, old_name string")
    schemas = spark.createDataFrame([(n,) for n in chain + ["other"]], "field string")
    got = {r.field: r.canonical for r in drift.canonical_names(found, schemas).collect()}
    assert len({got[n] for n in chain}) == 1 and got["other"] == "other"


def test_renames_without_a_shared_word(spark):
    """Values decide where names have nothing in common, by words far inside long texts; fields of true and false stay apart."""
    import random

    rnd = random.Random(2)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    text = lambda: "same start of every value " * 10 + " ".join(rnd.choices(words, k=40))
    other = lambda: "same start of every value " * 10 + " ".join(f"z{w}" for w in rnd.choices(words, k=40))
    one = [{"summary": text(), "urgent": True} for _ in range(20)]
    two = [{"abstract": text(), "remark": other(), "hybrid": False} for _ in range(20)]
    got = {(r.field_name, r.change_kind) for r in drift.changes(drift.file_schemas(drift.entries(feed(spark, [(1, 1, one), (1, 2, two)])))).collect()}
    assert got == {("abstract", "renamed"), ("remark", "added"), ("hybrid", "added"), ("urgent", "removed")}


def test_flooding_changes_scores():
    """A pair of name parts that another field shares more of is worth less where its own field is believed less."""
    f = lambda n, t="string", s=0: {"field": n, "type": t, "inner": [], "shape": [s] * drift.SLOTS}
    alone = drift.flood([f("alpha_beta_gamma_delta")], [f("alpha_omega_sigma_tau")])
    held = drift.flood([f("alpha_beta_gamma_delta"), f("alpha")], [f("alpha_omega_sigma_tau"), f("alpha")])
    key = ("alpha_beta_gamma_delta", "alpha_omega_sigma_tau")
    assert held[key] > alone[key]


def test_drift_on_nothing(spark):
    df = feed(spark, [(1, 1, ["{}", "null", "broken {"])])
    assert drift.changes(drift.file_schemas(drift.entries(df))).count() == 0


def items(spark, *payloads):
    df = spark.createDataFrame([(i, p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads, 1)], "pass_file_id bigint, payload string")
    return {tuple(r) for r in nested.pass_items(df, Scratch(spark, "t")).collect()}


def wrap(skills=None, benefits=None, **result):
    return {"metadata": {"enrichment_input_tokens": 9}, "result": {"extraction": {"skills_classified": {"must_have_skills": skills, "nice_to_have": [{"skill": "no"}]}, "benefits_structured": {"benefits": benefits}}, **result}}


def test_pass_items(spark):
    got = items(
        spark,
        wrap([None, "Java", {"skill": "Spark", "evidence": [{"quote": "a"}, None, "b"]}], {"benefit": "card", "terms": {"tier": "plus"}}, enrichment_input_tokens=5785),
        wrap('[{"skill": "SQL", "evidence": "[{\\"quote\\": \\"q\\"}]"}]', "gym", enrichment_input_tokens={"value": "1028"}),
        wrap([], None, usage={"calls": [{"enrichment_input_tokens": "38"}]}),
        '{"result": {"enrichment_input_tokens": 1',
        None,
        "[]",
    )
    assert got == {
        (1, "root", -1, -1, "5785"), (1, "skill", 1, -1, "Java"), (1, "skill", 2, -1, "Spark"), (1, "skill_evidence", 2, 0, "a"), (1, "skill_evidence", 2, 2, "b"), (1, "benefit", 0, -1, "card"), (1, "benefit_term", 0, 0, "plus"),
        (2, "root", -1, -1, "1028"), (2, "skill", 0, -1, "SQL"), (2, "skill_evidence", 0, 0, "q"), (2, "benefit", 0, -1, "gym"), (3, "root", -1, -1, "38"),
    }


def test_triples_round_trip(spark):
    record = {"a": [{"b": 1, "c": [True, None]}, {"b": 2.5}], "d": {"e": "x"}}
    got = {(p, tuple(o), v, k) for p, o, v, k in nested.triples_of(json.dumps(record), {})}
    assert {("a[].b", (0,), "1", "number"), ("a[].c[]", (0, 0), "true", "boolean"), ("a[].c[]", (0, 1), None, "null"), ("a[].b", (1,), "2.5", "number"), ("d.e", (), "x", "string")} <= got
    assert nested.ancestor("a[].c[].d") == "a[].c[]" and nested.ancestor("d.e") == ""


def test_positions_under_other_arrays(spark):
    """An array above doesn't change what position an element has in its own."""
    got = items(spark, {"result": {"runs": [{}, {"must_have_skills": [{"skill": "a"}, {"skill": "b", "evidence": ["q", None, "r"]}]}]}})
    assert got == {(1, "skill", 0, -1, "a"), (1, "skill", 1, -1, "b"), (1, "skill_evidence", 1, 0, "q"), (1, "skill_evidence", 1, 2, "r")}


def test_a_table_for_every_repeated_ancestor(spark):
    record = {"id": 7, "a": [{"b": 1, "c": [True, None, False]}, None, {"b": 2.5, "ordinals": "x"}], "d": {"e": "x"}}
    df = spark.createDataFrame([(1, json.dumps(record)), (2, "{"), (3, None)], "k bigint, t string")
    got = {g: sorted(map(tuple, t.collect())) for g, t in nested.tables(nested.grouped(df, "k", "t")).items()}
    assert got == {
        "": [(1, [], [], "x", "7")],
        "a[]": [(1, [0], [], "1", None), (1, [1], [], None, None), (1, [2], [], "2.5", "x")],
        "a[].c[]": [(1, [0, 0], [0], "true"), (1, [0, 1], [0], None), (1, [0, 2], [0], "false")],
    }
    assert nested.groups(nested.grouped(df, "k", "t")) == {"": ["d.e", "id"], "a[]": ["b", "ordinals"], "a[].c[]": [""]}
