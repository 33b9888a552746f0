import bisect
import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import packing
from siltstone.runtime import Scratch


def best_fit(sizes, capacity):
    """Containers that one document after the other fills, largest first."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, s)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        bisect.insort(gaps, gap - s)
    return len(gaps)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), min_size=1, max_size=200))))
def test_sweep_is_best_fit(case):
    capacity, sizes = case
    load, seen = Counter(), Counter()
    for size, low, high, first, per in packing.sweep(list(Counter(sizes).items()), capacity):
        for k in range(low, high + 1):
            load[first + (k - low) // per] += size
            seen[size, k] += 1
    assert all(v == 1 for v in seen.values()) and Counter(s for s, _ in seen) == Counter(sizes)
    assert max(load.values()) <= capacity and len(load) == best_fit(sizes, capacity)


def specs(spark, *caps):
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(caps)], "spec_id int, capacity_tokens int")


def test_pack(spark):
    rnd = random.Random(1)
    # a third of all documents has one size; some are longer than a container
    docs = [(i, 7 if rnd.random() < 0.33 else rnd.randint(1, 120)) for i in range(1500)]
    rows = packing.pack(spark.createDataFrame(docs, "doc_id bigint, tokens bigint"), specs(spark, 50, 128), Scratch(spark, "t")).collect()
    for spec, cap in ((1, 50), (2, 128)):
        load, parts = defaultdict(int), defaultdict(list)
        for r in rows:
            if r.spec_id == spec:
                load[r.container_id] += r.tokens
                parts[r.doc_id].append((r.piece_no, r.tokens))
        assert max(load.values()) <= cap
        for d, n in docs:
            p = sorted(parts[d])
            assert sum(x for _, x in p) == n and [k for k, _ in p] == list(range(len(p)))
            assert len(p) == 1 or (n > cap and all(x == cap for _, x in p[:-1]))
        assert len(load) <= 1.03 * -(-sum(n for _, n in docs) // cap) + 1


def test_nothing_to_pack(spark):
    none = spark.createDataFrame([], "doc_id bigint, tokens bigint")
    assert packing.pack(none, specs(spark, 10), Scratch(spark, "t")).count() == 0
    assert packing.pack(spark.createDataFrame([(1, 5)], "doc_id bigint, tokens bigint"), specs(spark), Scratch(spark, "t")).count() == 0


def test_token_counts(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["Our platform group keeps 12 pipelines.", "ünïcödé — 漢字 <|endoftext|>", "a" * 3000, "  spaced \n\n out  "]
    rows = [(i, x, 1) for i, x in enumerate(texts)] + [(90, None, 1), (91, " ", 1), (0, texts[0], 1), (None, "x", 1)]
    got = {r.doc_id: r.tokens for r in packing.token_counts(spark.createDataFrame(rows, "doc_id bigint, text string, tokens int")).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}


def test_ranked(spark):
    rows = [(k % 3 // 2, i) for i, k in enumerate(range(300))]
    got = packing.ranked(spark.createDataFrame(rows, "g int, v int"), ["g"], ["v"]).collect()
    for g in (0, 1):
        mine = sorted((r.rank, r.v) for r in got if r.g == g)
        assert [k for k, _ in mine] == list(range(len(mine))) and [v for _, v in mine] == sorted(v for _, v in mine)
