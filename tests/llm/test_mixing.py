from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from starmart.llm import mixing
from starmart.llm.queries import op7_mixing


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=8))
def test_pfair_deviation_is_below_one_block(weights):
    order, q = mixing.pfair_period(weights), sum(weights)
    assert Counter(order) == {i: w for i, w in enumerate(weights)}
    placed = np.zeros(len(weights))
    for t, i in enumerate(order, 1):
        placed[i] += 1
        assert (np.abs(placed - np.array(weights) * t / q) < 1).all()


def test_every_block_is_inside_its_window():
    w = [7, 2, 1, 30]
    order, q, seen = mixing.pfair_period(w), sum(w), Counter()
    for t, i in enumerate(order):
        j = seen[i]
        assert j * q // w[i] <= t < -(-(j + 1) * q // w[i])
        seen[i] += 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 9)), min_size=1, max_size=6))
def test_phases_place_each_block_once_without_gaps(spec):
    blocks, weights = [b for b, _ in spec], [w for _, w in spec]
    plan, slots = mixing.phases(blocks, weights), []
    ends = [p.base for p in plan[1:]] + [None]
    for i, n in enumerate(blocks):
        for b in range(n if weights[i] else 0):
            p = [p for p in plan if p.weights[i] and p.first[i] <= b][-1]
            k, m = divmod(b - p.first[i], p.weights[i])
            slots.append(p.base + k * p.period + int(p.slots[i][m]))
            end = ends[plan.index(p)]
            assert end is None or slots[-1] < end
    assert sorted(slots) == list(range(len(slots)))
    assert len(slots) == sum(n for n, w in spec if w)


def test_weights():
    assert mixing.whole_weights({"a": 0.5, "b": 0.25, "c": 0.25}, 4) == {"a": 2, "b": 1, "c": 1}
    assert sum(mixing.whole_weights({str(i): 1 for i in range(7)}, 100).values()) == 100
    s = mixing.capped_shares({"hot": 900, "b": 60, "c": 40}, 1 / 3)
    assert s["hot"] == pytest.approx(1 / 3) and sum(s.values()) == pytest.approx(1)
    assert mixing.capped_shares({"a": 5}, 1 / 3) == {"a": 1}


def test_query(spark, docs_of, tables):
    rows = [(i, f"t{i}", "en", "hot") for i in range(300)] + [(1000 + i, None, None, "b") for i in range(100)]
    rows += [(2000 + i, "", "en", None) for i in range(95)] + [(3000, "x", "en", "rare"), (3000, "x", "en", "rare"), (None, "y" * 70_000, "en", "b")]
    sf = tables(documents=docs_of(rows))
    out = op7_mixing(spark, sf).collect()
    assert Counter((r["doc_id"], r["source"]) for r in out) == Counter((r[0], r[3]) for r in rows)
    at = defaultdict(list)
    for r in out:
        at[(r["source"], r["block"])].append(r)
    slots = sorted(v[0]["slot"] for v in at.values())
    assert slots == list(range(len(slots)))
    for v in at.values():
        assert len({(r["phase"], r["slot"], r["weight"]) for r in v}) == 1
        assert sorted(r["place"] for r in v) == list(range(len(v)))
    weight = {(r["phase"], r["source"]): r["weight"] for r in out}
    first = sorted((v[0]["phase"], v[0]["slot"], s) for (s, _), v in at.items())
    for phase in {p for p, _, _ in first}:
        placed, mine = Counter(), [(t, s) for p, t, s in first if p == phase]
        for t, s in mine:
            placed[s] += 1
            for (p, src), w in weight.items():
                if p == phase:
                    assert abs(placed[src] - w * (t - mine[0][0] + 1)) < 1
    assert op7_mixing(spark, tables(documents=docs_of([]))).count() == 0


def test_given_weights_zero_and_clashes(spark, docs_of):
    docs = docs_of([(i, "x", "en", "ab"[i % 2]) for i in range(40)] + [(99, "x", "en", "other")])
    out = mixing.mix(docs.withColumnRenamed("n_chars", "mix_slot"), weights={"a": 3, "b": 1, "none": 5}, block_rows=2, period=4)
    rows = out.collect()
    assert {r["source"] for r in rows if r["_mix_slot"] is None} == {"other"}
    head = [r["source"] for r in sorted((r for r in rows if r["_mix_slot"] is not None), key=lambda r: (r["_mix_slot"], r["mix_place"]))]
    assert Counter(head[:24]) == {"a": 18, "b": 6}
    with pytest.raises(ValueError):
        mixing.mix(docs, weights={"a": -1})
