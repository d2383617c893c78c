from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from agoralake.llm.mixing import cycle, mix_sources, mixed, target_weights, whole_weights


def _docs(sizes):
    rows, k = [], 0
    for source, n in sizes.items():
        rows += [(k + i, "t", None, source) for i in range(n)]
        k += n
    return rows


def test_cycle_keeps_every_source_within_one_block(spark, documents):
    docs = documents(_docs({"a": 500, "b": 30, "c": 30, "d": 1, None: 7}))
    weights = {"a": 0.5, "b": 0.3, "c": 0.12, "d": 0.08}
    plan = cycle(target_weights(docs, "source", weights, 100)).orderBy("__slot").collect()
    total = plan[0]["__cycle"]
    share = {r["__source"]: r["__p"] for r in plan}
    assert sum(share.values()) == total == len(plan)
    assert share == {"=a": 25, "=b": 15, "=c": 6, "=d": 4}
    done = Counter()
    for t, row in enumerate(plan):
        done[row["__source"]] += 1
        for s, p in share.items():
            assert abs(done[s] * total - (t + 1) * p) < total


def test_weights_are_exact():
    small = {f"s{k}": 0.0001 for k in range(5000)}
    whole = whole_weights({"big": 0.5, **small})
    assert whole["big"] == 5000 and {whole[k] for k in small} == {1}
    assert whole_weights({"a": 0.9999, "b": 0.0001}) == {"a": 9999, "b": 1}
    assert whole_weights({"a": 1 / 3, "b": 2 / 3, "c": 0}) == {"a": 1, "b": 2, "c": 0}
    assert whole_weights({}) == {} and whole_weights({"a": 0.0}) == {"a": 0}
    tiny = whole_weights({"a": 1e-9, "b": 1.0})
    assert 0 < tiny["a"] < tiny["b"] < 2**41
    with pytest.raises(ValueError):
        whole_weights({"a": -1.0})


def test_many_small_sources_keep_a_large_one_at_its_weight(spark, documents):
    docs = documents(_docs({"big": 1, **{f"s{k}": 1 for k in range(500)}}))
    weights = {"big": 0.5, **{f"s{k}": 0.001 for k in range(500)}}
    plan = cycle(target_weights(docs, "source", weights)).orderBy("__slot").collect()
    assert len(plan) == 1000
    done = 0
    for t, row in enumerate(plan):
        done += row["__source"] == "=big"
        assert abs(2 * done - (t + 1)) < 2


def test_weight_zero_runs_behind_all_others(documents):
    docs = documents(_docs({"a": 100, "b": 25, "z": 30, None: 25}))
    rows = mix_sources(docs, weights={"a": 3, "b": 1, "z": 0}, block=10).collect()
    assert len(rows) == 180
    slots = {(r.source, r.block): r.slot for r in rows}
    assert len(set(slots.values())) == len(slots) == 10 + 3 + 3 + 3
    last = max(t for (s, _), t in slots.items() if s in ("a", "b"))
    behind = sorted((t, s or "") for (s, _), t in slots.items() if s not in ("a", "b"))
    assert behind[0][0] > last and [s for _, s in behind] == ["", "z"] * 3
    none = mix_sources(docs, weights={}, block=10).collect()
    assert sorted({r.slot for r in none})[0] == 0 and len(none) == 180


def test_blocks_and_slots(documents):
    docs = documents(_docs({"a": 1000, "b": 300, "c": 10}))
    rows = mix_sources(docs, weights={"a": 2, "b": 1, "c": 1}, block=10).collect()
    assert len(rows) == 1310
    per = Counter((r.source, r.block) for r in rows)
    assert per[("a", 0)] == 10 and max(b for s, b in per if s == "a") == 99 and len(per) == 131
    slots = {(r.source, r.block): r.slot for r in rows}
    assert len(set(slots.values())) == 131
    # While no source has run out, the first slots follow the weights.
    first = sorted(slots.items(), key=lambda x: x[1])[:4]
    assert Counter(s for (s, _), _ in first) == {"a": 2, "b": 1, "c": 1}
    assert all(slots[("a", k)] < slots[("a", k + 1)] for k in range(99))


def test_order_takes_effect_and_nothing_is_lost(documents):
    docs = documents(_docs({"a": 300, "b": 300, None: 5}))
    out = mixed(docs, block=10)
    assert out.columns == docs.columns
    rows = [r.source for r in out.collect()]
    assert Counter(rows) == {"a": 300, "b": 300, None: 5}
    assert 100 < rows[:250].count("a") < 150


def test_nulls_repeats_clashes_and_nothing(documents):
    clash = documents(
        [(1, None, None, "x", 5), (1, None, None, "x", 5), (None, None, None, None, None)],
        "doc_id bigint, slot string, block string, source string, n bigint",
    )
    out = mix_sources(clash)
    assert out.columns == [*clash.columns, "block_", "slot_"]
    assert sorted(r.block_ for r in out.collect()) == [0, 0, 0]
    assert mix_sources(documents([])).count() == 0
    assert mixed(documents([])).count() == 0


@pytest.mark.parametrize("weights", [None, {"a": 1.0}])
def test_no_python_in_the_plan(documents, weights):
    plan = mix_sources(documents(_docs({"a": 3})), weights=weights)._jdf.queryExecution().toString()
    for word in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"):
        assert word not in plan


def test_pipeline_packs_in_mixed_order(spark, documents, monkeypatch):
    docs = documents([(k, "w " * 10, None, "ab"[k % 2]) for k in range(1024)])
    firsts = []
    for weights in ({"a": 3.0, "b": 1.0}, {"a": 1.0, "b": 3.0}):
        monkeypatch.setattr(corpus_pipeline, "WEIGHTS", weights)
        slots = {r.doc_id: r.slot for r in mix_sources(docs, weights=weights).collect()}
        packed = corpus_pipeline.packing(spark, corpus_pipeline.mixing(spark, docs, ""), "").collect()
        rows = sorted(packed, key=lambda r: (r.batch, r.row))
        assert len({(r.batch, r.row) for r in rows}) == len(rows) == 1024
        order = [slots[r.doc_id] for r in rows]
        assert order == sorted(order)
        firsts.append(Counter("ab"[r.doc_id % 2] for r in rows[:256]))
    assert firsts == [{"a": 192, "b": 64}, {"a": 64, "b": 192}]
