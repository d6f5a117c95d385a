import math
import re

import pytest
from pyspark.sql import functions as F

from brandflow.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, free, target = share * sum(sizes.values()), list(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        full = [s for s in free if unit * weight[s] >= most * sizes[s]]
        if not full:
            return target | {s: unit * weight[s] for s in free}
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        free = [s for s in free if s not in target]
    return target


def targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    return {r["source"]: r["target"] for r in mixing.source_targets(mixing._keyed(rows)).collect()}


def test_targets_by_hand(spark):
    got = targets(spark, {"b": 100, "a": 100, None: 100})
    # 450 tokens; a: 5, b: 2, null: 1 of 8; a is full at 200, the rest 250 goes 2 to 1, b is at 166.7, null at 83.3
    assert got == {"a": 200.0, "b": pytest.approx(500 / 3), None: pytest.approx(250 / 3)}
    assert targets(spark, {"a": 0, "b": 10}) == {"a": 0.0, "b": pytest.approx(15)}
    assert targets(spark, {"a": 0, "b": 0}) == {"a": 0.0, "b": 0.0}
    assert targets(spark, {}) == {}
    many = {f"s{k}\u00e9" if k % 3 else f"S{k}\U0001f600": (k * k) % 997 for k in range(500)} | {None: 10_000, "": 3, "n": 4}
    assert targets(spark, many) == {s: pytest.approx(t) for s, t in brute_targets(many).items()}


def brute_multiplier(sizes, target):
    mean = sum(sizes) / len(sizes)
    low, high = -200.0, 200.0
    for _ in range(200):
        m = (low + high) / 2
        if sum(s * 2 / (1 + math.exp(max(-700, min(700, -m * s / mean)))) for s in sizes) > target:
            high = m
        else:
            low = m
    return low, mean


def test_rates_solve_the_dual_and_copies_meet_the_targets(docs):
    rows = mixing.balanced(docs.drop("n_chars")).collect()
    again = mixing.balanced(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    by = {}
    for r in rows:
        assert r["size"] == sizes[r["doc_id"]] and r["taken"] in (0, r["size"], 2 * r["size"])
        by.setdefault(r["source"], []).append(r)
    want = brute_targets({s: sum(r["size"] for r in rs) for s, rs in by.items()})
    for s, rs in by.items():
        assert {r["source_size"] for r in rs} == {sum(r["size"] for r in rs)}
        assert all(r["target"] == pytest.approx(want[s]) for r in rs)
        assert sum(r["rate"] * r["size"] for r in rs) == pytest.approx(want[s], rel=1e-6)
        if want[s] < 2 * rs[0]["source_size"] - 1:
            m, mean = brute_multiplier([r["size"] for r in rs if r["size"]], want[s])
            assert all(r["rate"] == pytest.approx(2 / (1 + math.exp(-m * r["size"] / mean)), rel=1e-5) for r in rs if r["size"])
        off = abs(sum(r["taken"] for r in rs) - want[s])
        assert off <= max(r["size"] for r in rs) / 2 + 1


def test_odd_rows(odd, empty):
    got = mixing.balanced(odd).collect()
    assert len(got) == odd.count()
    by = {(r["doc_id"], r["source"], r["size"]): r for r in got}
    assert by[(2, None, 0)]["copies"] == 1 and by[(2, None, 0)]["taken"] == 0
    mix = mixing.mixed_documents(odd)
    assert [c for c in mix.columns if c not in ("target_tokens", "copy")] == [c for c in odd.columns if c not in ("copy", "target_tokens")]
    assert mix.count() == sum(r["copies"] for r in got)
    assert mix.agg(F.max("copy")).first()[0] <= 2
    assert mixing.balanced(empty).collect() == [] and mixing.mixed_documents(empty).collect() == []


@pytest.mark.parametrize("broadcast", [True, False])
def test_many_sources_one_of_them_large(spark, monkeypatch, broadcast):
    from brandflow.operators import lookup

    n, own = 30_000, 3_000
    if not broadcast:
        monkeypatch.setattr(mixing, "lookup_join", lambda rows, table, key, n_rows: lookup.lookup_join(rows, table, key, n_rows=n_rows, max_rows=100))
    source = F.when(F.col("id") % 3 == 0, "large").when(F.col("id") % 3 == 1, F.concat(F.lit("s"), (F.col("id") % own).cast("string")))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (1 + F.col("id") * 7919 % 40).cast("int")).alias("text"), source.alias("source"))
    by = {}
    for r in mixing.balanced(docs).collect():
        by.setdefault(r["source"], []).append(r)
    sizes = {s: sum(r["size"] for r in rs) for s, rs in by.items()}
    want = brute_targets(sizes)
    assert len(by) == own // 3 + 2 and sum(map(len, by.values())) == n
    for s, rs in by.items():
        assert rs[0]["source_size"] == sizes[s] and rs[0]["target"] == pytest.approx(want[s])
        assert sum(r["rate"] * r["size"] for r in rs) == pytest.approx(want[s], rel=1e-5)
        assert abs(sum(r["taken"] for r in rs) - want[s]) <= max(r["size"] for r in rs)
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in rs)


def test_steps_that_do_not_converge_are_an_error(docs):
    with pytest.raises(RuntimeError, match="did not converge"):
        mixing.balanced(docs, steps=1)
