import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brandflow.llm import near_fss

FOLD = {k: k + 32 for k in range(65, 91)}


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(w) >= words:
        return frozenset(zip(*[w[k:] for k in range(words)]))
    return frozenset([tuple(w)] if w else [])


def brute(rows, words, percent=80):
    """n_shingles and component of each row number, by comparing all pairs."""
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    out = []
    for k in range(len(rows)):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(k) and rows[j][0] is not None]
        out.append((rows[k][0], len(sets[k]), (min(ids) if ids else None) if sets[k] else rows[k][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("words", [2, 5])
def test_equals_brute_force(docs, words):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = near_fss.near_duplicates(docs, words).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str) == brute(rows, words)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_chains_and_variants_of_one_text(spark):
    """Variants around the threshold, whose links to one another matter, not only those to a center."""
    rnd = random.Random(5)
    base = [f"b{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 90):
        w = list(rnd.choice(rows)[1].split()) if k % 3 else list(base)
        for _ in range(rnd.choice([1, 2, 3, 5, 6, 7, 9])):
            w[rnd.randrange(len(w))] = f"n{rnd.randrange(60)}"
        rows.append((k, " ".join(w)))
    got = near_fss.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str) == brute(rows, 2)


def template_pages(n, shared=120, own=22, copies=0, seed=3):
    """Pages of one template with words of their own, just too different to be linked; ``copies`` of some, with an edit each."""
    rnd = random.Random(seed)
    frame = [f"t{k}" for k in range(shared)]
    rows = []
    for k in range(n):
        at = rnd.randrange(shared)
        rows.append(frame[:at] + [f"p{k}w{j}" for j in range(own)] + frame[at:])
    for k in range(copies):
        words = list(rows[rnd.randrange(n)])
        words[rnd.randrange(len(words))] = f"e{k}"
        rows.append(words)
    return [(k, " ".join(w)) for k, w in enumerate(rows)]


@pytest.mark.parametrize("own, copies", [(22, 0), (17, 60), (15, 40), (30, 60)])
def test_template_groups_equal_brute_force(spark, own, copies):
    rows = template_pages(120, own=own, copies=copies)
    rows += [(1000 + k, t) for k, (_, t) in enumerate(template_pages(40, shared=100, own=own, seed=9))]
    got = near_fss.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str) == brute(rows, 2)


def test_pages_of_a_template_are_not_paired(spark, monkeypatch):
    """Rows that meet in the join of differences grow with the pages, not with their square."""
    met = []
    real = near_fss.written

    def counting(df, name):
        if name == "candidates":  # its join, before the conditions beside the shared element
            tables = dict(seen)
            first = tables["first-differences"]
            small = first.where("(apart and own and own_place <= as_smaller) or (not apart and in_differences)").groupBy("a", "element").agg(F.count("*").alias("n"))
            met.append(small.join(first.groupBy("a", "element").agg(F.count("*").alias("m")), ["a", "element"]).agg(F.coalesce(F.sum(F.col("n") * F.col("m")), F.lit(0))).first()[0])
        out = real(df, name)
        seen.append((name, out))
        return out

    monkeypatch.setattr(near_fss, "written", counting)
    for n in (200, 800):
        seen = []
        docs = spark.createDataFrame(template_pages(n), "doc_id long, text string").repartition(4)
        assert near_fss.near_duplicates(docs, 2).where("kept").count() == n
    assert met[1] <= 6 * max(met[0], 200 * 60)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = near_fss.near_duplicates(odd, 5).collect()
    assert sorted([(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got], key=str) == brute(rows, 5)


def test_filter_keeps_one_of_each(odd):
    out = near_fss.without_near_duplicates(odd, 5)
    assert out.columns == odd.columns
    kept = sorted([(r["doc_id"], (r["text"] or "")[:12]) for r in out.collect()], key=str)
    # rows with the text of doc 1 stay once; rows without words all stay
    assert kept.count((1, "The quick br")) == 1 and (None, "The quick br") not in kept
    assert {k for k, _ in kept} == {1, 2, 3, 4, 5, 6, 7, None}
    assert len(kept) == 9


def test_filter_keeps_components_that_share_their_smallest_doc_id(spark, odd):
    out = near_fss.without_near_duplicates(odd, 5).collect()
    assert len(out) == 9 and {r["text"] for r in out if r["doc_id"] == 7} == {"otro texto", "un autre texte"}
    a, b = (" ".join(f"{x}{k}" for k in range(100)) for x in "ab")
    for x, y in ((a, b), (b, a)):  # either order of the hashes of the two texts
        docs = spark.createDataFrame([(1, x), (1, y), (2, y + " end"), (3, y)], "doc_id long, text string")
        assert sorted((r["doc_id"], r["text"]) for r in near_fss.without_near_duplicates(docs, 5).collect()) == [(1, a), (1, b)]
        judged = near_fss.near_duplicates(docs, 5).where("kept").collect()
        assert [r["doc_id"] for r in judged] == [1, 1]  # as many as the query marks


def test_empty(empty):
    assert near_fss.near_duplicates(empty).collect() == []
    assert near_fss.without_near_duplicates(empty).collect() == []


def test_sketch_is_filled_and_concentrated():
    rnd = np.random.default_rng(3)
    errors = []
    for n in (1, 3, 20, 300, 5000):
        for j in (0.2, 0.5, 0.8):
            both = int(round(2 * n * j / (1 + j)))
            x = rnd.integers(0, 2**63, 2 * n, dtype=np.uint64)
            a, b = near_fss.sketch(np.unique(x[:n])), near_fss.sketch(np.unique(np.r_[x[:both], x[n : 2 * n - both]]))
            assert (a != np.iinfo(np.uint64).max).all() and len(a) == near_fss.BINS
            errors.append((a == b).mean() - both / (2 * n - both))
    assert max(map(abs, errors)) < 0.16 and abs(np.mean(errors)) < 0.04
