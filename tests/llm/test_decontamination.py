import hashlib
import re

import pytest

from brandflow.llm import positional_index
from brandflow.llm.queries import QUERIES

FOLD = {k: k + 32 for k in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items):
    windows = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            n = min(10, len(w))
            for s in range(len(w) - n + 1):
                windows.setdefault(tuple(w[s : s + n]), set()).add(str(i))
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s : s + n]))
                if found:
                    hit.update(range(s, s + n))
                    ids |= found
        out.append((d, len(w), len(hit), sorted(ids)))
    return sorted(out, key=str)


ITEMS = [
    (1, "the quick brown fox jumps over the lazy dog near the quiet river"),
    (2, "Autre texte"),
    (2, "the quick brown fox jumps over the lazy dog near"),
    (3, None),
    (4, "..."),
    (None, "brown fox"),
    (5, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7 w8x8 w9x9 w10x10 other end"),
    (6, "no such words here"),
    (6, "no such words here"),
]


def test_odd_rows(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = positional_index.contamination(odd, items).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got], key=str) == brute(rows, ITEMS)
    clean = positional_index.without_contaminated(odd, items)
    assert clean.columns == odd.columns
    assert sorted([(r["doc_id"], r["text"]) for r in clean.collect()], key=str) == sorted([x for x, b in zip(rows, [brute([x], ITEMS)[0] for x in rows]) if not b[2]], key=str)


@pytest.mark.parametrize("which", ["docs", "items"])
def test_empty_tables(spark, odd, empty, which):
    items = spark.createDataFrame(ITEMS if which == "docs" else [], "item_id long, text string")
    got = positional_index.contamination(empty if which == "docs" else odd, items).collect()
    assert len(got) == (0 if which == "docs" else odd.count())
    assert not any(r["n_hit"] for r in got)


def test_query_digest(spark):
    got = QUERIES["op4_decontamination"](spark, "/root/testdata/sf0.001").collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(docs, items)]
    assert sorted([tuple(r) for r in got], key=str) == want
    assert any(w[5] for w in want)


def test_full_index_and_proximity(spark, odd):
    index = positional_index.build_index(odd.where("doc_id = 1").limit(1))
    assert index.where(f"term <> '{positional_index.END}'").count() == 14
    pairs = spark.createDataFrame([("quick", "jumps"), ("quick", "lazy")], "first string, second string")
    got = positional_index.proximity_matches(index, pairs, 3).collect()
    assert [(r["first"], r["second"], r["pos"], r["other"]) for r in got] == [("quick", "jumps", 1, 4)]


@pytest.mark.parametrize("within", [1, 2, 5, 40])
def test_proximity_equals_brute_force(spark, within):
    """Random texts of few words: ties, repeated terms, a term with itself, repeated rows and texts without words."""
    import random

    rnd = random.Random(within)
    texts = [" ".join(rnd.choice("abcdef") for _ in range(rnd.choice([0, 1, 3, 30, 90]))) for _ in range(25)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(3, texts[3]), (100, None)]
    pairs = [("a", "b"), ("b", "a"), ("c", "c"), ("d", "nowhere"), ("e", "f"), ("e", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = positional_index.build_index(docs.distinct())
    got = positional_index.proximity_matches(index, spark.createDataFrame(pairs, "first string, second string"), within)
    names = docs.distinct().select("doc_id", positional_index.row_key().alias("row"))
    got = sorted(tuple(r) for r in got.join(names, "row").select("doc_id", "first", "second", "pos", "other").collect())
    want = [
        (d, a, b, i, j) for d, t in set(rows) for a, b in set(pairs) for i, x in enumerate((t or "").split()) for j, y in enumerate((t or "").split()) if (x, y) == (a, b) and abs(i - j) <= within
    ]
    assert got == sorted(want) and (within == 1 or len(want) > 100)
