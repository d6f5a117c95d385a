"""Alignment against every pair of tokens of a text, with both libraries' own encodings."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brandflow.llm import token_alignment as ta
from brandflow.llm.queries import QUERIES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(sizes):
    ends = np.cumsum(sizes)
    return list(zip(ends - sizes, ends))


def brute(libraries, text):
    """(A ids, B ids, groups, links) by comparing every A token with every B token."""
    a_lib, b_lib = libraries
    raw = (" " + (text or "")).encode()
    a, b = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids, b_lib.encode(text or "")
    pieces = [b_lib.id_to_piece(t) for t in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if b_lib.is_byte(t) else p.replace("▁", " ").encode() for t, p in zip(b, pieces)]
    if not text or b"".join(b_bytes) != raw:
        return [], [], [], []
    a_spans = spans(np.array([len(a_lib.id_to_token(t)) for t in a]))
    b_spans = spans(np.array([len(x) for x in b_bytes]))
    links = [(i, j) for i, (s, e) in enumerate(a_spans) for j, (u, v) in enumerate(b_spans) if s < v and u < e]
    both = sorted({e for _, e in a_spans} & {e for _, e in b_spans})
    groups, start = [], 0
    for end in both:
        groups.append(([t for t, (s, e) in zip(a, a_spans) if start <= s < end], [t for t, (s, e) in zip(b, b_spans) if start <= s < end]))
        start = end
    return a, b, groups, [(a[i], b[j]) for i, j in links]


def expected(libraries, rows):
    found = [(doc_id, *brute(libraries, text)) for doc_id, text in rows]
    counts = Counter(link for *_, links in found for link in links)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best, total = sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)
        out.append((doc_id, len(a), len(b), len(groups), len(links), best, total, digest))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_on_the_small_documents(spark, libraries, tmp_path):
    """Whole short documents of the small table: the brute version compares all pairs of tokens."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NULL OR length(text) < 1500").collect()]
    rows += [(9001, None), (9002, ""), (9003, " "), (9004, "<|endoftext|> <s> </s>"), (9005, "a▁b"), (9006, "中文 🙂\n\n  x\t y"), (9006, "中文 🙂\n\n  x\t y")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op11_token_alignment"](spark, str(tmp_path))
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=str) == expected(libraries, rows)


def test_joined_scores_equal_those_looked_up(spark, docs, monkeypatch):
    monkeypatch.setattr(ta, "HOT_PAIRS", 300)  # some pairs are dealt out by salt
    aligned = ta.aligned_tokens(docs.select("doc_id", "text").limit(60), ta.vocabularies(spark, A, B)).drop("groups").cache()
    counts = ta.pair_counts(aligned)
    looked_up, joined = ta.link_scores(aligned, counts), ta.link_scores(aligned, counts, broadcast_pairs=0)
    assert looked_up.columns == joined.columns
    assert sorted(map(tuple, looked_up.collect())) == sorted(map(tuple, joined.collect()))


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64])
def test_pieces_of_any_length_give_the_same_walk(piece):
    rng = random.Random(piece)
    for _ in range(200):
        size = rng.randint(1, 60)
        a, b = (np.array(sorted({size, *rng.sample(range(1, size + 1), rng.randint(1, size))})) for _ in "ab")
        starts_a, starts_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
        links = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]]
        common = np.array(sorted(set(a) & set(b)))
        walk = ta.merged_overlaps(a, b, piece)
        assert list(zip(walk.a, walk.b)) == links and walk.groups == len(common)
        assert walk.group.tolist() == [int(np.searchsorted(common, max(starts_a[i], starts_b[j]), "right")) for i, j in links]


def test_byte_level_words_split_as_the_tokenizer_does(libraries):
    """Every code point of the planes in use: after a letter, a digit, a space and itself."""
    tokenizer = ta.ByteLevelTokenizer(open(A).read())
    wrong = []
    for start in [*range(0, 0x32000, 64), *range(0xE0000, 0xE0200, 64)]:
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1 {c} {c}{c}" for c in chars)
        if text and tokenizer.encoded([text])[0].tolist() != libraries[0].encode(text, add_special_tokens=False).ids:
            wrong.append(start)
    assert not wrong


def test_odd_rows(spark, odd, empty):
    rows = odd.withColumn("groups", F.lit("clash"))
    vocabularies = ta.vocabularies(spark, A, B)
    out = ta.aligned_tokens(rows, vocabularies)
    assert out.count() == odd.count() and {r["groups_"] for r in out.select("groups_").collect()} == {"clash"}
    blank = out.where("doc_id IN (2, 3)").select("n_a", "n_b", "n_groups", "n_links", "groups", "pairs").collect()
    assert {str(tuple(r)) for r in blank} == {str((0, 0, 0, 0, '', []))}
    twice = out.where("doc_id = 1").collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    none = ta.aligned_tokens(empty, vocabularies)
    assert ta.link_scores(none, ta.pair_counts(none)).count() == 0
