"""The encoding and its text, held against the sentencepiece library itself."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from brandflow.llm.piece_backtrack import PieceEncoder, PieceModel, decode_pieces, encode_pieces, read_piece_model
from brandflow.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(read_piece_model(MODEL))


def test_whole_table_equals_the_library(spark, docs, library):
    both = decode_pieces(encode_pieces(docs.select("doc_id", "text"), MODEL), MODEL).collect()
    assert len(both) == docs.count()
    for r in both:
        ids = library.encode(r["text"] or "", add_eos=True)
        assert r["ids"] == ids and r["decoded"] == library.decode(ids)


def test_query_digests(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op13_pieces"](spark, sf).collect():
        ids = library.encode(texts[r["doc_id"]], add_eos=True)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_random_texts(encoder, library):
    rng = random.Random(1)
    parts = [*"aaabbé ▁ \n\t\x00中文字🙂thein,.  ", "<s>", "</s>", "<0x41>", "▁▁", " the", " in", "ing", "    ", "​", "İ", "ß"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        ids, _ = encoder.encoded([text])
        assert ids.tolist() == library.encode(text), repr(text)


def test_vocabulary_entries_side_by_side(encoder, library):
    rng = random.Random(2)
    pieces = [p.replace("▁", " ") for p in encoder.model.pieces[259:]]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 6)))
        assert encoder.encoded([text])[0].tolist() == library.encode(text), repr(text)


def test_decoding_any_ids(encoder, library):
    import numpy as np

    rng = random.Random(3)
    for _ in range(4000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(260), 259 + rng.randrange(30)]) for _ in range(rng.randint(0, 8))]
        assert encoder.decoded(np.array(ids, np.int32)) == library.decode(ids), ids


def test_very_long_words(encoder, library):
    for text in ("ab" * 60_000, "a" * 100_000, " " * 50_000, "中" * 20_000, "\n" * 30_000):
        assert encoder.encoded([text])[0].tolist() == library.encode(text)


def test_odd_rows(spark, odd, empty, library):
    out = encode_pieces(odd.withColumn("ids", F.lit("clash")), MODEL)
    rows = out.collect()
    assert len(rows) == odd.count() and {r["ids_"] for r in rows} == {"clash"}
    assert all(r["ids"] == library.encode(r["text"] or "", add_eos=True) for r in rows)
    assert [r["ids"] for r in rows if r["text"] is None] == [[2]]
    assert encode_pieces(empty, MODEL).count() == 0
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in decode_pieces(none, MODEL).collect()] == [None, ""]


def test_backtracks_where_the_longest_piece_is_wrong():
    # merges: ab (best), then bc; "abc" is [ab, c]; "xabc" can't begin with xa, since ab merges first
    pieces = ["<unk>", "</s>", "ab", "bc", "xa", "x", "a", "b", "c"]
    model = PieceModel(pieces, [0.0, 0.0, -1.0, -2.0, -3.0, -9.0, -9.0, -9.0, -9.0], [2, 3, *[1] * 7], 1, "tiny")
    encoder = PieceEncoder(model)
    for text in ("abc", "xabc", "xbc", "xaxabcbc", "xab" * 50):
        assert [pieces[t] for t in encoder.encode_escaped(text)] == encoder.merged(text)


def test_other_models_are_refused(tmp_path):
    unigram = tmp_path / "unigram.model"
    unigram.write_bytes(b"\x12\x02\x18\x01")  # a trainer's message that names model type 1
    with pytest.raises(ValueError, match="not a BPE model"):
        read_piece_model(str(unigram))
