import itertools
import random

import numpy as np
import pytest

from brandflow.llm import toxicity
from brandflow.llm.language_ppm import held_out

INSULTS = ["idiot", "moron", "worthless"]


def brute_kernel(s, t):
    """Sum over all pairs of equal subsequences of the decay to their lengths."""
    total = 0.0
    for a in itertools.combinations(range(len(s)), toxicity.LENGTH):
        for b in itertools.combinations(range(len(t)), toxicity.LENGTH):
            if [s[i] for i in a] == [t[i] for i in b]:
                total += toxicity.DECAY ** (a[-1] - a[0] + 1 + b[-1] - b[0] + 1)
    return total


def test_kernel_equals_enumeration():
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 9))) for _ in range(25)] + ["idiot", "i-d-i-o-t"]
    got, own = toxicity.raw_kernel(words, words[:9]), toxicity.self_kernel(words)
    for i, s in enumerate(words):
        assert np.allclose(got[i], [brute_kernel(s, t) for t in words[:9]], rtol=1e-4, atol=1e-6)
        assert own[i] == pytest.approx(brute_kernel(s, s) if len(s) >= toxicity.LENGTH else 1.0, rel=1e-4)


def test_short_words_end_where_they_end():
    """Columns past a word's end match nothing, not even a NUL character; the order of the words does not count."""
    left, right = ["\0\0\0\0", "idiot", "aidiota"], ["ab", "idiot", "b", "idiotidiot"]
    got = toxicity.raw_kernel(left, right)
    assert not got[0].any() and np.allclose(got, [[brute_kernel(s, t) for t in right] for s in left], rtol=1e-4, atol=1e-6)


def test_words_and_pieces():
    assert toxicity.sentence_words("You, i d i o t! \"Quoted\" x-y --") == ["you", "idiot", "quoted", "x-y"]
    long = "".join(chr(97 + k % 26) for k in range(95))
    cut = toxicity.pieces(long)
    assert all(len(p) <= toxicity.PIECE for p in cut)
    assert {long[k : k + 10] for k in range(86)} == {p[k : k + 10] for p in cut for k in range(len(p) - 9)}


@pytest.fixture(scope="module")
def made(spark):
    rnd = random.Random(7)
    syllables = ["ba", "do", "ki", "lu", "men", "ra", "so", "ti", "ver", "zan"]
    word = lambda: "".join(rnd.choice(syllables) for _ in range(rnd.randrange(1, 4)))
    rows, labels = [], []
    for k in range(500):
        words = [word() for _ in range(rnd.randrange(20, 60))]
        toxic = k % 5 == 0
        if toxic:
            for _ in range(4):
                words[rnd.randrange(len(words))] = rnd.choice(INSULTS)
        rows.append((k, " ".join(words) + ".", "lang", "clash"))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, value string")
    return docs, spark.createDataFrame([*labels, (None, 1), (3, None), (0, 1)], "doc_id long, toxic int")


def test_held_out_documents_and_disguised_insults(spark, made):
    docs, labels = made
    model = toxicity.fit_toxicity(docs, labels)
    scored = toxicity.score_toxicity(docs.withColumn("held_out", held_out(docs.doc_id)), model)
    assert scored.columns == ["doc_id", "lang", "value", "held_out", "score"]
    rows = scored.where("held_out").collect()
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in rows)
    texts = ["dobaki you idxiot and m-o-r-o-n sotiver", "w o r t h l e s s dobaki mor.on lumen", "dobaki sotiver lumenra tizan", "", None]
    scores = model.scores(texts)
    assert scores[0] >= 0.3 and scores[1] >= 0.3 and max(scores[2:]) < 0.3
    assert scores[3] == scores[4]
    broken = ["id iot", "dobaki wor th less lumen", "i - d - i - o - t", "i. d. i. o. t.", "lumen mo ro n tizan"]
    assert min(model.scores(broken)) >= 0.3
    assert max(model.scores(["id dobaki iot", "wor less th", "mo", "ro n"])) < 0.3


def test_odd_rows(odd, empty, made):
    docs, labels = made
    model = toxicity.fit_toxicity(docs, labels)
    assert toxicity.score_toxicity(odd, model).count() == odd.count()
    assert toxicity.fit_toxicity(empty, labels) is None and toxicity.fit_toxicity(docs, labels.limit(0)) is None
    assert {r["score"] for r in toxicity.score_toxicity(odd, None).collect()} == {0.0}
    assert toxicity.score_toxicity(empty, None).collect() == []


def test_words_that_neighbours_spell():
    whole = frozenset(["worthless", "idiot"])
    starts = frozenset(w[:k] for w in whole for k in range(1, len(w)))
    model = toxicity.ToxicityModel([], np.zeros(0), np.zeros(0), 0.0, whole=whole, starts=starts, known=frozenset(["worth", "less"]))
    assert model.joined(["worth", "less", "than"]) == []  # both are words of clean documents
    assert model.joined(["wor", "th", "less"]) == ["worthless"] and model.joined(["worth", "le", "ss"]) == []
    assert model.joined(["id", "iot", "x", "id", "io", "t"]) == ["idiot", "idiot"]
    assert model.joined(["i", "diots"]) == [] and model.joined([]) == []


def test_marks_between_letters_and_sentence_ends():
    split = [toxicity.sentence_words(s) for s in toxicity._SENTENCE.split("i. d. i. o. t. you! - a - b. Next one.")]
    assert split == [["idiot", "you"], ["ab"] + ["next", "one"], []]
