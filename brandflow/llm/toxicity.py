"""Toxicity by a subsequence string-kernel SVM with Nystrom landmarks.

Sentences are compared through their words, and words by the gap-weighted
subsequence kernel: two words are alike as far as they share subsequences of
``LENGTH`` characters, each gap costing a factor ``DECAY``, normalised to 1 for
equal words. So "idxiot" or "i-d-i-o-t" stays close to "idiot", and letters set
apart by spaces are read as one word. A landmark set maps every word to a short
vector (Nystrom: kernel values to the landmarks times the inverse root of the
landmarks' kernel matrix), in which a linear SVM is trained.

Labels are known per document only. Words become training examples by
explaining the labels: candidates are words significantly commoner in toxic
documents; they are taken greedily, each counted on the toxic documents not yet
explained by others, which drops words that merely ride along in copies of a
toxic document. Words of clean documents are the counter-examples: a hash sample
and, in a second round, those that the first SVM rates highest. A word with marks in
it is also read without them. Insults broken up by spaces (``id iot``) are joined again:
neighbouring words that spell a learned toxic word are read as that word too, if one of
them is no word of clean documents (``worth less`` stays two words) or if they are at
least three pieces too short to tell. A sentence's
value is that of its worst word. A logistic curve over the document's worst
sentence, its number of toxic words and their density gives the score.

Training reads a bounded sample: about ``train_docs`` labelled documents (all if
there are fewer), chosen by a hash of doc_id, held-out rows excluded. Scoring
reads whole texts.

Defined results: null and empty texts score like a document without toxic words.
Rows with a null label or null doc_id are not learned from; without any toxic or
without any clean document to learn from every score is 0. Columns other than
doc_id and text are never inputs of a score.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .language_ppm import SAMPLE_GRAIN, held_out
from .scratch import written

LENGTH, DECAY = 3, 0.6
#: Longest word compared in one piece; a longer one is cut into overlapping pieces of this length.
PIECE = 20
#: Landmarks from toxic words, from clean words like them, and from other clean words.
LANDMARKS = (48, 16, 8)
#: SVM value above which a word counts as toxic in a document's features; 1 is the margin.
SURE = 0.4
#: Weight of a margin violation against the norm of the weights.
COST = 100.0
CACHE = 400_000
#: Words compared with the landmarks at once: the tables of the dynamic programme stay in a core's cache.
BLOCK = 1024

#: Stripped from the ends of words.
_MARKS = string.punctuation + "\u00a1\u00bf\u00ab\u00bb\u2018\u2019\u201a\u201c\u201d\u201e\u2013\u2014\u2026\u00b7\u2022"
#: Ends of sentences; a mark after a single letter ends none, so "i. d. i. o. t." stays together.
_SENTENCE = re.compile(r"(?<!\s\w)(?<!^\w)[.!?\n]+(?:\s+|$)")
#: Most pieces of a word broken up by spaces, shortest learned word that is looked for so, clean documents that make a piece a word.
MOST_PIECES, BROKEN, WORD_DOCS = 6, 4, 2


def sentence_words(sentence: str) -> list[str]:
    """Words of a sentence, lower case, without marks at their ends; runs of single characters, marks between them or not, make one word."""
    out, single = [], []
    for raw in sentence.lower().split():
        w = raw if raw.isalnum() else raw.strip(_MARKS)  # no mark is a letter or digit
        if len(w) == 1:
            single.append(w)
            continue
        if not w:
            continue
        if single:
            out.append("".join(single))
            single = []
        out.append(w)
    if single:
        out.append("".join(single))
    return out


def pieces(word: str) -> list[str]:
    """The parts of a word that are compared: the whole, or overlapping pieces of it; with and without marks in it."""
    bare = word if word.isalnum() else "".join(c for c in word if c.isalnum())
    if len(word) <= PIECE:
        return [word] if bare == word or not bare else [word, bare[:PIECE]]
    step = PIECE // 2
    return [w[k : k + PIECE] for w in dict.fromkeys((word, bare)) for k in range(0, max(1, len(w) - step), step) if w]


def _codes(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    lens = np.array([len(w) for w in words])
    joined = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32).reshape(len(words), width)
    return joined, lens


def raw_kernel(left: list[str], right: list[str]) -> np.ndarray:
    """Gap-weighted counts of common subsequences of ``LENGTH`` characters, every left word with every right word."""
    out = np.zeros((len(left), len(right)), np.float32)
    if not left or not right:
        return out
    order = sorted(range(len(right)), key=lambda k: -len(right[k]))  # long ones first
    longest = [right[k] for k in order]
    t, lens = _codes(longest, max(map(len, right)))
    reach = [int((lens > j).sum()) for j in range(t.shape[1])]
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(left):
        by_length.setdefault(len(w), []).append(k)
    for n, rows in by_length.items():
        for a in range(0, len(rows), BLOCK):
            part = rows[a : a + BLOCK]
            s, _ = _codes([left[k] for k in part], max(n, 1))
            out[np.ix_(part, order)] = _kernel_block(s[:, :n], t, reach).T
    return out


def _kernel_block(s: np.ndarray, t: np.ndarray, reach: list[int]) -> np.ndarray:
    """Dynamic programme over the characters of both words, for all pairs at once.

    A common subsequence weighs DECAY to the power of the lengths it spans in both
    words, so only its first and last characters matter: the decay of the first
    goes in with ``DECAY ** -(i + j)``, that of the last at the end, and in between
    there are plain sums over what lies before in both words. Rows are the words of
    ``t``, long ones first; only the first ``reach[j]`` of them have a character ``j``.
    """
    n, m = s.shape[1], t.shape[1]
    shape = (len(t), len(s))
    total = np.zeros(shape, np.float32)
    if n < LENGTH:
        return total
    before = [[np.zeros((reach[j], len(s)), np.float32) for j in range(m)] for _ in range(LENGTH - 1)]
    run = [np.zeros(shape, np.float32) for _ in range(LENGTH - 1)]
    buffers = np.empty(shape, np.float32), np.empty(shape, np.float32)
    s = np.ascontiguousarray(s.T)
    for i in range(n):
        for r in run:
            r.fill(0)
        for j, k in enumerate(reach):
            equal, part = buffers[0][:k], buffers[1][:k]
            np.equal(t[:k, j, None], s[None, i], out=equal, casting="unsafe")
            depth = min(i, j, LENGTH - 1)  # characters that can lie before in both
            if depth == LENGTH - 1:
                np.multiply(equal, before[-1][j], out=part)
                part *= np.float32(DECAY ** (i + j + 2))
                total[:k] += part
            for level in range(min(depth, LENGTH - 2), 0, -1):
                np.multiply(equal, before[level - 1][j], out=part)
                before[level][j] += run[level][:k]
                run[level][:k] += part
            before[0][j] += run[0][:k]
            equal *= np.float32(DECAY ** -(i + j))
            run[0][:k] += equal
    return total


def self_kernel(words: list[str]) -> np.ndarray:
    """k(w, w) of each word; 1 where a word is shorter than ``LENGTH``."""
    out = np.ones(len(words), np.float32)
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if len(w) >= LENGTH:
            by_length.setdefault(len(w), []).append(k)
    decay, square = np.float32(DECAY), np.float32(DECAY * DECAY)
    for n, rows in by_length.items():
        for a in range(0, len(rows), 4096):
            part = rows[a : a + 4096]
            s, _ = _codes([words[k] for k in part], n)
            equal = (s[:, :, None] == s[:, None, :]).astype(np.float32) * square
            table = np.ones((len(part), n + 1, n + 1), np.float32)
            fade = np.tril(decay ** np.abs(np.arange(n)[:, None] - np.arange(n)[None, :])).astype(np.float32)
            for _ in range(LENGTH - 1):
                met = equal * table[:, :-1, :-1]
                table = np.zeros((len(part), n + 1, n + 1), np.float32)
                table[:, 1:, 1:] = fade @ met @ fade.T
            out[part] = (equal * table[:, :-1, :-1]).sum(axis=(1, 2))
    return out


@dataclass
class ToxicityModel:
    landmarks: list[str]
    norms: np.ndarray
    weights: np.ndarray
    bias: float
    curve: np.ndarray = field(default_factory=lambda: np.zeros(4))
    cache: dict[str, float] = field(default_factory=dict)
    #: Learned words that are also found broken up by spaces, their beginnings, and their parts that are words of clean documents.
    whole: frozenset[str] = frozenset()
    starts: frozenset[str] = frozenset()
    known: frozenset[str] = frozenset()

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def joined(self, words: list[str]) -> list[str]:
        """Learned words that neighbouring words of a sentence spell together."""
        out = []
        if self.starts.isdisjoint(words):
            return out
        for a in [k for k, w in enumerate(words) if w in self.starts]:
            w = words[a]
            strange, whole = len(w) >= LENGTH and w not in self.known, w
            for b in range(a + 1, min(a + MOST_PIECES, len(words))):
                v = words[b]
                whole += v
                strange = strange or (len(v) >= LENGTH and v not in self.known)
                short = b - a >= 2 and all(len(x) < LENGTH for x in words[a : b + 1])
                if whole in self.whole and (strange or short):
                    out.append(whole)
                if whole not in self.starts:
                    break
        return out

    def values(self, words: list[str]) -> np.ndarray:
        """SVM value of each word (that of its worst piece)."""
        parts = [pieces(w) for w in words]
        flat = [p for ps in parts for p in ps]
        k = raw_kernel(flat, self.landmarks) / np.sqrt(self_kernel(flat)[:, None] * self.norms[None, :])
        v = k @ self.weights + self.bias
        ends = np.cumsum([len(p) for p in parts])
        return np.maximum.reduceat(v, ends - [len(p) for p in parts]) if len(flat) else np.zeros(0)

    def lookup(self, words: set[str]) -> dict[str, float]:
        new = [w for w in words if w not in self.cache]
        if new:
            if len(self.cache) + len(new) > CACHE:
                self.cache.clear()
                new = list(words)
            for a in range(0, len(new), 20_000):
                part = new[a : a + 20_000]
                self.cache.update(zip(part, self.values(part).tolist(), strict=True))
        return self.cache

    def features(self, texts: list[str | None]) -> np.ndarray:
        """Worst sentence, number of toxic words (log), their share, of each text."""
        docs = [[sentence_words(s) for s in _SENTENCE.split(t)] if t else [] for t in texts]
        if self.starts:
            for sentences in docs:
                for s in sentences:
                    s += self.joined(s)
        value = self.lookup({w for d in docs for s in d for w in s})
        out = np.zeros((len(texts), 3))
        for k, sentences in enumerate(docs):
            worst, toxic, n = -1.0, 0, 0
            for s in sentences:
                vs = [value[w] for w in s]
                if vs:
                    n += len(vs)
                    high = max(vs)
                    worst = max(worst, high)
                    if high > SURE:
                        toxic += sum(v > SURE for v in vs)
            out[k] = max(-1.0, min(worst, 1.5)), math.log1p(toxic), toxic / max(n, 1)
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        x = np.hstack([np.ones((len(texts), 1)), self.features(texts)])
        return 1 / (1 + np.exp(-(x @ self.curve).clip(-30, 30)))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, words, toxic = [], [], []
        for doc, text, label in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            own = {w for s in _SENTENCE.split(text or "") for w in sentence_words(s) if len(w) >= LENGTH}
            words += own
            ids += [doc] * len(own)
            toxic += [label] * len(own)
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "word": pa.array(words, pa.string()), "toxic": pa.array(toxic, pa.int32())})


def _train_rows(docs: DataFrame, labels: DataFrame, train_docs: int) -> DataFrame:
    """Labelled rows that may be learned from, one for each text."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(~held_out(F.col("doc_id")))
    share = int(min(1.0, train_docs / max(known.count(), 1)) * SAMPLE_GRAIN)
    known = known.where(F.pmod(F.xxhash64(F.col("doc_id")), F.lit(SAMPLE_GRAIN)) < share)
    rows = docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id")
    return written(rows.dropDuplicates(["text"]), "train")


def fit_toxicity(docs: DataFrame, labels: DataFrame, train_docs: int = 12000) -> ToxicityModel | None:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic). None without examples of both kinds."""
    train = _train_rows(docs, labels, train_docs)
    size = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    rows = written(train.mapInArrow(_word_rows, "doc_id long, word string, toxic int"), "train-words")
    words = written(rows.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("n")), "word-counts")

    # candidates: commoner in toxic documents than their share, beyond chance (Chernoff bound on the binomial tail)
    base = n_toxic / (n_toxic + n_clean)
    rate = F.col("bad") / F.col("n")
    against = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - base))).otherwise(0.0)
    strength = F.col("n") * (rate * F.log(rate / base) + against)
    strong = words.where((F.col("bad") >= 3) & (rate > max(0.5, 2 * base)) & (strength > 5.0)).select("word", "bad", "n", strength.alias("strength"))
    strong = strong.orderBy(F.col("strength").desc(), "word").limit(3000)
    hits = rows.where("toxic = 1").join(F.broadcast(strong.select("word")), "word").groupBy("word").agg(F.collect_set("doc_id").alias("docs"))
    found = {r["word"]: set(r["docs"]) for r in hits.collect()}  # of the bounded sample
    info = {r["word"]: r for r in strong.collect()}
    toxic_words = _explaining(found, info)
    if not toxic_words:
        return None

    # counter-examples: words that are never, or hardly ever, met more often in toxic documents
    plain = words.where((rate <= max(2 * base, 0.3)) | ((F.col("bad") < 3) & (F.col("bad") < F.col("n"))))
    sample = [r["word"] for r in plain.orderBy(F.xxhash64("word"), "word").limit(1500).collect()]
    common = [r["word"] for r in plain.orderBy(F.col("n").desc(), "word").limit(300).collect()]
    clean = sorted(set(sample) | set(common))
    model = _svm(toxic_words, [], clean)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_pydict({"word": pa.array(w, pa.string()), "n": batch.column("n"), "value": pa.array(shared.value.values(w), pa.float64())})

    hard = plain.select("word", "n").mapInArrow(rated, "word string, n long, value double")
    hard = hard.where("value > -0.6").orderBy(F.col("value").desc(), "word").limit(800).collect()
    model = _svm(toxic_words, [r["word"] for r in hard], clean)

    whole = [w for w, _ in toxic_words if len(w) >= BROKEN and w.isalpha()]
    whole = [w for w, v in zip(whole, model.values(whole), strict=True) if v > SURE]
    model.whole = frozenset(whole)
    model.starts = frozenset(w[:k] for w in whole for k in range(1, len(w)))
    parts = sorted({(w[a:b],) for w in whole for a in range(len(w)) for b in range(a + LENGTH, len(w) + 1)})  # of a bounded number of words
    parts = docs.sparkSession.createDataFrame(parts, "word string")
    in_clean = words.where(F.col("n") - F.col("bad") >= WORD_DOCS).join(F.broadcast(parts), "word", "left_semi")
    model.known = frozenset(r["word"] for r in in_clean.collect())

    shared_final = docs.sparkSession.sparkContext.broadcast(model)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            x = np.concatenate([shared_final.value.features(texts[a : a + 500].to_pylist()) for a in range(0, len(texts), 500)])
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), **{f"x{k}": pa.array(x[:, k]) for k in range(3)}})

    x = train.select("toxic", "text").mapInArrow(featured, "toxic int, x0 double, x1 double, x2 double").toPandas().sort_values(["toxic", "x0", "x1", "x2"])
    model.curve = _curve(x[["x0", "x1", "x2"]].to_numpy(), x["toxic"].to_numpy(float))
    return model


def _explaining(found: dict[str, set[int]], info: dict, times: int = 3) -> list[tuple[str, float]]:
    """Words that explain the toxic documents, taken greedily, with their weight; a document counts until explained ``times`` over."""
    left = Counter(d for docs in found.values() for d in docs)
    left = dict.fromkeys(left, times)
    out: list[tuple[str, float]] = []
    open_words = dict(found)
    least = 3
    while open_words and len(out) < 400:
        gain = {w: sum(left[d] > 0 for d in docs) - 4 * (info[w]["n"] - info[w]["bad"]) for w, docs in open_words.items()}
        best = max(gain, key=lambda w: (gain[w], w))
        if gain[best] < least:
            break
        out.append((best, float(gain[best])))
        for d in open_words.pop(best):
            left[d] -= 1
        open_words = {w: d for w, d in open_words.items() if gain[w] >= least}
    return out


def _svm(toxic: list[tuple[str, float]], hard: list[str], clean: list[str]) -> ToxicityModel:
    """Landmarks, Nystrom map and a linear SVM with squared hinge loss, by Newton steps."""
    bad = [w[:PIECE] for w, _ in toxic]
    taken = {w for w, _ in toxic}
    hard = [w[:PIECE] for w in hard if w not in taken]
    clean = [w[:PIECE] for w in clean if w not in taken and w not in hard and len(w) >= 2]
    landmarks = _spread(bad, LANDMARKS[0]) + _spread(hard, LANDMARKS[1]) + _spread(clean[:: max(1, len(clean) // 400)], LANDMARKS[2])
    clean = hard + clean
    norms = self_kernel(landmarks)

    def vectors(words: list[str]) -> np.ndarray:
        return raw_kernel(words, landmarks) / np.sqrt(self_kernel(words)[:, None] * norms[None, :])

    inner = vectors(landmarks).astype(np.float64)
    values, basis = np.linalg.eigh((inner + inner.T) / 2)
    keep = values > 1e-3
    root = basis[:, keep] / np.sqrt(values[keep])
    words = bad + clean
    x = np.hstack([vectors(words) @ root, np.ones((len(words), 1))])
    y = np.r_[np.ones(len(bad)), -np.ones(len(clean))]
    c = np.r_[np.full(len(bad), COST * max(1.0, len(clean) / (10 * len(bad)))), np.full(len(clean), COST)]
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(50):
        margin = 1 - y * (x @ w)
        inside = margin > 0
        xs, cs = x[inside], c[inside]
        new = np.linalg.solve(ridge + (xs * cs[:, None]).T @ xs, xs.T @ (cs * y[inside]))
        if np.abs(new - w).max() < 1e-9:
            break
        w = new
    return ToxicityModel(landmarks, norms, (root @ w[:-1]).astype(np.float64), float(w[-1]))


def _spread(words: list[str], n: int) -> list[str]:
    """Up to ``n`` words, each the least like those before."""
    if not words:
        return []
    words = list(dict.fromkeys(words))
    out = [words[0]]
    norms = self_kernel(words)
    near = np.zeros(len(words))
    while len(out) < min(n, len(words)):
        last = raw_kernel(words, out[-1:])[:, 0] / np.sqrt(norms * norms[words.index(out[-1])])
        near = np.maximum(near, last)
        k = int(near.argmin())
        if near[k] > 0.95:
            break
        out.append(words[k])
    return out


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    ridge = np.diag([0.0, 0.1, 0.1, 0.1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-(x @ w).clip(-30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(len(w)), x.T @ (y - p) - ridge @ w)
        w += step.clip(-2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """The columns of ``docs`` other than text, with score."""
    keep = [f for f in docs.schema.fields if f.name not in ("text", "score")]
    names, schema = [f.name for f in keep], T.StructType([*keep, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            column, scores = batch.column("text"), []
            for a in range(0, len(column), 500):
                texts = column[a : a + 500].to_pylist()
                scores.append(np.zeros(len(texts)) if m is None else m.scores(texts))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(np.concatenate(scores) if scores else np.zeros(0))], names=schema.names)

    return docs.select(*names, "text").mapInArrow(run, schema)
