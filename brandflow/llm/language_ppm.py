"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes: for every context of up to
``max_order`` symbols seen in its training texts, how often each symbol
followed. A text is scored by the exact code length its bytes would take under
each language's frozen tree: a symbol seen after the longest known context
costs ``-log2(n / (N + q))``, an unseen one pays the escape ``-log2(q / (N + q))``
(method C: q distinct symbols among N) and is coded in the next shorter
context, down to a uniform code over all bytes. The shortest code wins.

The trees of all languages are kept as one automaton: a state is the longest
suffix of the text so far that is a context of any tree, and a table holds the
cost of every next symbol in every state under every language. So a text is
scored with a few array look-ups a byte, whole, whatever its length.

Symbols: 0 starts a text, every byte value of the sample has its own, and the last
stands for the values that no training text holds. Those cost the same in every
context, the whole escape chain and 8 bits, so their sharing a symbol loses nothing:
code lengths are those of trees over all 256 values.

Training reads a sample: each language keeps about ``train_docs`` of its
documents (all if it has fewer), chosen by a hash of doc_id. The sample, and so
the trees, stay bounded as the corpus grows; a language is learned whatever its size.

Defined results: a text that is null or has no letter gives ``und``, score 0;
rows with null lang or null text are not learned from; with nothing to learn
from every text is ``und``. Ties go to the smaller language code. Columns other
than doc_id, text and lang are passed through and never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textbytes import blocks, utf8

UNKNOWN = "und"
#: The sample's hashes are compared with a threshold below this, fine enough for a language of any size.
SAMPLE_GRAIN = 1 << 62


def held_out(doc_id: Column) -> Column:
    """The rows that no label may be learned from: crc32 of doc_id as text, modulo 4, is 2. A null doc_id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


@dataclass
class LanguageModel:
    """``step[state, symbol]`` is the next state, ``cost[state, symbol, language]`` the bits of the symbol."""

    langs: list[str]
    symbol: np.ndarray
    step: np.ndarray
    cost: np.ndarray
    start: int
    max_order: int

    def bits(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Code length in bits of each value under each language."""
        n, k = len(off) - 1, self.max_order
        out = np.zeros((n, len(self.langs)))
        width = self.symbol_count
        step, cost = self.step.reshape(-1), self.cost.reshape(-1, len(self.langs))
        for i, j in blocks(off):
            part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
            for a in range(0, len(part), 1 << 21):  # a long text in pieces that share max_order symbols
                b = min(len(part), a + (1 << 21))
                own = o[np.searchsorted(o, a, "right") - 1 : np.searchsorted(o, b, "left") + 1].clip(a, b)
                before = max(0, a - k)
                sym = self.symbol[part[before:b]].astype(np.int32)
                state = self._states(sym, np.setdiff1d(o[:-1], [len(part)]) - before, step, width)[a - before :]
                sym = sym[a - before :]
                if not len(sym):
                    continue
                lens = np.diff(own)
                seg = np.searchsorted(o, own[:-1], "right") - 1
                full = lens > 0
                add = np.add.reduceat(cost[state * width + sym], (own[:-1] - a)[full], axis=0, dtype=np.float64)
                np.add.at(out, i + seg[full], add)
        return out

    @property
    def symbol_count(self) -> int:
        return self.step.shape[1]

    def _states(self, sym: np.ndarray, heads: np.ndarray, step: np.ndarray, width: int) -> np.ndarray:
        """State before each symbol: the longest known context of at most max_order symbols."""
        heads = heads[(heads >= 0) & (heads < len(sym))]
        state = np.zeros(len(sym), np.int32)  # the empty context
        state[heads] = self.start
        for _ in range(self.max_order):
            after = step[state * width + sym]
            state[1:] = after[:-1]
            state[heads] = self.start
        return state


def _context_counts(symbol: np.ndarray, width: int, max_order: int):
    """Counts of (language, order, context, next symbol) of a batch of training texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            data, off = utf8(batch.column("text"))
            found = []
            for i, j in blocks(off, 1 << 21):
                part, o = symbol[data[off[i] : off[j]]].astype(np.int64), off[i : j + 1] - off[i]
                names, of = np.unique(np.array(langs[i:j], dtype=object).astype(str), return_inverse=True)
                lang = np.repeat(of, np.diff(o))
                depth = np.arange(len(part)) - np.repeat(o[:-1], np.diff(o))  # symbols before this one in its text
                code = np.zeros(len(part), np.int64)
                for order in range(max_order + 1):
                    # the start symbol (0) stands before the text, once
                    if order:
                        older = np.zeros(len(part), np.int64)
                        older[order:] = part[:-order]
                        older[depth < order] = 0
                        code = code + older * width**order
                    use = depth >= order - 1  # contexts may reach the start, not beyond
                    key, n = np.unique((lang[use] * (max_order + 1) + order) * width ** (max_order + 1) + code[use] + part[use], return_counts=True)
                    head = key // width ** (max_order + 1)
                    found.append(pd.DataFrame({"lang": names[head // (max_order + 1)], "depth": (head % (max_order + 1)).astype("int32"), "gram": key % width ** (max_order + 1), "n": n}))
            if found:
                all_ = pd.concat(found).groupby(["lang", "depth", "gram"], as_index=False)["n"].sum()
                yield pa.RecordBatch.from_pandas(all_.astype({"depth": "int32", "gram": "int64", "n": "int64"}), preserve_index=False)

    return count


def _train_sample(docs: DataFrame, train_docs: int) -> DataFrame:
    """About ``train_docs`` labelled documents of each language (all if it has fewer), chosen by a hash of doc_id."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a language
    if not sizes:
        return rows.select("lang", "text").limit(0)
    rate = F.lit(0).cast("long")
    for lang, n in sorted(sizes.items()):
        rate = F.when(F.col("lang") == lang, F.lit(_threshold(n, train_docs)).cast("long")).otherwise(rate)
    return rows.where(F.shiftrightunsigned(F.xxhash64(F.col("doc_id")), 2) < rate).select("lang", "text")


def _threshold(n: int, train_docs: int) -> int:
    """Hashes below it, of ``SAMPLE_GRAIN``, are in the sample of a language with ``n`` documents."""
    return SAMPLE_GRAIN if n <= train_docs else SAMPLE_GRAIN * train_docs // n


def fit_language_model(docs: DataFrame, max_order: int = 3, train_docs: int = 500) -> LanguageModel | None:
    """Learn the trees from ``docs`` (doc_id, text, lang), without its held-out rows. None if there is nothing to learn from.

    What reaches the driver are the contexts of the bounded sample, at most
    ``(max_order + 1) x bytes`` of it and in practice a small share of that.
    """
    if not 1 <= max_order <= 4:
        raise ValueError("max_order: 1 to 4")
    sample = _train_sample(docs, train_docs)
    symbols, counts = _symbols(sample), None
    if symbols is None:
        return None
    symbol, width = symbols
    counts = (
        sample.mapInArrow(_context_counts(symbol, width, max_order), "lang string, depth int, gram long, n long")
        .groupBy("lang", "depth", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    return None if not counts.num_rows else _automaton(counts, symbol, width, max_order)


def _symbols(sample: DataFrame) -> tuple[np.ndarray, int] | None:
    def byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(utf8(batch.column("text"))[0], minlength=256)
        yield pa.RecordBatch.from_pydict({"byte": pa.array(np.arange(256), pa.int32()), "n": pa.array(total)})

    rows = sample.select("text").mapInArrow(byte_counts, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).where("n > 0").collect()
    if not rows:
        return None
    held = sorted(r["byte"] for r in rows)
    symbol = np.full(256, len(held) + 1, np.uint16)
    symbol[held] = np.arange(1, len(held) + 1)
    return symbol, len(held) + 2


def _automaton(counts: pa.Table, symbol: np.ndarray, width: int, max_order: int) -> LanguageModel:
    named = counts["lang"].combine_chunks().dictionary_encode()
    langs = sorted(named.dictionary.to_pylist())
    lang = np.array([langs.index(x) for x in named.dictionary.to_pylist()])[named.indices.to_numpy()]
    depth, gram, n = (counts[c].to_numpy() for c in ("depth", "gram", "n"))
    context, nxt = gram // width, gram % width

    # states: the contexts, by order; the code of a context has its oldest symbol in the highest place
    known = [np.zeros(1, np.int64)]
    base = [0]
    for k in range(1, max_order + 1):
        base.append(base[-1] + len(known[-1]))
        known.append(np.unique(context[depth == k]))
    total = base[-1] + len(known[-1])

    def place(k: int, code: np.ndarray) -> np.ndarray:
        """State of contexts of order k, -1 where there is none."""
        at = np.searchsorted(known[k], code).clip(max=len(known[k]) - 1)
        return np.where(known[k][at] == code, base[k] + at, -1) if len(known[k]) else np.full(len(code), -1)

    step = np.zeros((total, width), np.int32)
    cost = np.empty((total, width, len(langs)), np.float32)
    others = max(1, 256 - (width - 2))  # byte values that no training text holds
    for k in range(max_order + 1):
        size = len(known[k])
        # shorter context: drop the oldest symbol
        shorter = place(k - 1, known[k] % width ** (k - 1)) if k else None
        ending = known[k][:, None] * width + np.arange(width)[None, :]
        best = np.full((size, width), -1, np.int64)
        for j in range(min(k + 1, max_order), 0, -1):
            at = place(j, (ending % width**j).ravel()).reshape(size, width)
            best = np.where(best < 0, at, best)
        step[base[k] : base[k] + size] = best.clip(0)
        rows = np.flatnonzero(depth == k)
        at = np.searchsorted(known[k], context[rows])
        rows, at = rows[np.argsort(at, kind="stable")], np.sort(at, kind="stable")
        for low in range(0, size, 1024):  # so many contexts at once, to bound the memory
            high = min(size, low + 1024)
            if k:
                lower = cost[shorter[low:high]]
            else:
                lower = np.full((1, width, len(langs)), 8.0, np.float32)
                lower[:, width - 1] -= np.log2(others)
            seen = np.zeros((high - low, width, len(langs)), np.float32)
            own = slice(*np.searchsorted(at, (low, high)))
            seen[at[own] - low, nxt[rows[own]], lang[rows[own]]] = n[rows[own]]
            whole, kinds = seen.sum(axis=1, keepdims=True), (seen > 0).sum(axis=1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                coded = -np.log2(seen / (whole + kinds))
                escape = -np.log2(kinds / (whole + kinds))
            cost[base[k] + low : base[k] + high] = np.where(seen > 0, coded, np.where(whole > 0, escape, 0.0) + lower)
    cost[:, width - 1] += np.log2(others)  # which of the other bytes it is
    start = int(place(1, np.zeros(1, np.int64))[0])
    return LanguageModel(langs, symbol, step, cost, max(start, 0), max_order)


def _predicted(m: LanguageModel | None, text: pa.Array, letter: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and code length per byte of each text."""
    data, off = utf8(text)
    lens = np.diff(off)
    if m is None:
        return np.full(len(lens), UNKNOWN, object), np.zeros(len(lens)), np.zeros(len(lens))
    bits = m.bits(data, off)
    scale = np.minimum(1.0, EVIDENCE_BYTES / np.maximum(lens, 1))
    score = 1.0 / np.exp2(-(bits - bits.min(axis=1, keepdims=True)) * scale[:, None]).sum(axis=1)
    rate = bits.min(axis=1) / np.maximum(lens, 1)
    lang = np.array(m.langs, object)[bits.argmin(axis=1)]
    none = ~letter.to_numpy(zero_copy_only=False).astype(bool)
    lang[none], score[none] = UNKNOWN, 0.0
    return lang, score, rate


def _with_letter(docs: DataFrame) -> tuple[DataFrame, str]:
    flag = "_letter"
    while flag in docs.columns:
        flag += "_"
    return docs.withColumn(flag, F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))), flag


def identify_languages(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The columns of ``docs`` other than text and lang, with lang_pred, score and bits_per_byte.

    score is the posterior of the language under equal priors, with the code
    lengths of texts over ``EVIDENCE_BYTES`` scaled down to that many bytes:
    code lengths of neighbouring bytes are not independent, and unscaled they
    would put every text longer than a line at exactly 1.
    """
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("bits_per_byte", T.DoubleType())]
    keep = [f for f in docs.schema.fields if f.name not in ("text", "lang", *[a.name for a in added])]
    names = [f.name for f in keep]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    rows, flag = _with_letter(docs.select(*names, "text"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rate = _predicted(shared.value, batch.column("text"), batch.column(flag))
            arrays = [batch.column(c) for c in names] + [pa.array(lang, pa.string()), pa.array(score), pa.array(rate)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, *[a.name for a in added]])

    return rows.mapInArrow(predict, T.StructType([*keep, *added]))


def keep_identified(docs: DataFrame, model: LanguageModel | None, max_bits: float = 8.0) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text is in a learned language.

    Rejected are ``und`` texts and those whose bytes cost more than
    ``max_bits`` each under every language, i.e. more than writing them plainly.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows, flag = _with_letter(docs)
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, _, rate = _predicted(shared.value, batch.column("text"), batch.column(flag))
            yield batch.select(names).filter(pa.array((lang != UNKNOWN) & (rate <= max_bits)))

    return rows.mapInArrow(keep, docs.schema)


#: Bytes of evidence that the score of a long text counts.
EVIDENCE_BYTES = 64
