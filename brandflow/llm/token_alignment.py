"""Alignment of two tokenizers' tokens by merge-path partitioning of their byte ends.

A text's A tokens and B tokens cut the same bytes. Walk along the merged list of
both tokenizers' ends: while A token i and B token j are open, their byte ranges
overlap and make a link; each end closes one of them, and where both end at the same
byte a group ends. The ends of all texts of a block are merged as one list, since
every text ends with a common end.

Merge path: the walk over n A ends and m B ends has n + m steps. Cut into pieces of
``PIECE`` steps, its k-th piece starts on diagonal k * PIECE, and a binary search along
that diagonal finds how many A and B ends lie before. So all pieces do equal work,
whatever the lengths of texts and tokens, and depend on nothing else; they go
forward together, one step of every piece at a time. Each emits the overlaps it
meets and numbers its groups from 0; running sums of the pieces' group ends stitch
the groups that continue into the next piece.

A document is tokenized and aligned by the task that reads its row. What all
documents need together, how many links hold a pair of ids, is summed within tasks
and shuffled once, one row a task and pair. That table is bounded by the pairs of
vocabulary entries that can overlap, not by the corpus; it goes to the tasks by
broadcast if it is proven to have at most ``broadcast_pairs`` rows, else the documents'
pairs are joined with it, frequent pairs salted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .piece_backtrack import SPACE, PieceEncoder, PieceModel, WordCodes, broadcast_model, model_bytes, offsets32, text_blocks
from .scratch import free_name, written

#: Steps of a piece of the merge path.
PIECE = 64
#: Largest table of pairs that is broadcast (17 bytes a pair).
BROADCAST_PAIRS = 8_000_000
#: When the table is joined, a pair with over 1 / ``HOT_PAIRS`` of all links (so there are fewer) meets its count on ``SALTS`` tasks.
HOT_PAIRS, SALTS = 10_000, 64
# How the byte-level vocabulary splits texts into words before it merges.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ------------------------------------------------------------------------ merge path


class Overlaps(NamedTuple):
    a: np.ndarray  # A token of each link, in the order of the walk
    b: np.ndarray
    group: np.ndarray  # its group's number
    groups: int


def diagonal_starts(a_ends: np.ndarray, b_ends: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal d, how many of the first d ends of the merged list are A's; of equal ends A's comes first."""
    low, high = np.maximum(0, diagonals - len(b_ends)), np.minimum(diagonals, len(a_ends))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        a_first = open_.copy()
        a_first[open_] = a_ends[middle[open_]] <= b_ends[diagonals[open_] - 1 - middle[open_]]
        low = np.where(open_ & a_first, middle + 1, low)
        high = np.where(open_ & ~a_first, middle, high)
    return low


def merged_overlaps(a_ends: np.ndarray, b_ends: np.ndarray, piece: int = PIECE) -> Overlaps:
    """Links and groups of two rising lists of byte ends whose last ends are equal."""
    n, m = len(a_ends), len(b_ends)
    if not n:
        none = np.zeros(0, np.int64)
        return Overlaps(none, none, none, 0)
    diagonals = np.arange(0, n + m, piece)
    i = diagonal_starts(a_ends, b_ends, diagonals)
    j = diagonals - i
    a, b = np.append(a_ends, a_ends[-1] + 1), np.append(b_ends, b_ends[-1] + 1)  # beyond the last ends
    shape = (len(diagonals), piece)
    at_a, at_b = np.empty(shape, np.int64), np.empty(shape, np.int64)
    linked, ends = np.zeros(shape, bool), np.zeros(shape, bool)
    for step in range(piece):
        inside = i + j < n + m
        # between the two ends of a common end, A's token is the next one and B's the one just ended
        between = (i > 0) & (a[i - 1] == b[j])
        at_a[:, step], at_b[:, step] = i, j
        linked[:, step] = inside & ~between
        ends[:, step] = inside & between
        a_next = a[i] <= b[j]
        i, j = i + (a_next & inside), j + (~a_next & inside)
    local = np.cumsum(ends, axis=1)  # groups that ended in the piece, up to each step
    before = np.concatenate(([0], np.cumsum(local[:, -1])[:-1]))  # and in the pieces before it
    group = local + before[:, None]
    return Overlaps(at_a[linked], at_b[linked], group[linked], int(local[:, -1].sum()))


# ------------------------------------------------------------------------ tokens


class ByteLevelTokenizer:
    """Words of a byte-level BPE tokenizer file; each distinct word goes through the library's merges once."""

    def __init__(self, content: str) -> None:
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        tokenizer = Tokenizer.from_str(content)
        symbols = sorted(ByteLevel.alphabet(), key=ord)
        # the alphabet's characters stand for the bytes: those that are printable stand for themselves
        own = {c: ord(c) for c in symbols if ord(c) < 256}
        others = [b for b in range(256) if b not in own.values()]
        byte_of = own | dict(zip([c for c in symbols if c not in own], others))
        self.symbol = {b: c for c, b in byte_of.items()}
        self.size = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for entry, k in tokenizer.get_vocab(with_added_tokens=False).items():
            self.size[k] = len(entry)  # one symbol a byte
        self.split = regex.compile(BYTE_LEVEL_WORDS).findall
        self.merge = tokenizer.model.tokenize
        self.codes = WordCodes(self._word)

    def _word(self, word: str) -> list[int]:
        return [t.id for t in self.merge("".join(map(self.symbol.__getitem__, word.encode())))]

    def encoded(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of texts, and the offsets of the texts in them."""
        return self.codes.tokens(map(self.split, texts))


class _Worker:
    """Both tokenizers of a Python worker, with the words they know."""

    def __init__(self, a: ByteLevelTokenizer, b: PieceEncoder) -> None:
        self.a, self.b = a, b
        self.written = _Written(len(a.size), len(b.byte_size))


_WORKERS: dict[tuple[str, str], _Worker] = {}


def _worker(a: tuple[str, str], b: PieceModel) -> _Worker:
    key = a[1], b.digest
    if key not in _WORKERS:
        _WORKERS[key] = _Worker(ByteLevelTokenizer(a[0]), PieceEncoder(b))
    return _WORKERS[key]


class Vocabularies(NamedTuple):
    a: Broadcast[tuple[str, str]]  # tokenizer file and its hash
    b: Broadcast[PieceModel]


def vocabularies(spark: SparkSession, a_path: str, b_path: str) -> Vocabularies:
    """Both vocabulary files, read on the driver (their sizes are checked) and broadcast."""
    import json

    data = model_bytes(a_path)
    spec = json.loads(data)
    kind, words = spec["model"], spec["pre_tokenizer"]
    plain = kind["type"] == "BPE" and words["type"] == "ByteLevel" and words.get("use_regex", True) and not words["add_prefix_space"]
    if not plain or spec["normalizer"] or kind.get("dropout") or kind.get("ignore_merges"):
        raise ValueError(f"{a_path}: not a plain byte-level BPE tokenizer")
    a = spark.sparkContext.broadcast((data.decode(), hashlib.sha256(data).hexdigest()))
    return Vocabularies(a, broadcast_model(spark, b_path))


# ------------------------------------------------------------------------ alignment of documents

#: What ``aligned_tokens`` adds. ``groups`` lists each group's A and B ids: ``a1,a2|b1;a3|b2,b3``, empty without
#: tokens. ``pairs`` are a_id * 2^32 + b_id, rising, ``pair_links`` how many links of the document hold each.
ALIGNED = T.StructType(
    [
        T.StructField("n_a", T.LongType()),
        T.StructField("n_b", T.LongType()),
        T.StructField("n_groups", T.LongType()),
        T.StructField("n_links", T.LongType()),
        T.StructField("groups", T.StringType()),
        T.StructField("pairs", T.ArrayType(T.LongType())),
        T.StructField("pair_links", T.ArrayType(T.IntegerType())),
    ]
)


class _Written:
    """Token ids as text, with the mark that stands before them: ',' or ';' for A's, ',' or '|' for B's."""

    def __init__(self, n_a: int, n_b: int) -> None:
        marks = [(",", n_a), (";", n_a), (",", n_b), ("|", n_b)]
        self.text = np.array([f"{mark}{k}" for mark, n in marks for k in range(n)], object)
        self.more_a, self.first_a, self.more_b, self.first_b = np.cumsum([0, n_a, n_a, n_b]).tolist()

    def groups(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, cut: np.ndarray) -> list[str]:
        """The groups of each document as text; ``cut`` has its first group, and the number of groups at the end."""
        # a group's A tokens, then its B tokens: tokens of the other side that come before each one
        n = int(cut[-1])
        a_at = np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")
        b_at = np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")
        which = np.empty(len(a) + len(b), np.int64)
        which[a_at] = a + np.where(np.diff(a_group, prepend=-1) != 0, self.first_a, self.more_a)
        which[b_at] = b + np.where(np.diff(b_group, prepend=-1) != 0, self.first_b, self.more_b)
        before = np.searchsorted(a_group, np.arange(n + 1)) + np.searchsorted(b_group, np.arange(n + 1))
        ends = before[cut].tolist()
        texts = self.text[which].tolist()
        return ["".join(texts[s:e])[1:] for s, e in zip(ends, ends[1:])]


def _block_columns(texts: list[str | None], worker: _Worker) -> list[pa.Array]:
    a_size, b_size = worker.a.size, worker.b.byte_size
    # B's bytes are the text's own unless it holds the character that B writes for a space
    texts = [t if t and SPACE not in t else "" for t in texts]
    a, a_cut = worker.a.encoded(" " + t if t else "" for t in texts)
    b, b_cut = worker.b.encoded(texts)
    a_ends, b_ends = np.cumsum(a_size[a]), np.cumsum(b_size[b])
    if len(a) and a_ends[-1] != b_ends[-1]:
        raise AssertionError("both tokenizations must cut the same bytes")
    walk = merged_overlaps(a_ends, b_ends)
    doc = np.repeat(np.arange(len(texts)), np.diff(a_cut))[walk.a]
    first = np.flatnonzero(np.diff(walk.group, prepend=-1))  # of each group's links
    n_groups, n_links = (np.bincount(x, minlength=len(texts)) for x in (doc[first], doc))
    a_group, b_group = (np.repeat(np.arange(walk.groups), np.diff(np.append(x[first], len(y)))) for x, y in ((walk.a, a), (walk.b, b)))
    groups = worker.written.groups(a, b, a_group, b_group, np.concatenate(([0], np.cumsum(n_groups))))
    # links of each document and pair
    a_bits, b_bits = len(a_size).bit_length(), len(b_size).bit_length()
    key = np.sort((((doc << a_bits) | a[walk.a]) << b_bits) | b[walk.b])
    new = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(np.append(new, len(key))).astype(np.int32)
    key = key[new]
    pairs = ((key >> b_bits & ((1 << a_bits) - 1)) << 32) | (key & ((1 << b_bits) - 1))
    pair_cut = offsets32(np.searchsorted(key >> (a_bits + b_bits), np.arange(len(texts) + 1)))
    return [
        pa.array(np.diff(a_cut)),
        pa.array(np.diff(b_cut)),
        pa.array(n_groups),
        pa.array(n_links),
        pa.array(groups, pa.string()),
        pa.ListArray.from_arrays(pair_cut, pa.array(pairs)),
        pa.ListArray.from_arrays(pair_cut, pa.array(times)),
    ]


def aligned_tokens(docs: DataFrame, vocabularies: Vocabularies, text_col: str = "text") -> DataFrame:
    """``docs`` without ``text_col``, with the columns of ``ALIGNED``: both tokenizations of space + text, aligned.

    A null or empty text, and one whose B tokens don't give its bytes back, has no
    tokens: zeros, empty text and arrays. Rows are independent, repeated rows stay; a column
    of ``docs`` with a name of ``ALIGNED`` gets underscores. Map-only; a task holds a block of
    texts, or one longer text, with its tokens.
    """
    kept = [c for c in docs.columns if c != text_col]
    taken = [*kept, *ALIGNED.names, text_col]
    renamed = {c: free_name(taken, c) for c in kept if c.lower() in ALIGNED.names}
    docs = docs.withColumnsRenamed(renamed)
    kept = [renamed.get(c, c) for c in kept]
    schema = T.StructType([*[docs.schema[c] for c in kept], *ALIGNED.fields])
    a, b = vocabularies

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _worker(a.value, b.value)
        for rows, texts in text_blocks(batches, text_col):
            columns = _block_columns(texts, worker)
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], *columns], schema.names)

    return docs.mapInArrow(align, schema)


# ------------------------------------------------------------------------ counts of all documents


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, links, best): links of each pair over all rows, and whether no pair of its B id has more."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "pair_links")).alias("p"))
    counts = written(each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_links").alias("links")), "pairs")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(b.alias("b")).agg(F.max("links").alias("most"))
    return counts.join(most, b == F.col("b")).select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def link_scores(aligned: DataFrame, counts: DataFrame, *, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` without its pairs, with ``n_best`` (links whose pair is a best one of its B id) and ``count_sum``."""
    counts = written(counts, "pair-counts")
    if counts.count() <= broadcast_pairs:
        return _scored_by_lookup(aligned, counts)
    return _scored_by_join(aligned, counts)


def _kept(aligned: DataFrame) -> list[str]:
    return [c for c in aligned.columns if c not in ("pairs", "pair_links")]


def _scored_by_lookup(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    kept = _kept(aligned)
    names = [free_name(kept, "n_best"), free_name(kept, "count_sum")]
    table = counts.toArrow()  # its size was checked
    pair = table["pair"].to_numpy()
    order = np.argsort(pair)
    shared = aligned.sparkSession.sparkContext.broadcast(
        (pair[order], table["links"].to_numpy()[order], table["best"].to_numpy(zero_copy_only=False)[order])
    )
    schema = T.StructType([*[aligned.schema[c] for c in kept], *[T.StructField(c, T.LongType()) for c in names]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, links, best = shared.value
        for rows in batches:
            lists = rows.column("pairs")
            times = rows.column("pair_links").flatten().to_numpy().astype(np.int64)
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            doc = np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy())
            sums = []
            for each in (np.where(best[at], times, 0) if len(at) else times, times * links[at] if len(at) else times):
                total = np.zeros(rows.num_rows, np.int64)
                np.add.at(total, doc, each)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in kept], *sums], schema.names)

    return aligned.mapInArrow(score, schema)


def _scored_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a shuffle join; a pair with a large share of the links is dealt to ``SALTS`` tasks."""
    kept = _kept(aligned)
    row, names = free_name(aligned.columns, "row"), [free_name(kept, "n_best"), free_name(kept, "count_sum")]
    rows = written(aligned.withColumn(row, F.monotonically_increasing_id()), "aligned")
    every = counts.agg(F.sum("links")).first()[0] or 0
    often = counts.withColumn("salts", F.when(F.col("links") * HOT_PAIRS > every, SALTS).otherwise(1))
    dealt = often.select("pair", "links", "best", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    hot = F.broadcast(often.where("salts > 1").select("pair", "salts"))  # fewer than HOT_PAIRS rows
    each = rows.select(F.col(row).alias("row"), F.explode(F.arrays_zip("pairs", "pair_links")).alias("p"))
    each = each.select("row", F.col("p.pairs").alias("pair"), F.col("p.pair_links").alias("times"))
    each = each.join(hot, "pair", "left").withColumn("salt", (F.col("row") % F.coalesce("salts", F.lit(1))).cast("int"))
    sums = (
        each.join(dealt, ["pair", "salt"])
        .groupBy(F.col("row").alias(row))
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("in_best"), F.sum(F.col("times") * F.col("links")).alias("in_all"))
    )
    sums = sums.select(row, *[F.col(c).cast("long").alias(n) for c, n in zip(("in_best", "in_all"), names)])
    return rows.join(sums, row, "left").select(*kept, *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in names])
