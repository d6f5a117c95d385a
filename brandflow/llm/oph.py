"""Document fingerprints by one-permutation MinHash, in DataFrame operations only.

Every shingle of five words is hashed once. The highest bits of the hash choose
one of ``BINS`` bins, a bin keeps its smallest hash. An empty bin takes the
content of another: optimal densification, where each empty bin probes bins in
an order of its own (the same for all texts) until one is filled. After
``PROBES`` probes the rest of the order is that of a hash of (empty bin, bin),
so the first filled bin in it is found directly, however few there are. Of each
bin the ``BITS`` low-order bits are kept, packed into a hex string.

Two texts are as alike as the share m of their equal bins says, corrected for
the bits that agree by chance: ``(m - c) / (1 - c)`` with ``c = 2 ** -BITS``, and at
least 0. Its standard error is about ``sqrt(J (1 - J) / BINS)``, 0.03 at most.

Words are runs without ASCII white space, in lower case. Defined results: fewer
than five words make one shingle of the whole sequence; a text without words
(null and empty too) has the empty fingerprint, alike 1 to another such text and 0
to any other. Equal texts have equal fingerprints.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import successors
from .scratch import written

WORDS = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 8
PROBES = 8
_SHIFT = 62 - BIN_BITS
_random = random.Random(62)
_PROBE = [[_random.randrange(BINS) for _ in range(BINS)] for _ in range(PROBES)]


def _literal(values: list) -> str:
    return f"array({', '.join(repr(v) for v in values)})"


def with_bins(docs: DataFrame, text: str, bins: str) -> DataFrame:
    """``docs`` with ``bins``: the ``BINS`` low-order values of ``text``'s sketch, an empty array if it has no words.

    Each step is a column of its own: a step is used several times by the next,
    which keeps the optimizer from inlining one into the other's lambdas.
    """
    t = {k: f"_{bins}_{k}" for k in ("words", "hashes", "shingles", "sorted", "least", "dense")}
    n = f"size({t['hashes']})"
    window = ", ".join(f"{t['hashes']}[i + {k}]" for k in range(WORDS))
    mask = (1 << 62) - 1
    low = (1 << BITS) - 1
    place = f"cast(shiftright({{}}, {_SHIFT}) as int)"
    docs = docs.withColumn(t["words"], F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[\x20\x09-\x0D]+"), ""))
    docs = docs.withColumn(t["hashes"], F.transform(t["words"], lambda w: F.xxhash64(w)))
    docs = docs.withColumn(
        t["shingles"],
        F.expr(
            f"CASE WHEN {n} >= {WORDS} THEN transform(sequence(0, {n} - {WORDS}), i -> xxhash64({window}) & {mask}L)"
            f" WHEN {n} > 0 THEN array(xxhash64({t['hashes']}, 'short') & {mask}L) ELSE cast(array() as array<bigint>) END"
        ),
    )
    docs = docs.withColumn(t["sorted"], F.sort_array(t["shingles"]))
    s, m, d = t["sorted"], t["least"], t["dense"]
    docs = docs.withColumn(m, F.expr(f"filter({s}, (x, i) -> i = 0 OR {place.format('x')} <> {place.format(f'{s}[i - 1]')})"))
    # the filled bins in place, null where a bin is empty
    gap = f"{place.format('x')} - if(i = 0, 0, {place.format(f'{m}[i - 1]')} + 1)"
    docs = docs.withColumn(
        d,
        F.expr(
            f"concat(flatten(transform({m}, (x, i) -> array_append(array_repeat(cast(null as int), {gap}), cast(x & {low} as int)))),"
            f" array_repeat(cast(null as int), {BINS - 1} - {place.format(f'try_element_at({m}, -1)')}))"
        ),
    )
    probes = ", ".join(f"{d}[{_literal(p)}[i]]" for p in _PROBE)
    # the first filled bin in the order of a hash: its value rides in the low bits
    rest = f"cast(array_min(transform({m}, y -> (xxhash64({place.format('y')}, i) & {mask & ~low}L) | (y & {low}))) & {low} as int)"
    docs = docs.withColumn(
        bins, F.expr(f"CASE WHEN size({m}) > 0 THEN transform({d}, (x, i) -> coalesce(x, {probes}, {rest})) ELSE cast(array() as array<int>) END")
    )
    return docs.drop(*t.values())


def packed(bins: Column) -> Column:
    """The fingerprint: two hex digits a bin."""
    digits = F.array(*[F.lit(f"{v:02x}") for v in range(1 << BITS)])
    return F.array_join(F.transform(bins, lambda v: F.get(digits, v)), "")


def unpacked(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(".."), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts from their bins, or from their unpacked fingerprints."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda s, x: s + x)
    chance = 2.0**-BITS
    corrected = F.greatest(F.lit(0.0), (equal / F.lit(float(BINS)) - chance) / (1 - chance))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")).otherwise(corrected)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (text) with fingerprint."""
    return with_bins(docs, "text", "fingerprint").withColumn("fingerprint", packed(F.col("fingerprint")))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text) and of edited texts, and their likeness.

    The edit replaces the last third of a text (its code points, rounded down) by
    as many code points, or all, from the start of the next text in descending
    order of doc_id; the first follows the last. Rows are told apart by doc_id
    and text: rows that repeat both have the same next row.
    """
    texts = docs.select(F.xxhash64("doc_id", "text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars")).distinct()
    order = [F.col("doc_id").desc_nulls_last(), F.col("key").asc()]
    chain = written(successors(ids, order, ["key"], wrap=True), "chain")

    # the next text gives the tail of the edit to the row before it
    following = texts.select(F.col("key").alias("next_key"), F.col("text").alias("next_text"))
    given = chain.join(following, "next_key").select("key", "doc_id", "n_chars", F.expr("left(next_text, cast(n_chars div 3 as int))").alias("tail"))
    given = given.dropDuplicates(["key"])  # the next row may be there several times
    edited = texts.join(given, "key").withColumn("edited", F.expr("concat(left(text, cast(n_chars - n_chars div 3 as int)), tail)"))
    binned = with_bins(with_bins(edited, "text", "own_bins"), "edited", "edited_bins")
    prints = written(
        binned.select(
            "key",
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            F.unhex(packed(F.col("own_bins"))).alias("own"),
            F.unhex(packed(F.col("edited_bins"))).alias("edited"),
            likeness(F.col("own_bins"), F.col("edited_bins")).alias("near_edited"),
        ),
        "prints",
    )
    # the next text's fingerprint is known by now: only fingerprints move
    after = prints.select(F.col("key").alias("next_key"), F.lower(F.hex("own")).alias("next_print")).dropDuplicates(["next_key"])
    out = prints.join(chain.select("key", "next_key"), "key").join(after, "next_key").withColumn("fingerprint", F.lower(F.hex("own")))
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        F.lower(F.hex("edited")).alias("edited_fingerprint"),
        "near_edited",
        likeness(unpacked(F.col("fingerprint")), unpacked(F.col("next_print"))).alias("near_next"),
    )
