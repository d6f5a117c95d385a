"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds its distinct word shingles. Its sketch has ``BINS``
coordinates and is filled in rounds: in round r every element is hashed to a
bin and a value, and a bin keeps its smallest (round, value); after ``BINS``
rounds, round ``BINS + b`` puts every element into bin b. Rounds end when no bin
is empty, so every coordinate of every sketch is filled, a large set needs one
round, and the share of equal coordinates of two sketches concentrates around
the Jaccard similarity as tightly as with independent coordinates.

1. One pass over the texts writes, per row: set size, set fingerprint, band keys.
   Rows with equal sets are one class from here on.
2. Classes that share a band key are candidates. Every class is compared with
   one class of each of its buckets, the center; verified links join classes
   into components. Classes that share a center but lie in different components
   may still be linked: those pairs are found through the elements in which they
   differ from the center (see ``_across``). So no candidate link is lost, and the
   members of a large group are not paired with one another.
3. A candidate is verified by the exact intersection of the two full sets.

With 5 coordinates a band and 32 bands, a pair at similarity 0.8 exactly is
missed with probability 3e-6, one at 0.9 with less than 1e-12.

Defined results: null or empty text, or one without words, has an empty set and
is linked with nothing; fewer words than a shingle make one shingle of the
whole sequence. Rows that repeat a doc_id are judged by their own text; with
texts that aren't linked they are in components of their own, which may have the
same component_id. A null doc_id takes no part in choosing the smallest; a
component without any other has component_id null, and all its rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import component_labels
from .scratch import written
from .textbytes import blocks, mixed, utf8, word_hashes

BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
_SEED = mixed(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: Number of hashes after which all bins of a sketch are usually full.
_USUAL = int(BINS * np.log(BINS) * 1.3)


def shingle_sets(text: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each value the sorted distinct 64-bit hashes of its shingles of ``words`` words."""
    data, off = utf8(text)
    for i, j in blocks(off):
        h, of = word_hashes(data[off[i] : off[j]], off[i : j + 1] - off[i])
        n = np.diff(of)
        whole = np.zeros(len(h) + 1, np.uint64)
        if len(h):
            m = len(h)
            s = h.copy()
            for k in range(1, words):  # s[x] covers words x..x+k where they exist
                s[: m - k] = mixed(s[: m - k] * _MIX + h[k:]) if m > k else s[: m - k]
            whole[:-1] = s
        for d in range(j - i):
            a, b = of[d], of[d + 1]
            if n[d] >= words:
                yield np.unique(whole[a : b - words + 1])
            elif n[d]:
                x = h[a : a + 1]
                for w in h[a + 1 : b]:
                    x = mixed(x * _MIX + w)
                yield mixed(x + np.uint64(n[d]))  # a whole short sequence is no shingle of a longer text
            else:
                yield np.zeros(0, np.uint64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """The ``BINS`` coordinates of a non-empty set: (round, value) as one number."""
    best = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    done, n = 0, len(elements)
    while done < BINS:
        rounds = min(BINS - done, max(1, -(-_USUAL // n)))
        h = mixed(elements[None, :] ^ _SEED[done : done + rounds, None])
        where = ((h >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        value = (h & np.uint64(0xFFFFFFFF)) | (np.arange(done, done + rounds, dtype=np.uint64) << np.uint64(32))[:, None]
        order = np.sort((where << np.uint64(48) | value).ravel())
        at = order >> np.uint64(48)
        first = np.flatnonzero(np.diff(at, prepend=np.uint64(BINS)))
        bins = at[first].astype(np.int64)
        best[bins] = np.minimum(best[bins], order[first] & np.uint64(0xFFFFFFFFFFFF))
        done += rounds
        if best.max() != np.iinfo(np.uint64).max:
            return best
    for b in np.flatnonzero(best == np.iinfo(np.uint64).max):
        best[b] = (mixed(elements ^ _SEED[BINS + b]) & np.uint64(0xFFFFFFFF)).min() | np.uint64((BINS + int(b)) << 32)
    return best


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key * _MIX + rows[:, k])
    return key.view(np.int64)


def _sketched(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, low, high, keys = [], [], [], []
            for s in shingle_sets(batch.column("text"), words):
                sizes.append(len(s))
                if not len(s):
                    low.append(0), high.append(0), keys.append(None)
                    continue
                # two sums over the elements, each mixed anew: equal sets, equal fingerprints
                low.append(int(mixed(s).sum().view(np.int64)))
                high.append(int(mixed(s ^ _SEED[0]).sum().view(np.int64)))
                keys.append(band_keys(sketch(s)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "fp_low", "fp_high", "bands"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"), words)]
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(sets, pa.list_(pa.int64()))], names=["class", "elements"])

    return run


def judged_rows(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, label, component_id: one row for each row of ``docs`` (doc_id, text).

    ``label`` is one for each component (null without words); components of rows that
    repeat a doc_id may share their component_id.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("text_hash", F.xxhash64("text"))
    schema = "doc_id long, text_hash long, n_shingles long, fp_low long, fp_high long, bands array<long>"
    rows = written(texts.mapInArrow(_sketched(words), schema), "sketches")
    # one class for each distinct set, found again by its first row
    classes = written(
        rows.where("n_shingles > 0")
        .groupBy("fp_low", "fp_high", "n_shingles")
        .agg(F.min("doc_id").alias("smallest"), F.min(F.struct("doc_id", "text_hash")).alias("row"), F.min("bands").alias("bands"))
        .withColumn("class", F.col("fp_low")),
        "classes",
    )
    member = written(classes.select("class", F.col("n_shingles").alias("size"), F.explode("bands").alias("key")), "buckets")
    shared = member.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = written(member.join(shared, "key"), "shared")

    # every class against the center of its buckets: the class that meets most others
    met = joined.groupBy("class").agg(F.sum("n").alias("met"))
    center = joined.join(met, "class").groupBy("key").agg(F.max(F.struct("met", "class", "size")).alias("center"))
    stars = joined.join(center, "key").where(F.col("class") != F.col("center.class"))
    stars = stars.select(F.col("center.class").alias("a"), F.col("class").alias("b"), F.col("center.size").alias("a_size"), F.col("size").alias("b_size"))
    stars = written(stars.distinct(), "stars")
    wanted = stars.select(F.col("a").alias("class")).union(stars.select("b")).distinct().join(classes.select("class", "row"), "class")
    there = texts["doc_id"].eqNullSafe(wanted["row.doc_id"]) & (texts["text_hash"] == wanted["row.text_hash"])
    own = texts.join(wanted, there).select("class", "text").dropDuplicates(["class"])  # a row may be there several times
    sets = written(own.mapInArrow(_sets(words), "class long, elements array<long>"), "sets")
    links = _similar(stars.where(_sizes_fit("a_size", "b_size", percent)).select("a", "b"), sets, percent)
    labels = component_labels(links)

    # links between classes of a bucket that are still apart
    more = _similar(written(_across(stars, labels, sets, percent), "candidates"), sets, percent)
    links = links.unionByName(more)
    labels = component_labels(links)

    found = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = found.groupBy("label").agg(F.min("smallest").alias("component_id"))
    named = found.join(least, "label").select("fp_low", "fp_high", "n_shingles", "label", "component_id")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.drop("bands").join(named, ["fp_low", "fp_high", "n_shingles"], "left").select("doc_id", "text_hash", "n_shingles", "label", component.alias("component_id"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs`` (doc_id, text).

    Documents whose shingle sets have ``100 * intersection >= percent * union`` are linked.
    """
    kept = F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return judged_rows(docs, words, percent).select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, unchanged, with one row of each component; rows without words all stay.

    Of rows that share the smallest doc_id of a component, the one whose text
    has the smallest hash stays, once. A component without any doc_id stays whole.
    """
    rows = judged_rows(docs, words, percent)
    alone = (F.col("n_shingles") == 0) | F.col("component_id").isNull()
    free = rows.where(alone).select("doc_id", "text_hash").distinct().withColumn("times", F.lit(1))
    first = (
        rows.where(~alone & (F.col("doc_id") == F.col("component_id")))
        .groupBy("label")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("least"), F.count(F.lit(1)).alias("times"))
        .select("least.doc_id", "least.text_hash", "times")
    )
    stay = written(free.unionByName(first.select("doc_id", "text_hash", F.col("times").cast("int"))), "kept")
    d, s = docs.alias("d"), stay.alias("s")
    same = F.col("d.doc_id").cast("long").eqNullSafe(F.col("s.doc_id")) & (F.xxhash64("d.text") == F.col("s.text_hash"))
    once = d.join(s.where("times = 1"), same, "left_semi")
    repeated = d.join(s.where("times > 1"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated)


def _sizes_fit(x: str, y: str, percent: int):
    """The similarity is at most the smaller size over the larger."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    both = _with_sets(pairs, sets).withColumn("common", F.size(F.array_intersect("left", "right")))
    similar = 100 * F.col("common") >= percent * (F.size("left") + F.size("right") - F.col("common"))
    return written(both.where(similar).select("a", "b"), "links")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.select(F.col("class").alias("a"), F.col("elements").alias("left"))
    b = sets.select(F.col("class").alias("b"), F.col("elements").alias("right"))
    return pairs.join(a, "a").join(b, "b")


def _across(stars: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that may be linked, among the classes that share a center c.

    Let x be the smaller set of a pair and y the larger (of equal sizes, by class). Two
    filters find the pairs; each pair is covered by one of them, as x decides:

    *x has enough elements outside c.* Order the elements of all sets of the center: those
    outside c first, rare ones before frequent ones, then those of c. A linked pair shares
    at least ``p / (100 + p) (|x| + |y|)`` elements, with p percent, so one of x's first
    ``|x| - 2 p |x| / (100 + p) + 1`` and of y's first ``|y| - p |y| / 100 + 1`` elements. If that
    many of x lie outside c, the shared one does too, and nothing of c is compared: pages
    of one template that are too different to be linked meet nobody, since what is
    their own is at least as much as x's part of the order.

    *x is nearly within c.* Let D(x) be the elements in which x and c differ. With
    ``r = (100 - p) / (100 + p)``, x and y are linked if and only if they differ in at most
    ``r (|x| + |y|)`` elements, and they differ in ``|D(x)| + |D(y)| - 2 s``, where s is the number of
    elements that D(x) and D(y) share. So a link needs

        s >= (|D(x)| + |D(y)| - r (|x| + |y|)) / 2.

    Of two classes in different components at least one, z, is not linked with c:
    ``|D(z)| > r (|z| + |c|)``. That bounds s from below for either class alone (see
    ``least``), by 1 at the least. Then both must share one of their first
    ``|D| - s + 1`` elements in any common order; rare ones come first, so the
    random edits of near copies meet nobody, however large their group is.
    """
    part = labels.select(F.col("node"), F.col("label"))
    x = stars.join(part.withColumnRenamed("node", "b"), "b", "left").withColumn("part", F.coalesce("label", "b")).drop("label")
    x = x.join(part.withColumnRenamed("node", "a"), "a", "left").withColumn("center_part", F.coalesce("label", "a")).drop("label")
    x = written(x, "parted")
    apart = x.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.max((F.col("part") != F.col("center_part")).cast("int")).alias("apart")).where("n > 1 and apart = 1")
    x = x.join(apart.select("a"), "a")
    missing, own = F.array_except("left", "right"), F.array_except("right", "left")
    differ = F.concat(
        F.transform(missing, lambda v: F.struct(v.alias("element"), F.lit(False).alias("own"))),
        F.transform(own, lambda v: F.struct(v.alias("element"), F.lit(True).alias("own"))),
    )
    x = _with_sets(x, sets).withColumn("differ", differ).withColumn("d", F.size("differ").cast("long")).withColumn("n_own", F.size(own).cast("long"))
    p, q, r = percent, 100 + percent, 100 - percent
    outside = F.ceil((q * F.col("d") - r * (F.col("a_size") + F.col("b_size"))) / F.lit(2 * q))
    inside = F.floor((q * F.col("d") + r * (F.col("a_size") - F.col("b_size"))) / F.lit(2 * q)) + 1
    least = F.greatest(F.lit(1), F.when(F.col("part") == F.col("center_part"), inside).otherwise(outside))
    as_smaller, as_larger = F.col("b_size") - F.ceil(2 * p * F.col("b_size") / F.lit(q)) + 1, F.col("b_size") - F.ceil(p * F.col("b_size") / F.lit(100)) + 1
    x = x.select("a", "b", "b_size", "part", "d", least.alias("least"), as_smaller.alias("as_smaller"), as_larger.alias("as_larger"), "n_own", F.explode("differ").alias("e"))
    rows = written(x.select("*", "e.element", "e.own").drop("e"), "differences")
    times = rows.groupBy("a", "element").agg(F.count(F.lit(1)).alias("times"), F.min("part").alias("low"), F.max("part").alias("high"))
    order = Window.partitionBy("a", "b").orderBy("times", "element")
    first = rows.join(times, ["a", "element"]).withColumn("place", F.row_number().over(order)).withColumn("own_place", F.sum(F.col("own").cast("int")).over(order))
    first = first.withColumn("apart", F.col("n_own") >= F.col("as_smaller")).withColumn("in_differences", F.col("place") <= F.col("d") - F.col("least") + 1)
    first = first.where((F.col("low") < F.col("high")) & (F.col("in_differences") | (F.col("own") & (F.col("own_place") <= F.col("as_larger")))))
    first = written(first.drop("low", "high", "times", "least"), "first-differences")
    x, y = first.alias("x"), first.alias("y")
    same = (F.col("x.a") == F.col("y.a")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.part") != F.col("y.part"))
    ordered = (F.col("x.b_size") < F.col("y.b_size")) | ((F.col("x.b_size") == F.col("y.b_size")) & (F.col("x.b") < F.col("y.b")))
    fits = same & ordered & (100 * F.col("x.b_size") >= p * F.col("y.b_size"))
    sizes = F.col("x.b_size") + F.col("y.b_size")
    # what is left of either set from the shared element on bounds what they share
    left_over = F.least(F.col("x.b_size") - F.col("x.own_place"), F.col("y.b_size") - F.col("y.own_place")) + 1
    by_order = x.where("x.apart and x.own and x.own_place <= x.as_smaller").join(y.where("y.own and y.own_place <= y.as_larger"), fits & (q * left_over >= p * sizes))
    left_over = F.least(F.col("x.d") - F.col("x.place") + 1, F.col("y.d") - F.col("y.place") + 1)
    enough = 2 * q * left_over >= q * (F.col("x.d") + F.col("y.d")) - r * sizes
    by_difference = x.where("not x.apart and x.in_differences").join(y.where("y.in_differences"), fits & enough)
    pairs = by_order.select("x.b", F.col("y.b").alias("c")).union(by_difference.select("x.b", F.col("y.b").alias("c")))
    pairs = pairs.select(F.least("b", "c").alias("a"), F.greatest("b", "c").alias("b")).distinct()
    done = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.join(done, ["a", "b"], "left_anti")
