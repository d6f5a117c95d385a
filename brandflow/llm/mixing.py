"""Mixing sources to target token counts by entropy balancing.

Every document gets a rate, the expected number of its copies, between 0 and
``MOST`` copies. Among all rates that give each source exactly its target of
tokens, entropy balancing takes those closest to 1 in bounded relative entropy.
The solution is an exponential tilt: the odds of a rate grow as ``exp(l * x)``,
where x is the document's size in units of its source's mean and l the source's
multiplier, so ``rate = MOST / (1 + (MOST - 1) * exp(-l * x))``; l = 0 gives 1. The
multipliers maximise the concave dual ``sum_s (l_s * target_s - sum_d softplus)``,
which is separate in the sources; Newton steps, kept inside a bracket, find all
of them at once. Documents of one source and size have one rate, so each step is one
aggregation over the counts of (source, size), of which a source with N tokens has
fewer than the root of 2 N. Steps end when every source meets its target; if some do
not after ``steps``, that is an error.

Rates are then rounded to whole copies with a dither from a hash of the row. A
common shift of a source's dithers brings its total up to its target: the shifts at
which documents gain a copy are whole numbers, and the largest one that stays within
the target is read off running sums over bins, then over the bins of one bin, down to
single values. What is missing still, less than a document, is filled with one more copy
of documents that fit. Everything derives from hashes and exact sums: reruns agree.

What belongs to sources (weights, targets, multipliers, shifts) is kept in tables with
one row a source; the driver gets single numbers only. Documents look their source up
by ``lookup_join``: a broadcast while the table is proven small, else a shuffle join with
the large sources told apart.

Defined results: null or empty texts have size 0; they take no part in the
balance and one copy of them is kept. A null source is a source of its own. A
source without tokens has target 0. Rows that repeat a doc_id and its text are
rounded alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lookup import lookup_join
from .ordering import numbered
from .scratch import written
from .textbytes import blocks, utf8, word_starts

#: Most copies of a document.
MOST = 2
#: Positions of a dither, and of the bins that one round of sums over positions tells apart, in bits.
DITHER_BITS, BIN_BITS = 40, 14
TOP_UPS = 2
#: Sums of real numbers are taken on this grid as whole numbers: their order can't change them.
GRID = 1 << 20
WEIGHTS = (5, 2, 1)
SHARE = 1.5


def _sizes(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("text"))
            sizes = np.zeros(len(off) - 1, np.int64)
            for i, j in blocks(off):
                sizes[i:j] = np.diff(word_starts(data[off[i] : off[j]], off[i : j + 1] - off[i])[1])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(sizes)], names=[*names, "size"])

    return run


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """key, source, source_size, n, target of each source of ``sized`` (key, source, size).

    Sources in code point order, null last, take the weights in turn and share
    ``share`` of all tokens by them. None may pass ``most`` times its size; what is
    above is shared again by weight among the others, until none is above.
    """
    found = sized.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("n"))
    ranked = numbered(found, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    sources = written(ranked.withColumn("weight", weight).drop("place"), "sources")
    unit, before = 0.0, None
    while True:  # the tokens a unit of weight gets only grow, and with them the set of sources that are full
        full = most * F.col("source_size") <= unit * F.col("weight")
        got = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, most * F.col("source_size")).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)).alias("open"),
        ).first()
        if not got["open"] or (got["full"], got["open"]) == before:
            break
        unit, before = (share * got["all"] - got["full"]) / got["open"], (got["full"], got["open"])
    # where all are full the unit stays that of the last that was not
    return sources.withColumn("target", F.least(F.lit(float(most)) * F.col("source_size"), F.lit(float(unit)) * F.col("weight")))


def _exact_sum(value: Column) -> Column:
    return F.sum(F.round(value * float(GRID)).cast("decimal(38,0)"))


def _rate(multiplier: Column, x: Column) -> Column:
    return F.lit(float(MOST)) / (F.lit(1.0) + F.lit(float(MOST - 1)) * F.exp(-multiplier * x))


def multipliers(counts: DataFrame, sources: DataFrame, n_sources: int, tolerance: float, steps: int) -> DataFrame:
    """key, multiplier of the sources whose target lies between nothing and MOST times their size.

    ``counts``: key, size (above 0), docs. Newton steps within a bracket; long leaps wait for one.
    """
    none = F.lit(None).cast("double")
    inside = sources.where((F.col("target") > 0) & (F.col("target") < MOST * F.col("source_size")))
    mean = F.col("source_size") / F.col("n")
    state = written(inside.select("key", "target", mean.alias("mean"), F.lit(0.0).alias("multiplier"), none.alias("low"), none.alias("high")), "multipliers")
    m, gap, low, high, newton = (F.col(c) for c in ("multiplier", "gap", "low", "high", "newton"))
    for _ in range(steps):
        x = F.col("size") / F.col("mean")
        tokens = F.col("docs") * F.col("size") * _rate(m, x)
        sums = (
            lookup_join(counts, state.select("key", "mean", "multiplier"), "key", n_rows=n_sources)
            .groupBy("key")
            .agg(_exact_sum(tokens).alias("tokens"), _exact_sum(tokens * x * (1 - _rate(m, x) / MOST)).alias("slope"), F.count(F.lit(1)).alias("terms"))
        )
        near = state.join(sums, "key").withColumn("gap", F.col("tokens").cast("double") / GRID - F.col("target")).withColumn("slope", F.col("slope").cast("double") / GRID)
        near = near.withColumn("newton", F.when(F.col("slope") > 0, m - gap / F.col("slope")))
        near = near.withColumn("low", F.when(gap > 0, low).otherwise(m)).withColumn("high", F.when(gap > 0, m).otherwise(high))
        middle = (low + high) / 2
        leap = F.coalesce(F.abs(newton - m) > 1 + F.abs(m), F.lit(True))
        step = F.when(middle.isNotNull(), F.when((newton > low) & (newton < high), newton).otherwise(middle)).when(leap, m - F.signum(gap) * (1 + F.abs(m))).otherwise(newton)
        # met: up to the tolerance and the grid of the sums, or between two neighbouring numbers
        met = (F.abs(gap) <= tolerance * F.col("target") + F.col("terms") / GRID) | F.coalesce((middle <= low) | (middle >= high), F.lit(False))
        state = written(near.select("key", "target", "mean", F.when(met, m).otherwise(step).alias("multiplier"), "low", "high", met.alias("met")), "multipliers")
        if not state.where(~F.col("met")).limit(1).count():
            return state.select("key", "multiplier")
        state = state.drop("met")
    raise RuntimeError(f"multipliers of some sources did not converge in {steps} steps")


def _keyed(rows: DataFrame) -> DataFrame:
    """With ``key``, the source as text that is never null."""
    return rows.withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")))


def balanced(docs: DataFrame, tolerance: float = 1e-9, steps: int = 200) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, rate, copies, taken of every row of ``docs`` (doc_id, text, source)."""
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), "text")
    names = ["doc_id", "source", "text_hash"]
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("size", T.LongType())])
    sized = written(_keyed(rows.mapInArrow(_sizes(names), schema)), "sizes")
    sources = written(source_targets(sized), "targets")
    n_sources = sources.count()

    counts = written(sized.where("size > 0").groupBy("key", "size").agg(F.count(F.lit(1)).alias("docs")), "size-counts")
    tilts = multipliers(counts, sources, n_sources, tolerance, steps)
    known = written(sources.join(tilts, "key", "left").select("key", "source_size", "n", "target", "multiplier"), "targets")
    x = F.col("size") * F.col("n") / F.col("source_size")
    rate = (
        F.when(F.col("size") == 0, 1.0)
        .when(F.col("target") >= MOST * F.col("source_size"), float(MOST))
        .otherwise(F.coalesce(_rate(F.col("multiplier"), x), F.lit(0.0)))
    )
    rated = lookup_join(sized, known, "key", n_rows=n_sources).withColumn("rate", rate)
    open_to = (F.col("size") > 0) & (F.col("rate") > 0) & (F.col("rate") < MOST)
    rated = written(rated.select("doc_id", "text_hash", "source", "key", "size", "source_size", "target", "rate", open_to.alias("open")), "rates")

    # a document whose rate and dither add up to v gains its copy number j at the shift j - v, counted from -MOST in steps of the dither
    one = 1 << DITHER_BITS
    v = F.floor(F.col("rate") * float(one)) + _dither("copies")
    shifts = F.transform(F.sequence(F.lit(1), F.lit(MOST)), lambda j: F.greatest(F.lit(0), (j + MOST).cast("long") * F.lit(one) - v))
    rated = rated.withColumn("shifts", F.when(F.col("open"), shifts))
    gains = rated.where("open").select("key", F.explode("shifts").alias("at"), F.col("size").alias("tokens"))
    goals = known.where(F.col("multiplier").isNotNull()).select("key", F.col("target").alias("goal"))
    bounds = _bounds(gains, goals, n_sources, 2 * MOST * one)
    copies = F.when(F.col("open"), F.size(F.filter("shifts", lambda t: t < F.col("bound")))).otherwise(F.round("rate")).cast("long")
    rated = written(_with_bounds(rated, known, bounds, n_sources).select(*[c for c in rated.columns if c != "shifts"], copies.alias("copies")), "rates")
    # what is then missing is less than the next document; one more copy of some that fit comes nearer
    for turn in range(TOP_UPS):
        totals = rated.where("open").groupBy("key").agg(F.sum(F.col("copies") * F.col("size")).alias("tokens"))
        missing = written(goals.join(totals, "key").select("key", (F.col("goal") - F.col("tokens")).alias("goal")), "missing")
        fits = F.col("open") & (F.col("copies") < MOST) & (F.col("size") <= F.col("goal"))
        able = lookup_join(rated.where(F.col("open") & (F.col("copies") < MOST)), missing, "key", n_rows=n_sources).where(fits)
        again = _dither(f"top-up {turn}")
        bounds = _bounds(able.select("key", again.alias("at"), F.col("size").alias("tokens")), missing, n_sources, one).join(missing, "key")
        more = F.coalesce(fits & (again < F.col("bound")), F.lit(False)).cast("long")
        rated = written(_with_bounds(rated, known, bounds, n_sources).select(*[c for c in rated.columns if c != "copies"], (F.col("copies") + more).alias("copies")), "rates")
    return rated.withColumn("taken", F.col("copies") * F.col("size")).select("doc_id", "text_hash", "source", "size", "source_size", "target", "rate", "copies", "taken")


def _dither(name: str) -> Column:
    """A whole number below ``2 ** DITHER_BITS`` for each row, from its doc_id and text."""
    return F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(name)), F.lit(1 << DITHER_BITS))


def _with_bounds(rows: DataFrame, known: DataFrame, bounds: DataFrame, n_sources: int) -> DataFrame:
    return lookup_join(rows, known.select("key").join(bounds, "key", "left"), "key", n_rows=n_sources)


def _bounds(gains: DataFrame, goals: DataFrame, n_sources: int, end: int) -> DataFrame:
    """key, bound: the highest bound for which the tokens of ``gains`` (key, at, tokens) with ``at < bound`` are within the source's goal.

    Positions lie from 0 to ``end``. Each round sums the tokens of one bin's bins, at most
    ``2 ** BIN_BITS`` rows a source, and goes on in the first that takes the sum above the goal.
    """
    levels = range((max(end - 1, 1).bit_length() - 1) // BIN_BITS * BIN_BITS, -1, -BIN_BITS)
    at, bound = F.col("at"), F.col("bound")
    state = goals.select("key", "goal", F.lit(0).cast("long").alias("base"), F.lit(0).cast("long").alias("bound"))
    for level in levels:
        met = lookup_join(gains, state, "key", n_rows=n_sources).where(F.shiftright(at, level + BIN_BITS) == F.shiftright(bound, level + BIN_BITS))
        bins = met.groupBy("key", F.shiftright(at, level).alias("bin")).agg(F.sum("tokens").alias("tokens"))
        running = F.sum("tokens").over(Window.partitionBy("key").orderBy("bin"))
        above = bins.withColumn("upto", running).join(state, "key").where(F.col("base") + F.col("upto") > F.col("goal"))
        first = above.groupBy("key").agg(F.min(F.struct("bin", (F.col("base") + F.col("upto") - F.col("tokens")).alias("base"))).alias("first"))
        # without a bin above the goal, which only the first round can find, all positions are within it
        state = state.join(first, "key", "left").select(
            "key", "goal", F.coalesce("first.base", "base").alias("base"), F.coalesce(F.shiftleft("first.bin", level), F.when(bound > 0, bound).otherwise(F.lit(end))).alias("bound")
        )
        state = written(state, "bounds")
    return state.select("key", "bound")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with copy (from 1) and target_tokens of its source."""
    taken = balanced(docs).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("source").alias("_source"), "copies", F.col("target").alias("_target")).distinct()
    d = docs.alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("d.text") == F.col("_hash")) & F.col("d.source").eqNullSafe(F.col("_source"))
    names = [c for c in docs.columns if c not in ("copy", "target_tokens")]
    return (
        d.join(taken, same)
        .where("copies > 0")
        .select(*[F.col(f"d.`{c}`") for c in names], F.col("_target").alias("target_tokens"), F.explode(F.expr("sequence(1, cast(copies as int))")).alias("copy"))
    )
