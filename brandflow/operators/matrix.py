"""Brand-to-brand gains and losses, summed over households.

For a household and an ordered pair of its buckets (B1, B2), diagonal included,

    gain(B1, B2) = q1[B2] * f[B1],    f = IFNULL(SAFE_DIVIDE(q2, cseg), 0)
    loss(B1, B2) = gain(B2, B1)

with ``q1 = cseg_p1`` and ``q2 = cseg_p2`` from C8/C9; both are summed over
households.

A household's buckets are gathered into one sorted array (one row per bucket at
most, whatever it bought). Two explodes walk the unordered pairs of that array
straight into the map-side partial aggregate, grouped by the pair of buckets,
which sums the gains of both directions: the other direction's gain is this
one's loss. No pair row is stored or shuffled; at most one row per task and
pair of buckets that occurs crosses the shuffle. The cost is the number of pairs
households really hold, ``sum of k (k + 1) / 2`` for households of k buckets, and
at worst that with k = the number of buckets; it does not depend on how many
buckets the map has.

A household of very many buckets would be the work of one task. Where the map has
more buckets than one block holds, every household's sorted list is cut into blocks,
and a block meets itself where it lies; the pairs of different blocks of a household,
a triangle of them, are dealt out as units of work of their own, each at most a
block times a block.

Terms are NULL where ``q1`` is NULL (``f`` never is), and a cell is NULL only
when all its terms are, as with ``SUM``. A cell exists when some household holds
both buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import Sum, plain_sum, ratio_or_zero
from ..sources.stores import shuffle_partitions

#: Buckets of a household in one block; a unit of work is at most 1024 x 1024 pairs.
BLOCK = 1024


def _within(blocks: DataFrame) -> DataFrame:
    """Unordered pairs (x, y) of the rows in each block, a row with itself included."""
    first = blocks.select("held", F.posexplode("held").alias("i", "x"))
    return first.select("x", F.explode(F.expr("slice(held, i + 1, size(held) - i)")).alias("y"))


def _blocks(allocated: DataFrame, row: F.Column, block: int) -> DataFrame:
    """``hhkey, g, n, held``: the g-th of a household's n blocks. One sort by household serves it; no shuffle beyond that by household."""
    household = Window.partitionBy("hhkey")
    ranked = allocated.select("hhkey", row.alias("row")).select(
        "hhkey",
        "row",
        F.floor((F.row_number().over(household.orderBy("row")) - 1) / F.lit(block)).cast("int").alias("g"),
        F.ceil(F.count(F.lit(1)).over(household) / F.lit(block)).cast("int").alias("n"),
    )
    return ranked.groupBy("hhkey", "g").agg(F.max("n").alias("n"), F.sort_array(F.collect_list("row")).alias("held"))


def _across(blocks: DataFrame) -> DataFrame:
    """Pairs (x, y) of rows in different blocks of a household, x in the earlier one.

    The units (household, i, j), i < j, are dealt by hash over all shuffle partitions. Their
    number is stated, so that adaptive execution does not merge partitions that are
    small in bytes but not in work.
    """
    n = shuffle_partitions(blocks.sparkSession)
    # a null household is one too, and a join finds no partner for null
    household = F.struct(F.coalesce("hhkey", F.lit(0)).alias("key"), F.col("hhkey").isNull().alias("none")).alias("household")
    several = blocks.where("n > 1")
    left = several.where("g < n - 1").select(household, F.col("g").alias("i"), F.explode(F.expr("sequence(g + 1, n - 1)")).alias("j"), F.col("held").alias("xs"))
    right = several.where("g > 0").select(household, F.explode(F.expr("sequence(0, g - 1)")).alias("i"), F.col("g").alias("j"), F.col("held").alias("ys"))
    left, right = (side.repartition(n, "household", "i", "j") for side in (left, right))
    # merge: a side that is small in bytes must not be broadcast, which would undo the dealing
    units = left.hint("merge").join(right, ["household", "i", "j"])
    return units.select(F.explode("xs").alias("x"), "ys").select("x", F.explode("ys").alias("y"))


def flow_sums(allocated: DataFrame, *, max_buckets: int | None = None, block: int = BLOCK, total: Sum = plain_sum) -> DataFrame:
    """Unrounded ``B1, B2, gains, losses, n_households`` for every existing cell.

    ``max_buckets`` bounds the buckets of a household; unless it exceeds ``block``, one
    task walks the pairs of a household. Where no bound is given the households must be
    known to be small. Rows without a household, if any, count as one household.
    """
    row = F.struct(F.col("brand").alias("b"), F.col("cseg_p1").alias("q1"), ratio_or_zero("cseg_p2", "cseg").alias("f"))
    if max_buckets is None or max_buckets <= block:
        pairs = _within(allocated.groupBy("hhkey").agg(F.sort_array(F.collect_list(row)).alias("held")))
    else:
        blocks = _blocks(allocated, row, block)
        pairs = _within(blocks).unionByName(_across(blocks))
    terms = pairs.select(
        F.col("x.b").alias("low"), F.col("y.b").alias("high"), (F.col("y.q1") * F.col("x.f")).alias("up"), (F.col("x.q1") * F.col("y.f")).alias("down")
    )
    sums = terms.groupBy("low", "high").agg(total("up").alias("up"), total("down").alias("down"), F.count(F.lit(1)).alias("n_households"))
    # one row for each direction; the diagonal has one
    cells = F.expr(
        "inline(CASE WHEN low = high THEN array(struct(low AS B1, high AS B2, up AS gains, down AS losses))"
        " ELSE array(struct(low AS B1, high AS B2, up AS gains, down AS losses),"
        " struct(high AS B1, low AS B2, down AS gains, up AS losses)) END)"
    )
    return sums.select(cells, "n_households")


def gain_loss_matrix(
    allocated: DataFrame,
    *,
    digits: int = 2,
    ordered: bool = True,
    max_buckets: int | None = None,
    block: int = BLOCK,
    total: Sum = plain_sum,
) -> DataFrame:
    """``B1, B2, total_gains_b1_to_b2, total_losses_b1_to_b2``, rounded, ordered."""
    out = flow_sums(allocated, max_buckets=max_buckets, block=block, total=total).select(
        "B1",
        "B2",
        F.round("gains", digits).alias("total_gains_b1_to_b2"),
        F.round("losses", digits).alias("total_losses_b1_to_b2"),
    )
    return out.orderBy("B1", "B2") if ordered else out
