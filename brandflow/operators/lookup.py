"""Joins with a lookup table that may be too large to broadcast, on a key that may be hot.

A table with a proven small row count is broadcast. A larger one is joined by a
shuffle on the key, and there a key that holds a large share of the rows would pile
them up in one task. So one pass over the rows finds such keys with a frequency
sketch (mergeable, of fixed size, part of the ordinary partial aggregates). Their
rows, and rows without a key, never enter the shuffle: they meet a broadcast of the
table's rows of just these keys, which is bounded by the number of keys the sketch
may name and by the rows a key may have there. Nothing depends on the sketch's
estimates but where a row is joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stores import shuffle_partitions

#: Largest lookup table that is broadcast whole.
MAX_BROADCAST_ROWS = 1_000_000
#: Keys that are told from the rest at most, entries of the sketch, and table rows that such a key may have.
HEAVY_KEYS, TRACKED, REPEATS = 4096, 65_536, 100


def heavy_keys(rows: DataFrame, key: str, *, share: float | None = None) -> list:
    """Keys with more than ``share`` of the rows (default: half a shuffle partition's), in one pass; at most ``HEAVY_KEYS``.

    The sketch misses no key with more than 1 / 10 000 of the rows. NULL is not among them.
    """
    share = 0.5 / shuffle_partitions(rows.sparkSession) if share is None else share
    top = F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, {TRACKED})")
    found = rows.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["n"]]


def joined_apart(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    join: Callable[[DataFrame, DataFrame], DataFrame],
    *,
    share: float | None = None,
) -> DataFrame:
    """``join(rows, table)`` on ``key``, with the rows of heavy keys, and those without a key, joined by broadcast.

    ``join`` is called once for each part and must treat rows by themselves, as an inner
    or left join does. A key with more than ``REPEATS`` rows in the table stays in the shuffle.
    """
    spark = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    keys = heavy_keys(rows, key, share=share)
    named = spark.createDataFrame([(k,) for k in keys], f"`{key}` {kind}")
    # a heavy key without a row in the table is told apart as well: it finds nothing wherever it is joined
    many = table.join(F.broadcast(named), key, "left_semi").groupBy(key).count().where(F.col("count") > REPEATS)
    repeated = {r[0] for r in many.select(key).collect()}  # at most HEAVY_KEYS
    heavy = spark.createDataFrame([(k,) for k in keys if k not in repeated], f"`{key}` {kind}")
    small = table.join(F.broadcast(heavy), key, "left_semi")  # at most HEAVY_KEYS * REPEATS rows
    hot = rows.join(F.broadcast(heavy), key, "left_semi").unionByName(rows.where(F.col(key).isNull()))
    rest = rows.where(F.col(key).isNotNull()).join(F.broadcast(heavy), key, "left_anti")
    return join(hot, F.broadcast(small)).unionByName(join(rest, table))


def lookup_join(
    rows: DataFrame, table: DataFrame, key: str, *, n_rows: int | None = None, max_rows: int = MAX_BROADCAST_ROWS, share: float | None = None
) -> DataFrame:
    """Inner join of ``rows`` with ``table`` on ``key``: a broadcast if at most ``max_rows`` rows are proven, else ``joined_apart``.

    ``n_rows`` is a bound that the caller has proven; without one the table is counted.
    """
    if n_rows is None or n_rows > max_rows:
        n_rows = table.limit(max_rows + 1).count()
    if n_rows <= max_rows:
        return rows.join(F.broadcast(table), key)
    return joined_apart(rows, table, key, lambda part, t: part.join(t, key), share=share)
