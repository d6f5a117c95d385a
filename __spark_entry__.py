"""

Every query derives the household panel from the TPC-H-like tables of the
given scale-factor directory (``brandflow.sources.tpch``) and runs over all
of it. Double outputs of intermediate stages are rounded in both engines,
since sums of doubles in a different order differ in the last bits. A value
whose inputs have a finite decimal grid is rounded to that grid, so that it
can never sit on a rounding tie: unweighted spend (price x (1 - discount)) to
4 places, household-weighted spend (x 0.25 steps) to 6 places; other money to
cents, correction factors to 6 places. The final matrix is rounded to cents
as the analysis defines it.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brandflow.functions import Periods
from brandflow.operators import (
    classify,
    continuous_sample,
    corrected_spend,
    corrected_spend_raw,
    correction_factors,
    cseg_allocation_join,
    cseg_allocation_window,
    household_cseg,
    spend_by_household_brand,
)
from brandflow.plans import VARIANTS, gain_loss, register_gain_loss
from brandflow.sources import (
    merge_rows,
    read_purchase_store,
    read_weighted_store,
    scratch_path,
    tpch,
    update_weights,
    write_purchase_store,
    write_weighted_store,
)
from brandflow.sources.stores import materialize_by_household

FLAGSHIP_SF = "/root/testdata/sf0.001"
MONEY, FACTOR = 2, 6
ICS, CS = 4, 6  # decimal grids of unweighted and household-weighted spend


# --------------------------------------------------------------------------- Spark side


def _rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.select(*[F.round(c, digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def _money(df: DataFrame, *cols: str) -> DataFrame:
    return _rounded(df, {c: MONEY for c in cols})


def _spend(df: DataFrame) -> DataFrame:
    """Round spend columns to the decimal grid their inputs define."""
    grid = {"ics": ICS, "cs": CS, "fs": MONEY}
    return _rounded(df, {c: grid[c.rsplit("_", 1)[1]] for c in df.columns if c.startswith("spent_")})


def _panel(spark: SparkSession, sf_dir: str, string_dates: bool = False):
    return tpch.panel(spark, sf_dir, string_dates=string_dates, spread_scan=True)


_STORES: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Build a store once per session and scale factor, in the checkpoint folder."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _STORES:
        path = scratch_path(spark, f"{kind}-store")
        table = f"brandflow_{kind}_store_{os.path.basename(path).rsplit('-', 1)[1][:12]}"
        if kind == "purchase":
            p, _, _, _ = _panel(spark, sf_dir, string_dates=True)
            _STORES[key] = write_purchase_store(p, path, table=table)
        else:
            _STORES[key] = write_weighted_store(tpch.weighted(spark, sf_dir, spread_scan=True), None, path, table=table)
    return _STORES[key]


def _v1_classified(spark, sf_dir):
    p, _, bm, per = _panel(spark, sf_dir, string_dates=True)
    return classify(p, bm, per, date_filter=False, fold_brandfactor=False)


def _v6_classified(spark, sf_dir):
    p, _, bm, per = _panel(spark, sf_dir)
    return classify(p, bm, per, date_filter=True, fold_brandfactor=True)


def _v6_cs(spark, sf_dir):
    _, hh, _, _ = _panel(spark, sf_dir)
    return continuous_sample(spend_by_household_brand(_v6_classified(spark, sf_dir)), hh)


def _v6_spent(spark, sf_dir):
    cs = _v6_cs(spark, sf_dir)
    return corrected_spend(cs, correction_factors(cs))


def q_brand_map(spark, sf_dir):
    return tpch.brand_map(spark, sf_dir)


def q_classified_purchases_all(spark, sf_dir):
    return _v1_classified(spark, sf_dir)


def q_classified_purchases(spark, sf_dir):
    return _v6_classified(spark, sf_dir)


def q_spend_hh_brand_period(spark, sf_dir):
    return _spend(spend_by_household_brand(_v1_classified(spark, sf_dir), two_level=True))


def q_spend_hh_brand(spark, sf_dir):
    return _spend(spend_by_household_brand(_v6_classified(spark, sf_dir)))


def q_spend_cs(spark, sf_dir):
    cols = ["spent_p1_cs", "spent_p2_cs", "spent_p1_fs", "spent_p2_fs"]
    return _spend(_v6_cs(spark, sf_dir).select("hhkey", "brand", *cols))


def q_correction_factors(spark, sf_dir):
    f = correction_factors(_v6_cs(spark, sf_dir))
    return _rounded(f, {"corr_factor_p1": FACTOR, "corr_factor_p2": FACTOR})


def q_corrected_spend_raw(spark, sf_dir):
    # V3 flavour: date filter, factor applied inside the sum, household weight filter.
    p, hh, bm, per = _panel(spark, sf_dir)
    classified = classify(p, bm, per, date_filter=True, three_way=True, fold_brandfactor=False)
    cs = continuous_sample(spend_by_household_brand(classified, two_level=True), hh)
    spent = corrected_spend_raw(classified, correction_factors(cs), hh, two_level=True)
    return _money(spent, "spent_p1", "spent_p2")


def q_corrected_spend(spark, sf_dir):
    return _money(_v6_spent(spark, sf_dir), "spent_p1", "spent_p2")


def q_household_cseg(spark, sf_dir):
    return _money(household_cseg(_v6_spent(spark, sf_dir)), "total_spent_p1", "total_spent_p2", "cseg")


_ALLOC = ("spent_p1", "spent_p2", "cseg_p1", "cseg_p2", "cseg")


def q_cseg_allocation_join(spark, sf_dir):
    return _money(cseg_allocation_join(_v6_spent(spark, sf_dir)), *_ALLOC)


def q_cseg_allocation_window(spark, sf_dir):
    return _money(cseg_allocation_window(_v6_spent(spark, sf_dir)), *_ALLOC)


def q_gain_loss_matrix(spark, sf_dir):
    # V6 stages straight on the derived purchases (no store).
    p, hh, bm, per = _panel(spark, sf_dir)
    return gain_loss(p, hh, bm, per, variant="v6")


# The same results by the ways that large inputs take: bounds far below the panel's own sizes.


def q_classified_purchases_large_map(spark, sf_dir):
    # a map too large to broadcast; brands with a large share of the rows are told apart by a sketch
    p, _, bm, per = _panel(spark, sf_dir)
    return classify(p, bm, per, max_broadcast_rows=5)


def q_corrected_spend_large_map(spark, sf_dir):
    # factors too many to broadcast, joined without a shuffle of C3
    cs = materialize_by_household(_v6_cs(spark, sf_dir), "c3")
    return _money(corrected_spend(cs, correction_factors(cs), max_broadcast_rows=5), "spent_p1", "spent_p2")


def q_corrected_spend_raw_large_map(spark, sf_dir):
    p, hh, bm, per = _panel(spark, sf_dir)
    classified = classify(p, bm, per, date_filter=True, three_way=True, fold_brandfactor=False)
    cs = continuous_sample(spend_by_household_brand(classified, two_level=True), hh)
    spent = corrected_spend_raw(classified, correction_factors(cs), hh, two_level=True, max_broadcast_rows=5)
    return _money(spent, "spent_p1", "spent_p2")


def q_gain_loss_blocks(spark, sf_dir):
    # every household's pairs dealt out as pairs of blocks of three buckets
    p, hh, bm, per = _panel(spark, sf_dir)
    return gain_loss(p, hh, bm, per, variant="v6", block=3)


def q_gain_loss_exact(spark, sf_dir):
    # sums that are the same for any order and partitioning of the rows
    p, hh, bm, per = _panel(spark, sf_dir)
    return gain_loss(p, hh, bm, per, variant="v6", exact=True)


def q_purchase_store(spark, sf_dir):
    return read_purchase_store(spark, _store(spark, sf_dir, "purchase")).select(
        "hhkey", "occaskey", "brand", "datep", "value", "brandfactor", "rwkorr", "rwstd", "fullmasW"
    )


def q_weighted_store(spark, sf_dir):
    return read_weighted_store(spark, _store(spark, sf_dir, "weighted")).select(
        "hhkey", "brand", "datep", "spent_cs", "spent_fs"
    )


def _new_table(spark: SparkSession, sf_dir: str, kind: str) -> tuple[str, str]:
    path = scratch_path(spark, kind)
    return path, f"brandflow_{kind}_{os.path.basename(path).rsplit('-', 1)[1][:12]}"


def q_purchase_store_merged(spark, sf_dir):
    # a store of the first third of the purchases; the others arrive in two drops that are merged into its months
    p, _, _, _ = _panel(spark, sf_dir, string_dates=False)
    drop = F.pmod(F.xxhash64("hhkey", "occaskey"), F.lit(3))
    path, table = _new_table(spark, sf_dir, "merged")
    write_purchase_store(p.where(drop == 0), path, table=table)
    for k in (1, 2):
        merge_rows(p.where(drop == k), table, f"drop-{k}")
    return read_purchase_store(spark, table).select(
        "hhkey", "occaskey", "brand", "datep", "value", "brandfactor", "rwkorr", "rwstd", "fullmasW"
    )


def q_weighted_store_updated(spark, sf_dir):
    # a store written with other weights, brought up to date month by month
    p, hh, _, _ = _panel(spark, sf_dir, string_dates=False)
    old = hh.withColumn("continuo", F.when(F.col("hhkey") % 4 == 0, F.col("continuo") * 2).otherwise(F.col("continuo")))
    path, table = _new_table(spark, sf_dir, "updated")
    write_weighted_store(p, old, path, table=table)
    update_weights(spark, table, p, old, hh)
    return read_weighted_store(spark, table).select("hhkey", "brand", "datep", "spent_cs", "spent_fs")


def q_gain_loss_sql(spark, sf_dir):
    # the SQL table function with its default dates
    p, hh, bm, per = _panel(spark, sf_dir)
    register_gain_loss(spark, p, hh, bm, name="brandflow_gain_loss", periods=per)
    return spark.sql("SELECT * FROM brandflow_gain_loss() ORDER BY B1, B2")


def _variant_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        v = VARIANTS[name]
        p, hh, bm, per = _panel(spark, sf_dir, string_dates=True)
        if v.source == "purchase_store":
            p = read_purchase_store(spark, _store(spark, sf_dir, "purchase"))
        elif v.source == "weighted_store":
            p, hh = read_weighted_store(spark, _store(spark, sf_dir, "weighted")), None
        return gain_loss(p, hh, bm, per, variant=name)

    run.__name__ = f"q_gain_loss_{name}"
    return run


def _training_data_queries() -> tuple[dict, dict]:
    """Queries and SQL of the optional training-data subpackage and its pipeline; empty if they are not installed."""
    try:
        import corpus_pipeline
        from brandflow.llm.queries import ORACLE_SQL, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "brandflow.llm"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLE_SQL, **sql}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the gain/loss matrix (V6 stages) on the sf0.001 tables."""
    return q_gain_loss_matrix(spark, FLAGSHIP_SF)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "brand_map": q_brand_map,
        "classified_purchases_all": q_classified_purchases_all,
        "classified_purchases": q_classified_purchases,
        "spend_hh_brand_period": q_spend_hh_brand_period,
        "spend_hh_brand": q_spend_hh_brand,
        "spend_cs": q_spend_cs,
        "correction_factors": q_correction_factors,
        "corrected_spend_raw": q_corrected_spend_raw,
        "corrected_spend": q_corrected_spend,
        "household_cseg": q_household_cseg,
        "cseg_allocation_join": q_cseg_allocation_join,
        "cseg_allocation_window": q_cseg_allocation_window,
        "gain_loss_matrix": q_gain_loss_matrix,
        "purchase_store": q_purchase_store,
        "weighted_store": q_weighted_store,
        "classified_purchases_large_map": q_classified_purchases_large_map,
        "corrected_spend_large_map": q_corrected_spend_large_map,
        "corrected_spend_raw_large_map": q_corrected_spend_raw_large_map,
        "gain_loss_blocks": q_gain_loss_blocks,
        "gain_loss_exact": q_gain_loss_exact,
        "gain_loss_sql": q_gain_loss_sql,
        "purchase_store_merged": q_purchase_store_merged,
        "weighted_store_updated": q_weighted_store_updated,
    }
    for name in VARIANTS:
        q[f"gain_loss_{name}"] = _variant_query(name)
    return {**q, **_training_data_queries()[0]}


# --------------------------------------------------------------------------- DuckDB oracle
#
# The analysis written from its formulas, not from the stages
# above. Spend is kept long, one row per (household, copy, bucket, period):
#
#   k(b, p)   = sum of full-sample value / sum of weighted spend, 0 if undefined
#   s         = weighted spend * k
#   t(h, p)   = sum of s over the household; c(h) = the smaller of t(h, 1), t(h, 2)
#   q         = s * c / t(h, p), 0 if undefined
#   gain(x, y) = sum over h of  (sum of q(y, 1)) * (sum of q(x, 2) / c),  loss(x, y) = gain(y, x)
#
# A cell's sum over pairs of rows of a household is a product of two sums, so no
# pair of rows is enumerated. Division by zero is spelled out, since DuckDB gives
# inf or NaN, and so is the smaller of two values, since its LEAST skips NULL.

_P = Periods.years(1996, 1997)


def _over(a: str, b: str) -> str:
    """a / b, 0 where that is undefined, NULL or beyond the range of doubles."""
    return f"COALESCE(CASE WHEN {b} <> 0 AND NOT isinf({a} / {b}) THEN {a} / {b} END, 0)"


def _r(x: str, d: int = MONEY) -> str:
    return f"ROUND({x}, {d}) + 0.0"


def _between(day: str, start, end) -> str:
    return f"{day} BETWEEN DATE '{start.isoformat()}' AND DATE '{end.isoformat()}'"


_PERIOD = (
    f"CASE WHEN {_between('day', _P.start_p1, _P.end_p1)} THEN 1"
    f" WHEN {_between('day', _P.start_p2, _P.end_p2)} THEN 2 ELSE 3 END"
)

_PANEL = """
purchases AS (
    SELECT o_custkey AS hhkey, l_orderkey AS occaskey, p_brand AS brand, CAST(l_shipdate AS DATE) AS datep,
        l_extendedprice AS value, 1 - l_discount AS brandfactor, 1 + l_tax AS rwkorr,
        l_quantity / 25 AS rwstd, CAST(0.8 + 0.1 * l_linenumber AS DOUBLE) AS fullmasW
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
),
households AS (
    SELECT c_custkey AS hhkey,
        CASE WHEN c_custkey % 10 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 + 0.25 * (c_custkey % 7) AS DOUBLE) END AS continuo
    FROM customer
),
brand_map AS (
    SELECT DISTINCT p_brand AS brand,
        CASE WHEN CAST(split_part(p_brand, '#', 2) AS INTEGER) <= 12 THEN p_brand ELSE 'GROUPED' END AS aggregation
    FROM part
    WHERE p_brand IS NOT NULL AND CAST(split_part(p_brand, '#', 2) AS INTEGER) <= 15
)"""


def _dated(*, as_text: bool, all_dates: bool) -> str:
    """Purchases with bucket, day and period; ``as_text`` takes the day through its raw form."""
    day = "CAST(strptime(strftime(datep, '%Y%m%d'), '%Y%m%d') AS DATE)" if as_text else "datep"
    return f"""
dated AS (
    SELECT * FROM (
        SELECT p.* EXCLUDE (brand, datep), COALESCE(m.aggregation, 'REST') AS bucket, p.day, {_PERIOD} AS period
        FROM (SELECT *, {day} AS day FROM purchases) p LEFT JOIN brand_map m ON m.brand = p.brand
    ) WHERE {'true' if all_dates else 'period < 3'}
)"""


# Spend per household, bucket and period, also where the household bought the bucket in the other period only.
_CELL = """
cell AS (
    SELECT hhkey, bucket, p,
        SUM(CASE WHEN period = p THEN value * brandfactor ELSE 0 END) AS unweighted,
        SUM(CASE WHEN period = p THEN value * brandfactor * rwkorr * rwstd * fullmasW ELSE 0 END) AS full_sample
    FROM dated, (VALUES (1), (2)) AS periods(p) GROUP BY ALL
),
held AS (
    SELECT cell.*, copy, continuo, unweighted * continuo AS weighted
    FROM cell JOIN (SELECT *, row_number() OVER () AS copy FROM households) USING (hhkey)
)"""

# The same from pre-weighted purchases: the copies of a household are in the sums.
_CELL_WEIGHTED = f"""
held AS (
    SELECT hhkey, bucket, p, 1 AS copy,
        SUM(CASE WHEN period = p THEN spent_cs ELSE 0 END) AS weighted,
        SUM(CASE WHEN period = p THEN spent_fs ELSE 0 END) AS full_sample
    FROM (
        SELECT w.hhkey, w.spent_cs, w.spent_fs, COALESCE(m.aggregation, 'REST') AS bucket, {_PERIOD} AS period
        FROM (SELECT *, datep AS day FROM weighted) w LEFT JOIN brand_map m ON m.brand = w.brand
    ), (VALUES (1), (2)) AS periods(p)
    WHERE period < 3 GROUP BY ALL
)"""

_WEIGHTED = """
weighted AS (
    SELECT hhkey, brand, datep, value * brandfactor * continuo AS spent_cs,
        value * brandfactor * rwkorr * rwstd * fullmasW AS spent_fs
    FROM purchases JOIN households USING (hhkey)
)"""

_FACTOR = f"""
factor AS (
    SELECT bucket, p, {_over('SUM(full_sample)', 'SUM(weighted)')} AS k FROM held GROUP BY bucket, p
)"""


def _corrected(by_weight: bool) -> str:
    """Corrected spend of the households with a weight, or of the rows with spend in some period."""
    keep = "continuo <> 0" if by_weight else "(hhkey, copy, bucket) IN (SELECT (hhkey, copy, bucket) FROM held WHERE weighted <> 0)"
    return f"""
corrected AS (
    SELECT hhkey, copy, bucket, p, weighted * k AS s FROM held JOIN factor USING (bucket, p) WHERE {keep}
),
common AS (
    SELECT hhkey, t1, t2, CASE WHEN t1 <= t2 THEN t1 WHEN t2 < t1 THEN t2 END AS c
    FROM (SELECT hhkey, SUM(s) FILTER (p = 1) AS t1, SUM(s) FILTER (p = 2) AS t2 FROM corrected GROUP BY hhkey)
),
share AS (
    SELECT hhkey, copy, bucket, p, s, c,
        s * CASE p WHEN 1 THEN {_over('c', 't1')} ELSE {_over('c', 't2')} END AS q
    FROM corrected JOIN common USING (hhkey)
)"""


_CELLS = f"""
SELECT x.bucket AS B1, y.bucket AS B2,
    {_r('SUM(y.out1 * x.in2)')} AS total_gains_b1_to_b2, {_r('SUM(x.out1 * y.in2)')} AS total_losses_b1_to_b2
FROM flow x JOIN flow y USING (hhkey) GROUP BY ALL ORDER BY B1, B2"""

_FLOW = f"""
flow AS (
    SELECT hhkey, bucket, SUM(q) FILTER (p = 1) AS out1, SUM({_over('q', 'c')}) FILTER (p = 2) AS in2
    FROM share GROUP BY hhkey, bucket
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join([_PANEL, *ctes])


def _chain(v) -> str:
    """All relations of a variant, up to the shares."""
    if v.source == "weighted_store":
        return _with(_WEIGHTED, _CELL_WEIGHTED, _FACTOR, _corrected(by_weight=False))
    dated = _dated(as_text=v.source == "raw", all_dates=not v.date_filter)
    return _with(dated, _CELL, _FACTOR, _corrected(by_weight=not v.reuse_pre_run))


def _wide(keys: str, relation: str, columns: dict[str, tuple[str, int, int]]) -> str:
    """``relation`` with one column per period: {name: (value, period, digits)}."""
    cols = ", ".join(f"{_r(f'MAX({x}) FILTER (p = {p})', d)} AS {name}" for name, (x, p, d) in columns.items())
    return f"\nSELECT {keys}, {cols} FROM {relation} GROUP BY ALL"


def oracle_sql() -> dict[str, str]:
    v1, v3, v6 = (_chain(VARIANTS[v]) for v in ("v1", "v3", "v6"))
    measures = "rwkorr, rwstd, fullmasW, day AS datep, period"
    spend = {
        **{f"spent_p{p}_ics": ("unweighted", p, ICS) for p in (1, 2)},
        **{f"spent_p{p}_fs": ("full_sample", p, MONEY) for p in (1, 2)},
    }
    weighted = {
        **{f"spent_p{p}_cs": ("weighted", p, CS) for p in (1, 2)},
        **{f"spent_p{p}_fs": ("full_sample", p, MONEY) for p in (1, 2)},
    }
    corrected = {f"spent_p{p}": ("s", p, MONEY) for p in (1, 2)}
    row = "hhkey, bucket AS brand"
    allocation = _wide(
        "hhkey, brand, " + _r("c") + " AS cseg",
        "(SELECT *, bucket AS brand FROM share)",
        {**corrected, **{f"cseg_p{p}": ("q", p, MONEY) for p in (1, 2)}},
    )
    totals = f"\nSELECT hhkey, {_r('t1')} AS total_spent_p1, {_r('t2')} AS total_spent_p2, {_r('c')} AS cseg FROM common"
    sql = {
        "brand_map": _with() + "\nSELECT brand, aggregation FROM brand_map",
        "classified_purchases_all": v1 + f"\nSELECT {row}, value, brandfactor, {measures} FROM dated",
        "classified_purchases": v6 + f"\nSELECT {row}, value * brandfactor AS value, {measures} FROM dated",
        "spend_hh_brand_period": v1 + _wide(row, "cell", spend),
        "spend_hh_brand": v6 + _wide(row, "cell", spend),
        "spend_cs": v6 + _wide(row, "held", weighted),
        "correction_factors": v6
        + _wide("bucket AS brand", "factor", {f"corr_factor_p{p}": ("k", p, FACTOR) for p in (1, 2)}),
        "corrected_spend_raw": v3 + _wide(row, "corrected", corrected),
        "corrected_spend": v6 + _wide(row, "corrected", corrected),
        "household_cseg": v6 + totals,
        "cseg_allocation_join": v6 + allocation,
        "cseg_allocation_window": v6 + allocation,
        "gain_loss_matrix": v6 + "," + _FLOW + _CELLS,
        "purchase_store": _with()
        + "\nSELECT hhkey, occaskey, brand, datep, value, brandfactor, rwkorr, rwstd, fullmasW FROM purchases",
        "weighted_store": _with(_WEIGHTED) + "\nSELECT * FROM weighted",
    }
    same = {
        "classified_purchases_large_map": "classified_purchases",
        "corrected_spend_large_map": "corrected_spend",
        "corrected_spend_raw_large_map": "corrected_spend_raw",
        "gain_loss_blocks": "gain_loss_matrix",
        "gain_loss_exact": "gain_loss_matrix",
        "gain_loss_sql": "gain_loss_matrix",
        "purchase_store_merged": "purchase_store",
        "weighted_store_updated": "weighted_store",
    }
    sql |= {name: sql[usual] for name, usual in same.items()}
    for name, variant in VARIANTS.items():
        sql[f"gain_loss_{name}"] = _chain(variant) + "," + _FLOW + _CELLS
    return {**sql, **_training_data_queries()[1]}
