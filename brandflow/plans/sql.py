"""The analysis as a SQL table function, to be called from SQL like a stored procedure.

``register_gain_loss`` puts the inputs into temporary views and defines a temporary
table function over them, whose four date arguments have the default periods:

    SELECT * FROM gain_loss()
    SELECT * FROM gain_loss(start_p1 => DATE'1996-01-01', end_p1 => DATE'1996-12-31', ...)

``declare_periods`` declares the same four dates as session variables, for scripts that
set them once (``SET VAR start_p1 = ...``) and call ``gain_loss(start_p1, end_p1, ...)``.

The body is the single-pass formulation (v6) in SQL: one aggregation of the purchases,
household copies folded before the join, pairs exploded into the partial aggregate. The
optimizer inlines it into the calling query, so filters on its result are pushed down.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import REST_BUCKET, Periods

_DATES = ("start_p1", "end_p1", "start_p2", "end_p2")

def _ratio(a: str, b: str) -> str:
    """a / b, 0 where it is undefined, NULL or beyond the range of doubles."""
    return f"coalesce(CASE WHEN abs(try_divide({a}, {b})) < double('inf') THEN try_divide({a}, {b}) END, 0D)"


def _body(view: dict[str, str]) -> str:
    def spread(x: str) -> str:
        return f"sum(CASE WHEN period = 1 THEN {x} ELSE 0D END) AS {x}_1, sum(CASE WHEN period = 2 THEN {x} ELSE 0D END) AS {x}_2"

    return f"""
WITH dated AS (
  SELECT hhkey, brand, value * brandfactor AS ics, value * brandfactor * rwkorr * rwstd * fullmasW AS fs,
    CASE WHEN datep BETWEEN start_p1 AND end_p1 THEN 1 WHEN datep BETWEEN start_p2 AND end_p2 THEN 2 END AS period
  FROM {view['purchases']}
),
spend AS (
  SELECT p.hhkey, CASE WHEN m.brand IS NOT NULL THEN m.aggregation ELSE '{REST_BUCKET}' END AS bucket, {spread('ics')}, {spread('fs')}
  FROM dated p LEFT JOIN {view['brand_map']} m ON p.brand = m.brand
  WHERE period IS NOT NULL
  GROUP BY 1, 2
),
weights AS (
  SELECT hhkey, count(*) AS copies, sum(continuo) AS continuo, count_if(continuo <> 0) AS active FROM {view['households']} GROUP BY hhkey
),
panel AS (
  SELECT hhkey, bucket, ics_1, ics_2, ics_1 * continuo AS cs_1, ics_2 * continuo AS cs_2, fs_1 * copies AS fs_1, fs_2 * copies AS fs_2, active
  FROM spend JOIN weights USING (hhkey)
),
factor AS (
  SELECT bucket, {_ratio('sum(fs_1)', 'sum(cs_1)')} AS k1, {_ratio('sum(fs_2)', 'sum(cs_2)')} AS k2 FROM panel GROUP BY bucket
),
spent AS (
  SELECT hhkey, bucket, cs_1 * k1 AS s1, cs_2 * k2 AS s2 FROM panel JOIN factor USING (bucket)
  WHERE active > 0 AND (ics_1 <> 0 OR ics_2 <> 0)
),
totals AS (
  SELECT *, sum(s1) OVER (PARTITION BY hhkey) AS t1, sum(s2) OVER (PARTITION BY hhkey) AS t2 FROM spent
),
common AS (
  SELECT *, CASE WHEN t1 IS NOT NULL AND t2 IS NOT NULL THEN least(t1, t2) END AS c FROM totals
),
shares AS (
  SELECT hhkey, bucket, s1 * {_ratio('c', 't1')} AS q1, s2 * {_ratio('c', 't2')} AS q2, c FROM common
),
held AS (
  SELECT sort_array(collect_list(struct(bucket AS b, q1, {_ratio('q2', 'c')} AS f))) AS held FROM shares GROUP BY hhkey
),
firsts AS (SELECT held, i, x FROM held LATERAL VIEW posexplode(held) AS i, x),
pairs AS (SELECT x, y FROM firsts LATERAL VIEW explode(slice(held, i + 1, size(held) - i)) AS y),
sums AS (
  SELECT x.b AS low, y.b AS high, sum(y.q1 * x.f) AS up, sum(x.q1 * y.f) AS down FROM pairs GROUP BY x.b, y.b
),
cells AS (
  SELECT inline(CASE WHEN low = high THEN array(struct(low AS B1, high AS B2, up AS gains, down AS losses))
    ELSE array(struct(low AS B1, high AS B2, up AS gains, down AS losses), struct(high AS B1, low AS B2, down AS gains, up AS losses)) END)
  FROM sums
)
SELECT B1, B2, round(gains, 2) AS total_gains_b1_to_b2, round(losses, 2) AS total_losses_b1_to_b2 FROM cells"""


def register_gain_loss(
    spark: SparkSession,
    purchases: DataFrame,
    households: DataFrame,
    brand_map: DataFrame,
    *,
    name: str = "gain_loss",
    periods: Periods = Periods(),
) -> None:
    """Define ``name(start_p1, end_p1, start_p2, end_p2)``: the gain/loss matrix, unordered, as a table in SQL.

    ``purchases`` have a DATE ``datep``, as in a purchase store. The inputs stay views: the
    function sees what they hold when it is called. Both the function and the views
    (``<name>_purchases``, ...) belong to the session.
    """
    inputs = {"purchases": purchases, "households": households, "brand_map": brand_map}
    views = {table: f"{name}_{table}" for table in inputs}
    for table, rows in inputs.items():
        rows.createOrReplaceTempView(views[table])
    args = ", ".join(f"{d} DATE DEFAULT DATE'{getattr(periods, d).isoformat()}'" for d in _DATES)
    columns = "B1 STRING, B2 STRING, total_gains_b1_to_b2 DOUBLE, total_losses_b1_to_b2 DOUBLE"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS TABLE ({columns}) RETURN {_body(views)}")


def declare_periods(spark: SparkSession, periods: Periods = Periods()) -> None:
    """Session variables ``start_p1``, ``end_p1``, ``start_p2``, ``end_p2`` with the default dates."""
    for d in _DATES:
        spark.sql(f"DECLARE OR REPLACE VARIABLE {d} DATE DEFAULT DATE'{getattr(periods, d).isoformat()}'")
