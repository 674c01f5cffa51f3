"""Statistics on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldgauge.functions import distributions as dist
from fieldgauge.functions.scalars import digitize
from fieldgauge.operators import association, joins, ranks, regression, resampling, reshape
from fieldgauge.queries.basics import W_LONG_SQL, Y_MONTH_SQL, y_month
from fieldgauge.queries.bindings import r, season_sql
from fieldgauge.queries.registry import query
from fieldgauge.session import materialise

# ---------------------------------------------------------- tails in SQL ----
# Each is the integral of the density beyond the statistic over the whole integral, by Simpson's
# rule in a variable in which the density is smooth, so that no gamma function is needed.


def simpson(density: str, low: str, high: str, panels: int = 2000) -> str:
    """Integral of ``density``, an expression of ``u``."""
    at = f"(({low}) + i * (({high}) - ({low})) / {panels})"
    weight = f"(CASE WHEN i % {panels} = 0 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    total = f"list_sum(list_transform(range(0, {panels + 1}), lambda i: {weight} * {density.replace('#u', at)}))"
    return f"((({high}) - ({low})) / {3 * panels} * {total})"


def share(density: str, low: str, high: str) -> str:
    return f"({simpson(density, low, high)} / {simpson(density, '0.0', high)})"


def t_tail_sql(t: str, df: str) -> str:
    """Two-sided Student-t: with t = sqrt(df) tan(u) the density is a power of the cosine."""
    reach = f"least(pi() / 2, 12 / sqrt({df}))"  # what lies beyond is below 1e-30
    return share(f"pow(cos(#u), {df} - 1)", f"least(atan(abs({t}) / sqrt({df})), {reach})", reach)


def chi2_tail_sql(x: str, df: str) -> str:
    """Upper chi-square: with x = u^2 the density is u^(df - 1) exp(-u^2 / 2), here over its peak."""
    peak = f"sqrt(greatest({df} - 1, 1.0))"
    high = f"({peak} + 12)"
    density = f"exp(({df} - 1) * ln(greatest(#u, 1e-300) / {peak}) - (#u * #u - {peak} * {peak}) / 2)"
    return share(density, f"least(sqrt({x}), {high})", high)


def f_tail_sql(f: str, d1: str, d2: str) -> str:
    """Upper F: an incomplete beta integral, with sines and cosines for its powers."""
    density = f"pow(sin(#u), {d2} - 1) * pow(cos(#u), {d1} - 1)"
    return share_below(density, f"asin(sqrt({d2} / ({d2} + {d1} * ({f}))))", "(pi() / 2)")


def share_below(density: str, at: str, high: str) -> str:
    return f"({simpson(density, '0.0', at)} / {simpson(density, '0.0', high)})"


NORMAL_975 = 1.959963984540054


def t_critical_sql(df: str) -> str:
    """97.5 % point of Student-t by the expansion around that of the normal."""
    z = NORMAL_975
    terms = (
        (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    )
    return "(" + " + ".join([repr(z), *(f"{c!r} / pow({df}, {i})" for i, c in enumerate(terms, 1))]) + ")"


# ------------------------------------------------ least squares in SQL ----


def inverse_sql(name: str, source: str, keys: str, k: int) -> str:
    """Views ending in ``name`` (keys, m): the inverse of the matrices (keys, i, j, v) of ``source``.

    Gauss-Jordan elimination, a view per pivot; the matrices are positive definite.
    """
    out = f"""
, {name}_r AS (SELECT {keys}, i, list_concat(list(v ORDER BY j), list_transform(range(1, {k + 1}), lambda c: CASE WHEN c = i THEN 1.0::DOUBLE ELSE 0.0 END)) AS r
          FROM {source} GROUP BY {keys}, i)
, {name}_0 AS (SELECT {keys}, list(r ORDER BY i) AS m FROM {name}_r GROUP BY {keys})"""
    for p in range(1, k + 1):
        out += f"""
, {name}_{p} AS (SELECT {keys}, list_transform(m, lambda r, i: CASE WHEN i = {p} THEN list_transform(r, lambda v: v / m[{p}][{p}])
          ELSE list_transform(r, lambda v, j: v - r[{p}] * m[{p}][j] / m[{p}][{p}]) END) AS m FROM {name}_{p - 1})"""
    return out + f"\n, {name} AS (SELECT {keys}, list_transform(m, lambda r: r[{k + 1}:{2 * k}]) AS m FROM {name}_{k})"


def dot_sql(a: str, b: str, k: int) -> str:
    return "(" + " + ".join(f"{a}[{i}] * {b}[{i}]" for i in range(1, k + 1)) + ")"


def ols_sql(name: str, rows: str, keys: str, design: list[str], cluster: str | None, absorb: str | None = None) -> str:
    """Views of the fit of y on the design columns of ``rows``: ``name``_c has, per key and position j,
    coef and standard_error with n, parameters, df and r2; ``name``_v the covariance (i, j, v).

    ``absorb`` takes the means of these columns' cells out first.  The errors are clustered, or HC3.
    """
    k = len(design)
    xs = "[" + ", ".join(f"({c})::DOUBLE" for c in design) + "]"
    out = f"\n, {name}_d0 AS (SELECT {keys}, {cluster or 0} AS cl, {absorb or 0} AS ab, y::DOUBLE AS y, {xs} AS xs FROM {rows} WHERE y IS NOT NULL)"
    if absorb:
        means = ", ".join(f"avg(xs[{i}])" for i in range(1, k + 1))
        out += f"""
, {name}_m AS (SELECT {keys}, ab, avg(y) AS my, [{means}] AS mx, count(*) AS size FROM {name}_d0 GROUP BY {keys}, ab)
, {name}_d AS (SELECT {keys}, cl, y AS raw, y - my AS y, list_transform(xs, lambda v, i: v - mx[i]) AS xs, 1.0 / size AS h0
          FROM {name}_d0 JOIN {name}_m USING ({keys}, ab))"""
    else:
        out += f"\n, {name}_d AS (SELECT {keys}, cl, y AS raw, y, xs, 0.0 AS h0 FROM {name}_d0)"
    out += f"""
, {name}_g AS (SELECT {keys}, i, j, sum(xs[i] * xs[j]) AS v FROM {name}_d, range(1, {k + 1}) a(i), range(1, {k + 1}) b(j) GROUP BY ALL)"""
    out += inverse_sql(f"{name}_i", f"{name}_g", keys, k)
    beta = "[" + ", ".join(dot_sql(f"m[{i}]", "xy", k) for i in range(1, k + 1)) + "]"
    leverage = "(" + " + ".join(f"xs[{i}] * {dot_sql(f'm[{i}]', 'xs', k)}" for i in range(1, k + 1)) + ")"
    xy = ", ".join(f"sum(xs[{i}] * y)" for i in range(1, k + 1))
    out += f"""
, {name}_b AS (SELECT {keys}, m, {beta} AS beta, n, p, sst FROM {name}_i JOIN (SELECT {keys}, [{xy}] AS xy, count(*) AS n,
          CAST(round(sum(h0)) AS BIGINT) + {k} AS p, var_pop(raw) * count(*) AS sst FROM {name}_d GROUP BY {keys}) USING ({keys}))
, {name}_e AS (SELECT {keys}, cl, xs, m, y - {dot_sql('xs', 'beta', k)} AS e, 1 - h0 - {leverage} AS free FROM {name}_d JOIN {name}_b USING ({keys}))"""
    if cluster:
        sums = ", ".join(f"sum(xs[{i}] * e)" for i in range(1, k + 1))
        out += f"\n, {name}_s AS (SELECT {keys}, cl, [{sums}] AS s, any_value(m) AS m FROM {name}_e GROUP BY {keys}, cl)"
    else:
        out += f"""
, {name}_s AS (SELECT {keys}, cl, list_transform(xs, lambda v: CASE WHEN free > 1e-12 THEN v * e / free ELSE 0 END) AS s, m FROM {name}_e)"""
    scores = "[" + ", ".join(dot_sql(f"m[{i}]", "s", k) for i in range(1, k + 1)) + "]"
    factor = "g / (g - 1.0) * (n - 1.0) / (n - p)" if cluster else "1.0"
    return out + f"""
, {name}_u AS (SELECT {keys}, {scores} AS u FROM {name}_s)
, {name}_v AS (SELECT {keys}, i, j, sum(u[i] * u[j]) * any_value({factor}) AS v
          FROM {name}_u JOIN {name}_b USING ({keys}) JOIN (SELECT {keys}, count(*) AS g FROM {name}_s GROUP BY {keys}) USING ({keys}),
               range(1, {k + 1}) a(i), range(1, {k + 1}) b(j) GROUP BY {keys}, i, j)
, {name}_f AS (SELECT {keys}, any_value(beta) AS beta, any_value(n) AS n, any_value(p) AS p, any_value(g) AS g, 1 - any_value(sse) / any_value(sst) AS r2
          FROM {name}_b JOIN (SELECT {keys}, sum(e * e) AS sse FROM {name}_e GROUP BY {keys}) USING ({keys})
               JOIN (SELECT {keys}, count(*) AS g FROM {name}_s GROUP BY {keys}) USING ({keys}) GROUP BY {keys})
, {name}_c AS (SELECT {keys}, i AS j, n, p AS parameters, {'g - 1' if cluster else 'n - p'} AS df, r2, beta[i] AS coef, sqrt(v) AS standard_error
          FROM {name}_f JOIN {name}_v USING ({keys}) WHERE i = j)"""


SITE_MEANS_SQL = """
, sm AS (SELECT location_id, any_value(country) AS country, any_value(region) AS region, any_value(elevation_m) AS elevation_m,
                any_value(latitude) AS latitude, avg(quantity) AS quantity, avg(price) AS price
         FROM w_at_sites GROUP BY 1)
, scoped AS (SELECT 'all' AS scope, * FROM sm UNION ALL SELECT 'asia', * FROM sm WHERE region = 'ASIA')
, pr AS (SELECT scope, 'elevation_m' AS predictor, 'quantity' AS outcome, elevation_m AS x, quantity AS y FROM scoped
  UNION ALL SELECT scope, 'elevation_m', 'price', elevation_m, price FROM scoped
  UNION ALL SELECT scope, 'latitude', 'price', latitude, price FROM scoped)"""

PAIRS = [("elevation_m", "quantity"), ("elevation_m", "price"), ("latitude", "price")]


def site_means(t):
    return t.w_at_sites.groupBy("location_id").agg(
        *[F.first(c).alias(c) for c in ("country", "region", "elevation_m", "latitude", "longitude")],
        F.avg("quantity").alias("quantity"), F.avg("price").alias("price"),
    )


def scoped(t):
    return association.with_scopes(site_means(t), {"all": F.lit(True), "asia": F.col("region") == "ASIA"})


#: of a correlation r of n pairs
R_TAIL_SQL = t_tail_sql("(r * sqrt((n - 2) / (1 - r * r)))", "(n - 2)")


@query("stat1_lapse_rates", f"""
, d AS (SELECT location_id, CAST(timestamp AS DATE) AS date, {season_sql()} AS season, elevation_m, avg(price) AS v
        FROM w_at_sites GROUP BY ALL)
SELECT season, {r('1000 * regr_slope(v, elevation_m)')} AS milli_slope, {r('1000 * regr_slope(v, elevation_m)')} AS lapse_rate_c_per_km,
       {r('regr_intercept(v, elevation_m)')} AS intercept_c, {r('regr_r2(v, elevation_m)')} AS r2,
       {r('sqrt(regr_syy(v, elevation_m) * (1 - regr_r2(v, elevation_m)) / count(*))')} AS rmse_c, count(*) AS sample_size
FROM d GROUP BY 1 HAVING count(DISTINCT elevation_m) >= 2""")
def _(t):
    days = joins.enrich(t.w, t.w_sites).groupBy("location_id", "date", "season", "elevation_m").agg(
        F.avg("price").alias("v")
    )
    return regression.lapse_rates(days, value="v").select(
        "season", (F.col("slope_c_per_m") * 1000).alias("milli_slope"), "lapse_rate_c_per_km",
        "intercept_c", "r2", "rmse_c", "sample_size",
    )


@query("stat2_pearson", SITE_MEANS_SQL + f"""
, c AS (SELECT scope, predictor, outcome, count(*) AS n, corr(x, y) AS r FROM pr GROUP BY 1, 2, 3)
SELECT scope, predictor, outcome, n, {r('r')} AS r, {r(R_TAIL_SQL)} AS p FROM c""")
def _(t):
    return association.pearson(scoped(t), PAIRS, ["scope"])


@query("stat2_pearson_monthly_p", f"""
, m AS (SELECT location_id, month(timestamp) AS month, any_value(elevation_m) AS x, avg(quantity) AS quantity, avg(price) AS price
        FROM w_at_sites GROUP BY 1, 2)
, c AS (SELECT month, 'elevation_m' AS predictor, 'quantity' AS outcome, CAST(regr_count(quantity, x) AS BIGINT) AS n, corr(x, quantity) AS r FROM m GROUP BY 1
  UNION ALL SELECT month, 'elevation_m', 'price', CAST(regr_count(price, x) AS BIGINT), corr(x, price) FROM m GROUP BY 1)
SELECT month, predictor, outcome, n, {r('r')} AS r, {r(R_TAIL_SQL)} AS p FROM c""")
def _(t):
    rows = t.w_at_sites.groupBy("location_id", F.month("timestamp").alias("month")).agg(
        F.first("elevation_m").alias("elevation_m"), F.avg("quantity").alias("quantity"), F.avg("price").alias("price")
    )
    return association.pearson(rows, PAIRS[:2], ["month"])


RANKED_SQL = """
, rk AS (SELECT scope, predictor, outcome,
   rank() OVER (PARTITION BY scope, predictor, outcome ORDER BY x) + (count(*) OVER (PARTITION BY scope, predictor, outcome, x) - 1) / 2 AS rx,
   rank() OVER (PARTITION BY scope, predictor, outcome ORDER BY y) + (count(*) OVER (PARTITION BY scope, predictor, outcome, y) - 1) / 2 AS ry
   FROM pr)"""


@query("stat3_spearman", SITE_MEANS_SQL + RANKED_SQL + f"""
, c AS (SELECT scope, predictor, outcome, count(*) AS n, corr(rx, ry) AS r FROM rk GROUP BY 1, 2, 3)
SELECT scope, predictor, outcome, n, {r('r')} AS r, {r(R_TAIL_SQL)} AS p FROM c""")
def _(t):
    return association.spearman(scoped(t), PAIRS, ["scope"])


@query("stat4_kruskal", W_LONG_SQL + f"""
, dl AS (SELECT metric, location_id, value FROM w_long WHERE value IS NOT NULL AND metric IN ('quantity', 'price'))
, rk AS (SELECT metric, location_id, rank() OVER (PARTITION BY metric ORDER BY value)
         + (count(*) OVER (PARTITION BY metric, value) - 1) / 2 AS rk FROM dl)
, tot AS (SELECT metric, avg(rk) AS m, var_samp(rk) AS v, count(*) AS n FROM rk GROUP BY 1)
, g AS (SELECT metric, location_id, count(*) AS n, avg(rk) AS m FROM rk GROUP BY 1, 2)
, h AS (SELECT g.metric, any_value(tot.n) AS n, count(*) AS groups, sum(g.n * pow(g.m - tot.m, 2)) / any_value(tot.v) AS h
       FROM g JOIN tot ON tot.metric = g.metric GROUP BY 1)
SELECT metric, n, groups, {r('h')} AS statistic, {r(chi2_tail_sql('h', '(groups - 1)'))} AS p FROM h""")
def _(t):
    long = reshape.to_long(t.w, ["location_id"], ["quantity", "price"])
    return association.kruskal(long, "location_id", "value", ["metric"])


Y6_SQL = Y_MONTH_SQL + """
, y6 AS (SELECT location_id, year, month, round(value, 1) AS value FROM y_month WHERE year BETWEEN 1995 AND 2000)
, y6r AS (SELECT *, rank() OVER (PARTITION BY location_id, year ORDER BY value)
          + (count(*) OVER (PARTITION BY location_id, year, value) - 1) / 2 AS rk FROM y6)"""


def y6(t):
    # one decimal, so that ties occur
    return y_month(t).filter("year BETWEEN 1995 AND 2000").withColumn("value", F.round("value", 1))


@query("stat5_friedman", Y6_SQL + f"""
, rs AS (SELECT location_id, month, sum(rk) AS s FROM y6r GROUP BY 1, 2)
, tie AS (SELECT location_id, sum(c * c * c - c) AS t FROM (SELECT location_id, year, value, count(*) AS c FROM y6 GROUP BY 1, 2, 3) GROUP BY 1)
, q AS (SELECT rs.location_id, (12.0 / (6 * 12 * 13) * sum(s * s) - 3 * 6 * 13) / (1 - any_value(t) / (6 * 12 * 143.0)) AS q
        FROM rs JOIN tie USING (location_id) GROUP BY 1)
SELECT location_id, CAST(6 AS BIGINT) AS blocks, CAST(12 AS BIGINT) AS treatments, {r('q')} AS statistic, {r('q / 66')} AS kendall_w,
       {r(chi2_tail_sql('q', '11'))} AS p FROM q""")
def _(t):
    return association.friedman(y6(t), "year", "month", "value", ["location_id"])


def y6_ranks(t):
    ranked = y6(t).withColumn("rank", ranks.small_group_rank("value", ["location_id", "year"]))
    return reshape.matrix_array(ranked, ["location_id"], "year", "month", "rank", "ranks")


@query("stat6_rotation_test", Y6_SQL + f"""
, m AS (SELECT location_id, list(l ORDER BY year) AS m FROM (SELECT location_id, year, list(rk ORDER BY month) AS l FROM y6r GROUP BY 1, 2) GROUP BY 1)
, obs AS (SELECT location_id, m, list_sum(list_transform(range(1, 13), lambda c: pow(m[1][c] + m[2][c] + m[3][c] + m[4][c] + m[5][c] + m[6][c] - 39, 2))) AS o FROM m)
, nul AS (SELECT location_id, o, list_sum(list_transform(range(0, 12), lambda c: pow(m[1][c + 1] + m[2][(c + k) % 12 + 1]
     + m[3][(c + k // 12) % 12 + 1] + m[4][(c + k // 144) % 12 + 1] + m[5][(c + k // 1728) % 12 + 1]
     + m[6][(c + k // 20736) % 12 + 1] - 39, 2))) AS n FROM obs, range(0, 248832) x(k))
SELECT location_id, {r('any_value(o)')} AS statistic, count(*) AS rotations,
       {r('avg(CASE WHEN n >= o - 1e-9 THEN 1.0 ELSE 0.0 END)')} AS rotation_p FROM nul GROUP BY 1""")
def _(t):
    return resampling.rotation_test(y6_ranks(t), ["location_id"])


# cells: one calendar month, a row of daily values per year in which the month is complete, leap day aside
CELLS_SQL = """
, cell AS (SELECT month(date) AS month, year(date) AS year, day(date) AS day, value FROM y_global
           WHERE NOT (month(date) = 2 AND day(date) = 29) QUALIFY count(*) OVER (PARTITION BY year(date), month(date)) =
                 least(day(last_day(date)), CASE WHEN month(date) = 2 THEN 28 ELSE 31 END))
, med AS (SELECT month, year, median(value) AS m FROM cell GROUP BY 1, 2)
, cen AS (SELECT month, year, day, value, value - m AS c, abs(value - m) AS d FROM cell JOIN med USING (month, year))"""


def complete_cell_days(t):
    from fieldgauge.operators.filters import drop_leap_day

    days = drop_leap_day(t.y_global)
    wanted = F.when(F.month("date") == 2, 28).otherwise(F.dayofmonth(F.last_day("date")))
    whole = days.groupBy(F.year("date").alias("_y"), F.month("date").alias("_m")).agg(
        F.count(F.lit(1)).alias("_n"), F.max(wanted).alias("_days")
    ).filter("_n = _days")
    return days.join(whole, (F.year("date") == F.col("_y")) & (F.month("date") == F.col("_m")), "left_semi").select(
        F.month("date").alias("month"), F.year("date").alias("year"), F.dayofmonth("date").alias("day"), "value"
    )


def complete_cells(t):
    return reshape.matrix_array(complete_cell_days(t), ["month"], "year", "day", "value")


def f_sql(source: str, keys: str, label: str, value: str, name: str) -> str:
    """One-way F with equal group sizes, as CTE ``name``."""
    return f"""
, {name}_g AS (SELECT {keys}, {label} AS label, avg({value}) AS m, sum({value} * {value}) - sum({value}) * sum({value}) / count(*) AS w,
               count(*) AS n FROM {source} GROUP BY {keys}, {label})
, {name} AS (SELECT {keys}, CASE WHEN sum(w) > 0 THEN (any_value(n) * (count(*) - 1) * var_samp(m) / (count(*) - 1))
             / (sum(w) / (count(*) * (any_value(n) - 1))) ELSE 0 END AS f FROM {name}_g GROUP BY {keys})"""


@query("stat7_block_f", CELLS_SQL + f_sql("cen", "month", "year", "value", "lf") + f_sql("cen", "month", "year", "d", "sf") + f"""
SELECT month, {r('lf.f')} AS level_f, {r('sf.f')} AS spread_f FROM lf JOIN sf USING (month)""")
def _(t):
    return resampling.block_permutation(complete_cells(t), ["month"], replicates=4999).select("month", "level_f", "spread_f")


@query("stat7_block_permutation")
def _(t):
    return resampling.block_permutation(complete_cells(t), ["month"], replicates=4999)


@query("stat8_block_score", CELLS_SQL + f"""
, rk AS (SELECT month, year, rank() OVER (PARTITION BY month ORDER BY value) + (count(*) OVER (PARTITION BY month, value) - 1) / 2 AS rk FROM cell)
, tot AS (SELECT month, avg(rk) AS m, var_samp(rk) AS v FROM rk GROUP BY 1)
, g AS (SELECT month, year, count(*) AS n, avg(rk) AS m FROM rk GROUP BY 1, 2)
SELECT g.month, {r('sum(g.n * pow(g.m - tot.m, 2)) / any_value(tot.v)')} AS statistic FROM g JOIN tot USING (month) GROUP BY 1""")
def _(t):
    scores = resampling.block_scores(complete_cell_days(t), ["month"], "year", "day", "value")
    return resampling.block_score_test(scores, ["month"], replicates=9999).filter("kind = 'level'").select("month", "statistic")


@query("stat8_block_score_test")
def _(t):
    scores = resampling.block_scores(complete_cell_days(t), ["month"], "year", "day", "value")
    return resampling.block_score_test(scores, ["month"], replicates=9999)


def band_months(t):
    rows = t.w_at_sites.groupBy("location_id", "region", "elevation_m", F.month("timestamp").alias("month")).agg(
        F.avg("quantity").alias("value")
    )
    return rows.withColumn("band", digitize("elevation_m", (500, 1500)))


@query("stat9_band_statistic", f"""
, v AS (SELECT location_id, (elevation_m >= 500)::INT + (elevation_m >= 1500)::INT AS band, month(timestamp) AS month, avg(quantity) AS value
        FROM w_at_sites GROUP BY 1, 2, 3)
, rk AS (SELECT month, band, rank() OVER (PARTITION BY month ORDER BY value) + (count(*) OVER (PARTITION BY month, value) - 1) / 2 AS rk FROM v)
, tot AS (SELECT month, avg(rk) AS m, var_samp(rk) AS v FROM rk GROUP BY 1)
, g AS (SELECT month, band, count(*) AS n, avg(rk) AS m FROM rk GROUP BY 1, 2)
SELECT g.month, {r('sum(g.n * pow(g.m - tot.m, 2)) / any_value(tot.v)')} AS statistic FROM g JOIN tot USING (month) GROUP BY 1""")
def _(t):
    return resampling.stratified_permutation(
        band_months(t), "value", "band", "region", by=["month"], replicates=9999
    ).select("month", "statistic")


@query("stat9_stratified_permutation")
def _(t):
    return resampling.stratified_permutation(
        band_months(t), "value", "band", "region", by=["month"], replicates=9999
    )


# a cell for each month and pair of consecutive years in which the month is complete
PAIRS_SQL = CELLS_SQL[: CELLS_SQL.index("\n, med AS")].replace(", cell AS (", ", whole AS (") + """
, cell AS (SELECT year - o AS first_year, month, year, day, value FROM whole, range(0, 2) y(o)
           QUALIFY min(year) OVER (PARTITION BY year - o, month) < max(year) OVER (PARTITION BY year - o, month))
, med AS (SELECT first_year, month, year, median(value) AS m FROM cell GROUP BY 1, 2, 3)
, cen AS (SELECT first_year, month, year, day, value, value - m AS c FROM cell JOIN med USING (first_year, month, year))"""


def paired_cells(t):
    year = F.col("year")
    days = complete_cell_days(t).withColumn("first_year", F.explode(F.array(year - 1, year)))
    whole = days.groupBy("first_year", "month").agg(F.min("year").alias("_a"), F.max("year").alias("_b")).filter("_a < _b")
    paired = days.join(whole, ["first_year", "month"], "left_semi")
    return reshape.matrix_array(paired, ["first_year", "month"], "year", "day", "value")


@query("stat10_exact_exchange", PAIRS_SQL + f"""
, masks AS (SELECT DISTINCT c.first_year, c.month, k
            FROM (SELECT first_year, month, max(day) AS last FROM cell GROUP BY 1, 2) c, range(0, 2048) x(k)
            WHERE k < pow(2, ceil(last / 7)))
, mv AS (SELECT c.first_year, c.month, k, (year - c.first_year + ((k >> ((day - 1) // 7)) & 1)) % 2 AS label, day, value, c
         FROM cen c JOIN masks USING (first_year, month))
, mm AS (SELECT first_year, month, k, label, median(c) AS m FROM mv GROUP BY 1, 2, 3, 4)
, md AS (SELECT mv.first_year, mv.month, mv.k, mv.label, value, abs(c - m) AS d
         FROM mv JOIN mm USING (first_year, month, k, label))
""" + f_sql("md", "first_year, month, k", "label", "value", "lf") + f_sql("md", "first_year, month, k", "label", "d", "sf") + f"""
, ol AS (SELECT first_year, month, f FROM lf WHERE k = 0) , os AS (SELECT first_year, month, f FROM sf WHERE k = 0)
SELECT first_year, month, count(*) AS assignments, {r('any_value(ol.f)')} AS level_f,
       {r('avg(CASE WHEN lf.f >= ol.f - 1e-9 THEN 1.0 ELSE 0.0 END)')} AS level_p, {r('any_value(os.f)')} AS spread_f,
       {r('avg(CASE WHEN sf.f >= os.f - 1e-9 THEN 1.0 ELSE 0.0 END)')} AS spread_p
FROM lf JOIN sf USING (first_year, month, k) JOIN ol USING (first_year, month) JOIN os USING (first_year, month) GROUP BY 1, 2""")
def _(t):
    return resampling.exact_exchange(paired_cells(t), ["first_year", "month"], 7)


# slope, clustered and HC3 errors of a single regressor, by partialling out
def slope_sql(rows: str, keys: str, absorb: str | None, cluster: str | None) -> str:
    cell = f"PARTITION BY {keys}" + (f", {absorb}" if absorb else "")
    levels = f"count(DISTINCT {absorb})" if absorb else "1"
    if cluster:
        meat = f"""
, sc AS (SELECT {keys}, {cluster}, sum(xc * e) AS s FROM res GROUP BY {keys}, {cluster})
, me AS (SELECT {keys}, sum(s * s) AS meat, count(*) AS g FROM sc GROUP BY {keys})"""
        factor = "g / (g - 1) * (n - 1) / (n - p)"
    else:
        meat = f"""
, me AS (SELECT {keys}, sum(CASE WHEN 1 - 1.0 / nc - xc * xc / sxx > 1e-12 THEN pow(xc * e / (1 - 1.0 / nc - xc * xc / sxx), 2) ELSE 0 END) AS meat,
         1 AS g FROM res GROUP BY {keys})"""
        factor = "1"
    return f"""
, cen AS (SELECT *, x - avg(x) OVER ({cell}) AS xc, y - avg(y) OVER ({cell}) AS yc, count(*) OVER ({cell}) AS nc FROM {rows})
, fit AS (SELECT {keys}, sum(xc * yc) / sum(xc * xc) AS b, sum(xc * xc) AS sxx, count(*) AS n, {levels} + 1 AS p FROM cen GROUP BY {keys})
, res AS (SELECT cen.*, yc - b * xc AS e, sxx FROM cen JOIN fit USING ({keys}))""" + meat + f"""
SELECT {keys}, n, {r('b')} AS coef, {r(f'sqrt({factor} * meat) / sxx')} AS standard_error,
       {r(f'b / (sqrt({factor} * meat) / sxx)')} AS statistic FROM fit JOIN me USING ({keys})"""


OLS_ROWS_SQL = ", rr AS (SELECT region, country, location_id, month(timestamp) AS month, elevation_m / 1000 AS x, price AS y FROM w_at_sites)"


def ols_rows(t):
    return t.w_at_sites.select(
        "region", "country", "location_id", F.month("timestamp").alias("month"), "latitude", "longitude",
        (F.col("elevation_m") / 1000).alias("x"), F.col("price").alias("y"), "quantity",
    )


def slope_only(coefficients, *by):
    return coefficients.filter("term = 'x'").select(*by, "n", "coef", "standard_error", "statistic")


@query("stat11_ols_cluster", OLS_ROWS_SQL + slope_sql("rr", "region", None, "location_id"))
def _(t):
    fit = regression.ols(ols_rows(t), "y", ["x"], by=["region"], covariance="cluster", cluster="location_id")
    return slope_only(regression.coefficients(fit, ["region"], use_t=False), "region")


@query("stat11_ols_cluster_absorbed", OLS_ROWS_SQL + slope_sql("rr", "region", "month", "location_id"))
def _(t):
    fit = regression.ols(
        ols_rows(t), "y", ["x"], by=["region"], absorb=["month"], covariance="cluster", cluster="location_id"
    )
    return slope_only(regression.coefficients(fit, ["region"], use_t=False), "region")


NESTED = (["x"], ["x", "latitude", "longitude"], ["x", "latitude", "longitude", *(f"month={m}" for m in range(2, 13))])


def nested_sql() -> str:
    views, parts = "", []
    for i, terms in enumerate(NESTED, 1):
        columns = [f"(month = {t[6:]})::INT" if t.startswith("month=") else t for t in terms]
        views += ols_sql(f"n{i}", "rr", "one", ["1", *columns], "location_id")
        names = "['intercept', " + ", ".join(f"'{t}'" for t in terms) + "]"
        parts.append(f"""SELECT {names}[j] AS term, n, {r('r2')} AS r2, {r('coef')} AS coef, {r('standard_error')} AS standard_error,
       {r('coef / standard_error')} AS statistic, {r(chi2_tail_sql('pow(coef / standard_error, 2)', '1.0'))} AS p,
       {r(f'coef - {NORMAL_975} * standard_error')} AS ci_low, {r(f'coef + {NORMAL_975} * standard_error')} AS ci_high, CAST({i} AS BIGINT) AS model FROM n{i}_c""")
    return views + "\n" + "\nUNION ALL ".join(parts)


@query("stat11_ols_nested", """
, rr AS (SELECT 1 AS one, location_id, month(timestamp) AS month, elevation_m / 1000 AS x, latitude, longitude, price AS y FROM w_at_sites)
""" + nested_sql())
def _(t):
    rows = ols_rows(t)
    design, _dummies = regression.with_dummies(rows, "month", list(range(1, 13)))
    fits = [
        regression.coefficients(
            regression.ols(design, "y", m, covariance="cluster", cluster="location_id"), use_t=False
        ).withColumn("model", F.lit(i + 1))
        for i, m in enumerate(NESTED)
    ]
    return reshape.union_all(*fits)


@query("stat12_ols_hc3", f"""
, rr AS (SELECT 'price' AS metric, month(timestamp) AS month, location_id, any_value(region) AS region,
         any_value(elevation_m) / 1000 AS x, avg(price) AS y FROM w_at_sites GROUP BY ALL
  UNION ALL SELECT 'quantity', month(timestamp), location_id, any_value(region), any_value(elevation_m) / 1000, avg(quantity) FROM w_at_sites GROUP BY ALL)
""" + slope_sql("rr", "metric, month", "region", None))
def _(t):
    rows = site_month_long(t)
    fit = regression.ols(rows, "value", ["x"], by=["metric", "month"], absorb=["region"])
    return slope_only(regression.coefficients(fit, ["metric", "month"]), "metric", "month")


def site_month_long(t):
    means = t.w_at_sites.groupBy("location_id", "country", "region", "latitude", "longitude", "elevation_m",
                                 F.month("timestamp").alias("month")).agg(
        F.avg("price").alias("price"), F.avg("quantity").alias("quantity")
    )
    ids = ["location_id", "country", "region", "latitude", "longitude", "month", "elevation_m"]
    return reshape.to_long(means, ids, ["price", "quantity"]).withColumn("x", F.col("elevation_m") / 1000)


MONTH_ROWS_SQL = """
, mr AS (SELECT location_id, any_value(country) AS country, any_value(region) AS region, any_value(latitude) AS latitude,
         any_value(longitude) AS longitude, any_value(elevation_m) / 1000 AS x, month(timestamp) AS month, avg(price) AS price, avg(quantity) AS quantity
         FROM w_at_sites GROUP BY location_id, month(timestamp))"""
INTERVALS_SQL = MONTH_ROWS_SQL + """
, rr AS (SELECT 'price' AS metric, *, price AS y FROM mr UNION ALL SELECT 'quantity', *, quantity FROM mr)""" + ols_sql(
    "h", "rr", "metric, month", ["x", "latitude", "longitude"], None, "region"
) + ols_sql("k", "rr", "metric, month", ["x", "latitude", "longitude"], "country", "region") + f"""
, t AS (SELECT h_c.*, {t_tail_sql('(h_c.coef / h_c.standard_error)', 'h_c.df')} AS p,
        {t_tail_sql('(k_c.coef / k_c.standard_error)', 'k_c.df')} AS country_cluster_p, {t_critical_sql('h_c.df')} * h_c.standard_error AS width
        FROM h_c JOIN k_c USING (metric, month, j) WHERE j = 1)
, o AS (SELECT *, row_number() OVER (ORDER BY p, metric, month) AS i, count(*) OVER () AS m FROM t)
SELECT metric, month, 'x' AS term, n, {r('r2')} AS r2, {r('coef')} AS coef, {r('standard_error')} AS standard_error,
       {r('coef / standard_error')} AS statistic, {r('p')} AS p, {r('coef - width')} AS ci_low, {r('coef + width')} AS ci_high,
       {r('country_cluster_p')} AS country_cluster_p, {r('least(1, max((m - i + 1) * p) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))')} AS p_holm
FROM o"""


# latitudes are those of the countries here, so the regions are what can be absorbed beside them
@query("stat12_hc3_intervals", INTERVALS_SQL)
def _(t):
    by = ["metric", "month"]
    rows = materialise(site_month_long(t), "site-months")
    hc3 = regression.coefficients(
        regression.ols(rows, "value", ["x", "latitude", "longitude"], by=by, absorb=["region"]), by
    ).filter("term = 'x'")
    clustered = regression.coefficients(
        regression.ols(rows, "value", ["x", "latitude", "longitude"], by=by, absorb=["region"],
                       covariance="cluster", cluster="country"), by
    ).filter("term = 'x'").select(*by, F.col("p").alias("country_cluster_p"))
    return association.holm(hc3.join(clustered, by), "p")


def wald_sql(months: tuple[int, ...], cluster: str, number: int) -> str:
    """The test of one choice of months and clusters; ``change`` as a view of its own."""
    name, later = f"w{number}", months[1:]
    design = [f"CASE WHEN month = {m} THEN {c} ELSE 0 END" for m in later for c in ("latitude", "longitude", "x")]
    tested = [3 * i for i in range(1, len(later) + 1)]
    q = len(tested)
    views = f"""
, {name}_rows AS (SELECT 1 AS one, a.location_id, a.country, a.region, a.latitude, a.longitude, a.x, a.month, a.price - b.price AS y
          FROM mr a JOIN mr b ON a.location_id = b.location_id AND b.month = {months[0]} WHERE a.month IN ({', '.join(map(str, later))}))"""
    views += ols_sql(name, f"{name}_rows", "one", design, cluster, "(month, region)")
    places = ", ".join(map(str, tested))
    views += f"""
, {name}_t AS (SELECT one, list_position([{places}], i) AS i, list_position([{places}], j) AS j, v FROM {name}_v WHERE i IN ({places}) AND j IN ({places}))"""
    views += inverse_sql(f"{name}_x", f"{name}_t", "one", q)
    form = " + ".join(f"beta[{tested[i]}] * m[{i + 1}][{k + 1}] * beta[{tested[k]}]" for i in range(q) for k in range(q))
    return views + f"""
, {name}_w AS (SELECT ({form}) / {q} AS f, CAST({q} AS BIGINT) AS d1, g - 1 AS d2, '{','.join(map(str, months))}' AS months, '{cluster}' AS cluster
          FROM {name}_f JOIN {name}_x USING (one))"""


WALDS = [(chosen, c) for chosen in ((5, 6, 7, 8), (6, 7, 8)) for c in ("location_id", "country")]


@query("stat13_paired_change_wald", MONTH_ROWS_SQL + "".join(wald_sql(m, c, i) for i, (m, c) in enumerate(WALDS)) + f"""
, tested AS ({' UNION ALL '.join(f'SELECT * FROM w{i}_w' for i in range(len(WALDS)))})
SELECT {r('f')} AS statistic, d1 AS df_num, d2 AS df_denom, {r(f_tail_sql('f', 'd1', 'd2'))} AS p, months, cluster FROM tested""")
def _(t):
    months = materialise(
        site_month_long(t).filter("metric = 'price'").withColumn("elevation_km", F.col("x")), "site-months"
    )
    return reshape.union_all(*[
        regression.paired_change_wald(months, "value", chosen, group="region", cluster=c).withColumns(
            {"months": F.lit(",".join(map(str, chosen))), "cluster": F.lit(c)}
        )
        for chosen, c in WALDS
    ])


HOLM_SQL = """
, tests AS (SELECT location_id, any_value(region) AS region, round(avg(discount) / 10 * any_value(abs(latitude) / 12), 4) AS p
            FROM w_at_sites GROUP BY 1)"""


@query("stat14_holm", HOLM_SQL + f"""
, o AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY p, location_id) AS i, count(*) OVER (PARTITION BY region) AS m FROM tests)
SELECT location_id, region, {r('p')} AS p, {r('''least(1, max((m - i + 1) * p) OVER (PARTITION BY region ORDER BY i
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))''')} AS p_holm FROM o""")
def _(t):
    tests = t.w_at_sites.groupBy("location_id").agg(
        F.first("region").alias("region"),
        F.round(F.avg("discount") / 10 * F.first(F.abs("latitude") / 12), 4).alias("p"),
    )
    return association.holm(tests, "p", ["region"])


@query("stat15_distributions", f"""
, z AS (SELECT location_id, abs(avg(quantity) - 30) AS x FROM w GROUP BY 1)
SELECT location_id, {r('1 - 2 / pi() * atan(x)')} AS t_one, {r('1 - x / sqrt(2 + x * x)')} AS t_two,
       {r('pow(1 + 2 * x / 7, -3.5)')} AS f_two_seven, {r('exp(-x / 2)')} AS chi_two,
       {r('exp(-x / 2) * (1 + x / 2)')} AS chi_four FROM z""")
def _(t):
    z = t.w.groupBy("location_id").agg(F.abs(F.avg("quantity") - 30).alias("x"))
    return z.select(
        "location_id", dist.p_t("x", 1).alias("t_one"), dist.p_t("x", 2).alias("t_two"),
        dist.p_f("x", 2, 7).alias("f_two_seven"), dist.p_chi2("x", 2).alias("chi_two"),
        dist.p_chi2("x", 4).alias("chi_four"),
    )


@query("stat15_norm_ppf", f"""
, k AS (SELECT location_id, rank() OVER (ORDER BY elevation_m) + (count(*) OVER (PARTITION BY elevation_m) - 1) / 2 AS rk, count(*) OVER () AS n
        FROM w_sites)
SELECT location_id, {r('0.5 + rk / (2 * (n + 1))')} AS probability, {r('0.5 + rk / (2 * (n + 1))')} AS back FROM k""")
def _(t):
    n = t.w_sites.select("location_id", "elevation_m")
    ranked = ranks.avg_rank(n, "elevation_m", output="rank")
    total = n.agg(F.count(F.lit(1))).scalar()
    probability = 0.5 + F.col("rank") / (2 * (total + 1))
    score = dist.norm_ppf(probability)
    # the score is positive, so its upper tail is half of the two-sided one
    return ranked.select("location_id", probability.alias("probability"), (1 - dist.p_norm(score) / 2).alias("back"))


