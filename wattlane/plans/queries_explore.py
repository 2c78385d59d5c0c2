"""Queries on exploratory statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.operators import cleaning, drift, explore
from wattlane.plans import views
from wattlane.plans.catalog import emit, oracle, query
from wattlane.plans.views import ENERGY, HOURLY, HOURLY_WEATHER, ONE, RAW, SERIES

_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "AGG4",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS field, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, min({c}) AS min,
  quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, max({c}) AS max
FROM lineitem"""
            for c in _NUMBERS
        ),
        "mean std min q25 q50 q75 max", "count",
    ),
)
def describe_columns(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.describe(views.table(spark, folder, "lineitem"), list(_NUMBERS)))


@query(
    "AGG5",
    oracle(
        f"""WITH {ENERGY}
""" + " UNION ALL ".join(
            f"SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM energy"
            for c in ("total_load_actual", "total_load_forecast", "generation_solar", "price_actual")
        ),
        ints="nulls",
    ),
)
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["total_load_actual", "total_load_forecast", "generation_solar", "price_actual"]
    return emit(explore.null_counts(views.energy(spark, folder), columns))


@query(
    "AGG6",
    oracle(
        f"""WITH {ENERGY}
SELECT count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts, avg(total_load_actual) AS avg_load,
       max(total_load_actual) AS peak_load, count(*) FILTER (WHERE total_load_actual IS NULL) AS missing FROM energy""",
        "avg_load peak_load", "records missing",
    ),
)
def data_overview(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.overview(views.energy(spark, folder), "ts", "total_load_actual"))


_PAIRWISE = ("total_load_actual", "total_load_forecast", "price_actual", "generation_solar", "temp", "humidity")


@query(
    "AGG7",
    oracle(
        f"""WITH {HOURLY_WEATHER}
""" + " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM merged" for a in _PAIRWISE for b in _PAIRWISE
        ),
        "corr",
    ),
)
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.correlations(views.hourly_weather(spark, folder), list(_PAIRWISE)))


@query(
    "AGG8",
    oracle(
        """WITH ends_of AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
cells AS (
  SELECT least(19, CAST(floor((l_extendedprice - lo) / ((hi - lo) / 20)) AS BIGINT)) AS bin, lo, hi FROM lineitem, ends_of)
SELECT bin, count(*) AS count, lo + bin * ((hi - lo) / 20) AS left_edge FROM cells GROUP BY bin, lo, hi""",
        "left_edge", "bin count",
    ),
)
def value_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.histogram(views.table(spark, folder, "lineitem"), "l_extendedprice", 20))


_BOXED = ("total_load_actual", "generation_solar", "price_actual")


@query(
    "AGG9 SET2",
    oracle(
        f"""WITH {ENERGY},
long AS (
  {' UNION ALL '.join(f"SELECT '{c}' AS variable, {c} AS value FROM energy" for c in _BOXED)}),
q AS (
  SELECT variable, quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75
  FROM long WHERE value IS NOT NULL GROUP BY 1),
judged AS (
  SELECT l.variable, value, q25, q50, q75, value BETWEEN q25 - 1.5::DOUBLE * (q75 - q25) AND q75 + 1.5::DOUBLE * (q75 - q25) AS inside
  FROM long l JOIN q ON l.variable = q.variable WHERE value IS NOT NULL)
SELECT variable, q25, q50, q75, min(value) FILTER (WHERE inside) AS whisker_low,
       max(value) FILTER (WHERE inside) AS whisker_high, count(*) FILTER (WHERE NOT inside) AS outliers
FROM judged GROUP BY 1, 2, 3, 4""",
        "q25 q50 q75 whisker_low whisker_high", "outliers",
    ),
)
def box_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.box_stats(views.energy(spark, folder), list(_BOXED)))


@query(
    "SET2",
    oracle(
        """SELECT l_orderkey, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
UNION ALL SELECT l_orderkey, 'l_discount', l_discount FROM lineitem""",
        "value", "l_orderkey",
    ),
)
def wide_to_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.table(spark, folder, "lineitem")
    return emit(explore.melt(rows, ["l_quantity", "l_discount"], ["l_orderkey"]))


def _acf_sql(lags: int) -> str:
    return f"""{HOURLY},
known AS (SELECT series, load, row_number() OVER (PARTITION BY series ORDER BY ts) AS i FROM hourly WHERE load IS NOT NULL),
centred AS (SELECT series, i, load - avg(load) OVER (PARTITION BY series) AS z FROM known),
total AS (SELECT series, count(*) AS n, sum(z * z) AS s FROM centred GROUP BY 1),
shares AS (
  SELECT a.series, k AS lag, coalesce(sum(a.z * b.z), 0) AS c
  FROM centred a CROSS JOIN generate_series(0, {lags}) AS g(k)
  LEFT JOIN centred b ON a.series = b.series AND b.i = a.i - k GROUP BY 1, 2),
acf AS (SELECT s.series, s.lag, t.n, s.c / t.s AS acf FROM shares s JOIN total t ON s.series = t.series)"""


def _known_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Hours with a load, numbered without the gaps."""
    from wattlane.operators.ordering import reposition

    return reposition(views.hourly(spark, folder).filter(F.col("load").isNotNull()), SERIES)


@query("AGG26", oracle(f"WITH {_acf_sql(50)} SELECT series, lag, acf FROM acf", "acf", "lag"))
def autocorrelation(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.autocorrelation_table(_known_hours(spark, folder), SERIES, "load", 50))


@query("AGG27")
def partial_autocorrelation(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.partial_autocorrelation(_known_hours(spark, folder), SERIES, "load", 50))


@query(
    "AGG28",
    oracle(
        f"""WITH {HOURLY_WEATHER},
lagged AS (
  SELECT total_load_actual, {', '.join(f"lag({c}, {k}) OVER (ORDER BY ts) AS {c}_{k}" for c in ('temp', 'humidity') for k in range(25))}
  FROM merged),
r AS (
  {' UNION ALL '.join(
      f"SELECT '{c}' AS variable, {k} AS lag, corr(total_load_actual, {c}_{k}) AS corr FROM lagged"
      for c in ('temp', 'humidity') for k in range(25))}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY abs(round(corr, 9)) DESC, lag) AS nth FROM r)
SELECT variable, lag AS best_lag, corr FROM ranked WHERE nth = 1""",
        "corr", "best_lag",
    ),
)
def best_weather_lag(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.hourly_weather(spark, folder)
    found = None
    for c in ("temp", "humidity"):
        scan = explore.lag_correlations(rows, ONE, "total_load_actual", c, 24)
        one = explore.best_lag(scan, decimals=9).select(F.lit(c).alias("variable"), "best_lag", "corr")
        found = one if found is None else found.unionByName(one)
    return emit(found)


@query("AGG29")
def unit_root_test(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.unit_root_test(_known_hours(spark, folder), SERIES, "load"))


@query(
    "AGG30",
    oracle(
        f"""WITH {_acf_sql(10)},
q AS (SELECT series, max(n) AS n, max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)) AS q_stat FROM acf WHERE lag > 0 GROUP BY 1),
p AS (
  SELECT *, exp(-q_stat / 2) * (1 + q_stat / 2 + pow(q_stat / 2, 2) / 2 + pow(q_stat / 2, 3) / 6 + pow(q_stat / 2, 4) / 24) AS p_value
  FROM q)
SELECT *, p_value > 0.05 AS white_noise FROM p""",
        "q_stat p_value", "n",
    ),
)
def white_noise_test(spark: SparkSession, folder: str) -> DataFrame:
    return emit(explore.ljung_box(_known_hours(spark, folder), SERIES, "load", 10))


@query(
    "WIN11",
    oracle(
        f"""WITH {HOURLY},
filled AS (SELECT series, ts, pos, coalesce(load, (SELECT avg(load) FROM hourly)) AS load FROM hourly),
smooth AS (
  SELECT *, CASE WHEN count(load) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25 THEN
    (sum(load) OVER (PARTITION BY series ORDER BY ts ROWS BETWEEN 11 PRECEDING AND 11 FOLLOWING)
     + (lag(load, 12) OVER (PARTITION BY series ORDER BY ts) + lead(load, 12) OVER (PARTITION BY series ORDER BY ts)) / 2) / 24 END AS trend
  FROM filled),
phases AS (SELECT series, pos % 24 AS phase, avg(load - trend) AS raw FROM smooth GROUP BY 1, 2),
levels AS (SELECT series, avg(raw) AS level FROM phases GROUP BY 1)
SELECT s.series, s.ts, s.trend, p.raw - l.level AS seasonal, s.load - s.trend - (p.raw - l.level) AS resid
FROM smooth s JOIN phases p ON s.series = p.series AND s.pos % 24 = p.phase JOIN levels l ON s.series = l.series""",
        "trend seasonal resid",
    ),
)
def seasonal_decomposition(spark: SparkSession, folder: str) -> DataFrame:
    rows = cleaning.impute(views.hourly(spark, folder).select("series", "ts", "pos", "load"), ["load"])
    return emit(explore.decompose(rows, SERIES, "load", 24), "series", "ts", "trend", "seasonal", "resid")


@query(
    "AGG19 AGG5",
    oracle(
        f"""WITH {ENERGY}, cells AS (
""" + " UNION ALL ".join(
            f"SELECT '{c}' AS field, count(*) FILTER (WHERE {c} IS NULL) AS missing, count(*) AS n FROM energy"
            for c in ("total_load_actual", "total_load_forecast", "price_actual", "ts")
        ) + """)
SELECT field, missing, missing / n AS share FROM cells""",
        "share", "missing",
    ),
)
def missing_shares(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["total_load_actual", "total_load_forecast", "price_actual", "ts"]
    return emit(drift.missing_shares(views.energy(spark, folder), columns))
