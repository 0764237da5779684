"""The feature frame and training data."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.queries.windows import rolls
from checks.registry import fixed, query
from checks.sqltext import MEASURES, r
from checks.tables import CUTOFF, PANEL, SERIES
from tidepanel.plans import dataset as D
from tidepanel.plans import features as P

_CAL = f"""
0 AS hour, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(month(date) AS INTEGER) AS month,
CAST(quarter(date) AS INTEGER) AS quarter, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
{r('sin(2e0 * pi() * month(date) / 12)')} AS month_sin,
{r('cos(2e0 * pi() * month(date) / 12)')} AS month_cos,
{r('sin(2e0 * pi() * (isodow(date) - 1) / 7)')} AS dow_sin,
{r('cos(2e0 * pi() * (isodow(date) - 1) / 7)')} AS dow_cos"""
_TERMS = f"""
{r('pm2_5 / nullif(pm10, 0)')} AS pm25_pm10_ratio, {r('no2 * co')} AS no2_co_product,
{r('pm2_5 * o3')} AS primary_secondary, {r('no2 + so2')} AS no2_so2_sum"""
_LAGGED = ", ".join(f"{r(f'lag({c}, {n}) OVER (PARTITION BY city ORDER BY date)')} AS {c}_lag{n}"
                    for c in ("aqi", "pm2_5", "no2", "co") for n in (1, 2, 3, 7))
_KEEP = ", ".join(f"{r(m)} AS {m}" for m in MEASURES)


@query("feat_seasonal", f"SELECT DISTINCT date, {_CAL} FROM daily")
def _(t):
    return fixed(P.add_seasonal(t.daily.select("date").distinct(), PANEL))


@query("feat_interactions", f"SELECT city, date, {_TERMS} FROM daily")
def _(t):
    return fixed(P.add_interactions(t.daily).drop(*MEASURES))


_FRAME = f"""
SELECT city, date, {_KEEP}, {_CAL}, {_LAGGED}, {rolls(('aqi', 'pm2_5'), (3, 7, 30), 'date')},
       {_TERMS}, {r('(aqi - avg(aqi) OVER c) / CASE WHEN stddev_samp(aqi) OVER c = 0 THEN 1 ELSE stddev_samp(aqi) OVER c END', 3)} AS aqi_city_zscore
FROM daily WINDOW c AS (PARTITION BY city)"""


@query("feat_pipeline", _FRAME)
def _(t):
    out = fixed(P.feature_frame(t.daily, PANEL, zscore_digits=9), skip=("aqi_city_zscore",))
    return out.withColumn("aqi_city_zscore", F.round(F.col("aqi_city_zscore") + 1e-9, 3))


_GROUPS = {
    "temporal": ["month_sin", "month_cos", "dow_sin", "dow_cos", "day_of_week", "month", "quarter",
                 "is_weekend"],
    "lags": [f"{c}_lag{n}" for c in ("aqi", "pm2_5", "no2", "co") for n in (1, 2, 3, 7)],
    "rolling": [f"{c}_roll{n}_{s}" for c in ("aqi", "pm2_5") for n in (3, 7, 30)
                for s in ("mean", "std", "max")],
    "interactions": ["pm25_pm10_ratio", "no2_co_product", "primary_secondary", "no2_so2_sum"],
    "normalization": ["aqi_city_zscore"],
}


@query("prj_feature_groups", f"WITH frame AS ({_FRAME}) " + " UNION ALL ".join(
    f"SELECT '{g}' AS feature_group, '{c}' AS feature, count({c}) AS n FROM frame"
    for g, cs in _GROUPS.items() for c in cs))
def _(t):
    return P.feature_group_table(P.feature_frame(t.daily, PANEL), PANEL)


@query("ml_dataset", f"""
SELECT city, date, {r('aqi')} AS aqi, {r('lag(aqi, 7) OVER (PARTITION BY city ORDER BY date)')} AS aqi_lag7
FROM daily WHERE city IN ('A', 'N')""")
def _(t):
    marked = t.daily.withColumns({"is_synthetic": F.lit(False), "data_source": F.lit("ships")})
    out = D.ml_dataset(marked, PANEL, ["A", "N"])
    return fixed(out.select("city", "date", "aqi", "aqi_lag7"))


@query("split_time", f"""
SELECT city, CASE WHEN ds < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       min(ds) AS first_day, max(ds) AS last_day FROM series GROUP BY 1, 2""")
def _(t):
    return D.with_split(t.series, SERIES, CUTOFF).groupBy("city", "split").agg(
        F.count("*").alias("n"), F.min("ds").alias("first_day"), F.max("ds").alias("last_day"))


_FOLDS = """
WITH ends AS (SELECT city, min(ds) AS a, max(ds) AS b FROM series GROUP BY city),
folds AS (SELECT city, CAST(k AS INTEGER) AS fold,
                 CAST(a + CAST(365 + 180 * k AS INTEGER) AS DATE) AS train_end,
                 CAST(a + CAST(365 + 180 * k + 90 AS INTEGER) AS DATE) AS test_end
          FROM ends, range(0, 40) AS g(k) WHERE a + CAST(365 + 180 * k + 90 AS INTEGER) <= b)"""


@query("split_expanding", f"""{_FOLDS}
SELECT f.city, fold, train_end, test_end,
       CAST(count_if(s.ds < train_end) AS BIGINT) AS train_rows,
       CAST(count_if(s.ds >= train_end AND s.ds < test_end) AS BIGINT) AS test_rows
FROM folds f JOIN series s ON s.city = f.city GROUP BY ALL HAVING test_rows >= 10""")
def _(t):
    return D.expanding_folds(t.series, SERIES)


@query("fold_rows", f"""{_FOLDS},
kept AS (SELECT f.* FROM folds f JOIN series s ON s.city = f.city AND s.ds >= train_end
         AND s.ds < test_end GROUP BY ALL HAVING count(*) >= 10)
SELECT f.city, fold, CASE WHEN s.ds < train_end THEN 'train' ELSE 'test' END AS role,
       count(*) AS n, {r('avg(y)')} AS mean
FROM kept f JOIN series s ON s.city = f.city AND s.ds < test_end GROUP BY ALL""")
def _(t):
    rows = D.fold_rows(t.series, SERIES, D.expanding_folds(t.series, SERIES))
    return fixed(rows.groupBy("city", "fold", "role").agg(
        F.count("*").alias("n"), F.avg("y").alias("mean")))


_SPARSE = ("CASE WHEN day(date) % 10 = 0 THEN no2 END", "CASE WHEN day(date) % 3 = 0 THEN co END",
           "so2")
_HOLED = ("SELECT city, date, aqi, " + ", ".join(
    f"{e} AS {n}" for e, n in zip(_SPARSE, ("no2", "co", "so2"))) + " FROM daily")


def _holed(t):
    day = F.day("date")
    return t.daily.select("city", "date", "aqi", F.when(day % 10 == 0, F.col("no2")).alias("no2"),
                          F.when(day % 3 == 0, F.col("co")).alias("co"), "so2")


@query("prep_sparse_drop", " UNION ALL ".join(f"""
SELECT '{c}' AS measure, {r(f'avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END)')} AS null_frac,
       {r(f'quantile_cont({c}, 0.5)')} AS median FROM ({_HOLED}) WHERE date < DATE '{CUTOFF}'
HAVING avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END) <= 0.8""" for c in ("no2", "co", "so2")))
def _(t):
    train = D.with_split(_holed(t), PANEL, CUTOFF).where("split = 'train'")
    return fixed(D.kept_features(D.feature_stats(train, ["no2", "co", "so2"], "aqi")))


@query("prep_impute", f"""
WITH h AS ({_HOLED}), m AS (SELECT quantile_cont(co, 0.5) AS co, quantile_cont(so2, 0.5) AS so2
                            FROM h WHERE date < DATE '{CUTOFF}')
SELECT city, date, {r('h.aqi')} AS aqi, {r('coalesce(h.co, m.co)')} AS co,
       {r('coalesce(h.so2, m.so2)')} AS so2,
       CASE WHEN date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split FROM h, m""")
def _(t):
    return fixed(D.prepare(_holed(t), PANEL, ["no2", "co", "so2"], CUTOFF)[0])


@query("prep_impute_by_entity", f"""
WITH h AS ({_HOLED}), m AS (SELECT city, quantile_cont(co, 0.5) AS co, quantile_cont(so2, 0.5) AS so2
                            FROM h WHERE date < DATE '{CUTOFF}' GROUP BY city)
SELECT city, date, {r('h.aqi')} AS aqi, CAST(NULL AS DOUBLE) AS no2,
       {r('coalesce(h.co, m.co)')} AS co, {r('coalesce(h.so2, m.so2)')} AS so2,
       CASE WHEN date < DATE '{CUTOFF}' THEN 'train' ELSE 'test' END AS split
FROM h JOIN m USING (city)""")
def _(t):
    return fixed(D.impute_by_entity(_holed(t), PANEL, ["no2", "co", "so2"], CUTOFF))


@query("cv_origins", """
SELECT city, CAST(k AS INTEGER) AS fold, CAST(b - CAST(365 + 365 * k AS INTEGER) AS DATE) AS cutoff,
       CAST(b - CAST(365 * k AS INTEGER) AS DATE) AS until
FROM (SELECT city, min(ds) AS a, max(ds) AS b FROM series GROUP BY city), range(0, 20) AS g(k)
WHERE b - CAST(365 + 365 * k AS INTEGER) >= a + 1095""")
def _(t):
    return D.rolling_origins(t.series, SERIES, initial_days=1095)


@query("entity_folds", """
SELECT CAST(concat('0x', substr(md5(CAST(user_id AS VARCHAR)), 1, 8)) AS BIGINT) % 3 AS fold,
       count(DISTINCT user_id) AS entities, count(*) AS n FROM readings GROUP BY 1""")
def _(t):
    return D.entity_folds(t.readings, PANEL.with_(entity="user_id"), 3).groupBy("fold").agg(
        F.countDistinct("user_id").alias("entities"), F.count("*").alias("n"))
