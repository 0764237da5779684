"""SQL fragments shared by the oracle statements."""

from __future__ import annotations


def r(expr: str, digits: int = 4) -> str:
    """The counterpart of ``registry.fixed``; adding zero turns -0.0 into 0.0."""
    return f"(round(({expr}) + 1e-9, {digits}) + 0e0)"


def pm25(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 30 THEN 0e0 + ({x} - 0e0) * 1.67e0 "
            f"WHEN {x} <= 60 THEN 50e0 + ({x} - 30e0) * 1.67e0 "
            f"WHEN {x} <= 90 THEN 100e0 + ({x} - 60e0) * 3.33e0 "
            f"WHEN {x} <= 120 THEN 200e0 + ({x} - 90e0) * 3.33e0 "
            f"WHEN {x} <= 250 THEN 300e0 + ({x} - 120e0) * 0.77e0 "
            f"ELSE least(400e0 + ({x} - 250e0) * 0.4e0, 500e0) END")


def level(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 50 THEN 'Good' "
            f"WHEN {x} <= 100 THEN 'Satisfactory' WHEN {x} <= 200 THEN 'Moderate' "
            f"WHEN {x} <= 300 THEN 'Poor' WHEN {x} <= 400 THEN 'Very Poor' ELSE 'Severe' END")


def four_seasons(m: str) -> str:
    return (f"CASE WHEN {m} IN (12,1,2) THEN 'Winter' WHEN {m} IN (3,4,5) THEN 'Spring' "
            f"WHEN {m} IN (6,7,8) THEN 'Summer' ELSE 'Monsoon' END")


def error_seasons(m: str) -> str:
    return (f"CASE WHEN {m} IN (12,1,2) THEN 'Winter (Dec-Feb)' "
            f"WHEN {m} IN (3,4,5) THEN 'Spring (Mar-May)' "
            f"WHEN {m} IN (6,7,8,9) THEN 'Summer/Monsoon (Jun-Sep)' ELSE 'Autumn (Oct-Nov)' END")


def band(y: str) -> str:
    return (f"CASE WHEN {y} <= 50 THEN 'Good (0-50)' WHEN {y} <= 100 THEN 'Satisfactory (51-100)' "
            f"WHEN {y} <= 200 THEN 'Moderate (101-200)' WHEN {y} <= 300 THEN 'Poor (201-300)' "
            f"ELSE 'Very Poor (300+)' END")


def quality(m: str) -> str:
    return (f"CASE WHEN {m} < 15 THEN 'Excellent' WHEN {m} < 20 THEN 'Good' "
            f"WHEN {m} < 30 THEN 'Moderate' ELSE 'Poor' END")


MAPE = "avg(abs((y - yhat) / nullif(y, 0))) * 100"
RMSE = "sqrt(avg((y - yhat) * (y - yhat)))"
MAE = "avg(abs(y - yhat))"

MEASURES = ("pm2_5", "pm10", "no2", "co", "so2", "o3", "aqi")

_AQI = "(l_extendedprice / 200e0)"

CTES = {
    # Readings per shipped line: three entities, so each holds a third of all rows.
    "lines": f"""
SELECT l_returnflag AS city, l_shipdate AS date, {_AQI} AS aqi,
       l_quantity AS pm2_5, l_quantity + 1000e0 * l_tax AS pm10,
       100e0 * nullif(l_discount, 0) AS no2, 100e0 * nullif(l_tax, 0) AS co,
       l_extendedprice / 1000e0 AS so2, CAST(l_linenumber AS DOUBLE) AS o3,
       CASE WHEN l_discount = 0 THEN NULL WHEN l_linenumber = 7 THEN {level(f"({_AQI} + 100e0)")}
            ELSE {level(_AQI)} END AS aqi_bucket,
       l_suppkey % 4 = 0 AS is_synthetic, concat('source', l_suppkey % 4) AS data_source,
       l_shipdate AS ingested_at, l_suppkey AS station_id
FROM lineitem""",
    "daily": "SELECT city, CAST(date AS DATE) AS date, " + ", ".join(
        f"{r(f'avg({m})', 6)} AS {m}" for m in MEASURES) + " FROM lines GROUP BY 1, 2",
    # One series per order priority.
    "series": f"""
SELECT o_orderpriority AS city, CAST(o_orderdate AS DATE) AS ds,
       {r("avg(o_totalprice / 1000e0)", 6)} AS y
FROM orders GROUP BY 1, 2""",
    # Irregular readings per event type.
    "readings": f"""
SELECT event_type AS city, ts AS datetime, event_id, user_id, value AS pm2_5,
       {pm25("value")} AS aqi, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events""",
    # Hourly means of the events.
    "hourly": f"""
SELECT city, date_trunc('hour', datetime) AS datetime, {r("avg(pm2_5)", 6)} AS pm2_5,
       {r("avg(aqi)", 6)} AS aqi FROM readings GROUP BY 1, 2""",
    # One-step predictions with their actual values.
    "ma": """
SELECT city, 'Moving Average' AS model, ds, y,
       CASE WHEN n = 7 THEN m END AS yhat
FROM (SELECT *, avg(y) OVER w AS m, count(y) OVER w AS n FROM series
      WINDOW w AS (PARTITION BY city ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
WHERE ds >= DATE '2000-01-01'""",
    "naive": """
SELECT city, 'Seasonal Naive' AS model, ds, y, yhat
FROM (SELECT *, lag(y, 365) OVER (PARTITION BY city ORDER BY ds) AS yhat FROM series)
WHERE ds >= DATE '2000-01-01'""",
    "preds": "SELECT * FROM ma UNION ALL SELECT * FROM naive",
    "metrics": f"""
SELECT city, model, {MAPE} AS mape, {RMSE} AS rmse, {MAE} AS mae, count(*) AS n_test
FROM preds GROUP BY city, model""",
}
