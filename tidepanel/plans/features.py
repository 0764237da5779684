"""The feature frame: calendar, lag, rolling, interaction and relative columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import scalars as S
from tidepanel.operators import filters
from tidepanel.operators import windows as W
from tidepanel.panel import PanelSpec, over_rows, present


def seasonal_features(time: str) -> dict[str, Column]:
    """Nine calendar columns."""
    p = S.calendar_parts(time)
    month_sin, month_cos = S.cyclical(p["month"], 12)
    dow_sin, dow_cos = S.cyclical(p["day_of_week"], 7)
    return {"hour": p["hour"], "day_of_week": p["day_of_week"], "month": p["month"],
            "quarter": p["quarter"], "is_weekend": S.is_weekend(time), "month_sin": month_sin,
            "month_cos": month_cos, "dow_sin": dow_sin, "dow_cos": dow_cos}


def interaction_features(df: DataFrame) -> dict[str, Column]:
    """Up to four measure combinations, those whose inputs the frame has."""
    every = {
        "pm25_pm10_ratio": (("pm2_5", "pm10"), S.ratio_safe),
        "no2_co_product": (("no2", "co"), lambda a, b: F.col(a) * F.col(b)),
        "primary_secondary": (("pm2_5", "o3"), lambda a, b: F.col(a) * F.col(b)),
        "no2_so2_sum": (("no2", "so2"), lambda a, b: F.col(a) + F.col(b)),
    }
    have = set(df.columns)
    return {n: f(*cs) for n, (cs, f) in every.items() if have.issuperset(cs)}


def feature_groups(df: DataFrame, spec: PanelSpec) -> dict[str, list[str]]:
    """Names of the frame's feature columns, by the builder that adds them. The hour is no
    feature of a daily panel."""
    target = spec.target
    built = {
        "temporal": [c for c in seasonal_features(spec.time) if c != "hour"],
        "lags": [W.lag_name(c, n) for c in _lagged(df, target) for n in W.LAGS],
        "rolling": [W.roll_name(c, n, s) for c in _rolled(df, target) for n in W.ROLL_WIDTHS
                    for s in W.ROLL_STATS],
        "interactions": list(interaction_features(df)),
        "normalization": [W.zscore_name(target, spec.entity)],
    }
    return {group: present(df, names) for group, names in built.items()}


def feature_group_table(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """(group, feature) rows of ``feature_groups`` with the non-null count of each feature."""
    pairs = [(g, c) for g, cs in feature_groups(df, spec).items() for c in cs]
    counts = df.agg(*[F.count(c).alias(c) for _, c in pairs])
    rows = [F.struct(F.lit(g).alias("feature_group"), F.lit(c).alias("feature"),
                     F.col(c).alias("n")) for g, c in pairs]
    return counts.select(F.inline(F.array(*rows)))


def _lagged(df: DataFrame, target: str) -> list[str]:
    return present(df, dict.fromkeys([target, "pm2_5", "no2", "co"]))


def _rolled(df: DataFrame, target: str) -> list[str]:
    return present(df, dict.fromkeys([target, "pm2_5"]))


def add_seasonal(df: DataFrame, spec: PanelSpec) -> DataFrame:
    time = "datetime" if "datetime" in df.columns else spec.time
    return df.withColumns(seasonal_features(time))


def add_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(interaction_features(df))


def feature_frame(df: DataFrame, spec: PanelSpec, lags: bool = True, rolling: bool = True,
                  seasonal: bool = True, interactions: bool = True, normalization: bool = True,
                  leak_free: bool = False, train_until: str | None = None,
                  zscore_digits: int = 3) -> DataFrame:
    """All feature groups; every row is kept.

    Lags and rolling columns share one window, hence one exchange and one sort.
    ``leak_free`` ends rolling frames before the current row and takes the z-score from
    rows before ``train_until``, so no feature holds the row's own target.
    """
    t = spec.target
    if seasonal:
        df = add_seasonal(df, spec)
    lagged, rolled = _lagged(df, t), _rolled(df, t)
    skip = int(leak_free)

    def build(w):
        out = W.lag_columns(w, lagged, W.LAGS) if lags else {}
        return out | (W.rolling_columns(w, rolled, W.ROLL_WIDTHS, skip) if rolling else {})

    if lags or rolling:
        df = over_rows(df, spec, max(W.ROLL_WIDTHS) - 1 + skip, 0, build)
    if interactions:
        df = add_interactions(df)
    if normalization:
        fit = filters.before(df, spec.time, train_until) if train_until else None
        df = W.add_zscore(df, spec, t, zscore_digits, fit)
        if leak_free:
            df = _lagged_zscore(df, spec)
    return df


def _lagged_zscore(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The previous row's z-score in place of the row's own, which restates the target."""
    z = W.zscore_name(spec.target, spec.entity)
    return over_rows(df, spec, 1, 0, lambda w: {z: F.lag(z, 1).over(w)})
