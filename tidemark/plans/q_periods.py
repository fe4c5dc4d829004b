"""Registered queries: period operators on ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.periods import (
    PERIOD_KEYS,
    aggregate_periods,
    fill_nulls,
    max_scale,
    period_change,
    period_spread,
    period_volume,
    volume_change,
)
from tidemark.plans.registry import query
from tidemark.sources.adapters import event_posts

R = 6  # decimals compared against the oracle

# Oracle building blocks (DuckDB): events as posts.
_EV_TYPE_HOUR = """
posts AS (
  SELECT event_type AS match_id,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 3600000000 AS period_id,
         event_type || ':' || CAST((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 3600000000 AS VARCHAR) AS id,
         event_id AS post_id, value
  FROM events)"""

_EV_USER_DAY = """
posts AS (
  SELECT CAST(user_id AS VARCHAR) AS match_id,
         (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 86400000000 AS period_id,
         CAST(user_id AS VARCHAR) || ':' || CAST((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 86400000000 AS VARCHAR) AS id,
         event_id AS post_id, value
  FROM events)"""

_VOLUME = """
vol AS (SELECT match_id, period_id, id, count(*) AS n_posts FROM posts GROUP BY ALL)"""

# Row-level form of the volume change: every post carries its period size,
# differenced two posts back inside the match, then averaged per period.
_ROW_LAG = """
sized AS (SELECT *, count(*) OVER (PARTITION BY match_id, period_id, id) AS tn FROM posts),
lagged AS (
  SELECT *, lag(tn, 2) OVER (PARTITION BY match_id ORDER BY period_id, id, post_id) AS tn2 FROM sized),
rowlag AS (
  SELECT match_id, period_id, id, count(*) AS n_posts,
         avg(CASE WHEN tn2 IS NULL THEN 0 ELSE tn - tn2 END) AS volume_change,
         max(abs(CASE WHEN tn2 IS NULL THEN 0 ELSE tn - tn2 END)) AS absmax
  FROM lagged GROUP BY ALL)"""


def _keys():
    return [F.col(k) for k in PERIOD_KEYS]


@query("period_volume", sql=f"WITH {_EV_TYPE_HOUR}, {_VOLUME} SELECT * FROM vol")
def q_period_volume(spark, sf_dir):
    return period_volume(event_posts(spark, sf_dir))


@query("period_mean", sql=f"""WITH {_EV_TYPE_HOUR}
SELECT match_id, period_id, id, count(*) AS n_posts, round(avg(value), {R}) AS value
FROM posts GROUP BY ALL""")
def q_period_mean(spark, sf_dir):
    p = aggregate_periods(event_posts(spark, sf_dir), scalar_cols=["value"], label_col=None)
    return p.select(*_keys(), "n_posts", F.round("value", R).alias("value"))


@query("period_spread", sql=f"""WITH {_EV_TYPE_HOUR}
SELECT match_id, period_id, id, count(*) AS n_posts, round(stddev_samp(value), {R}) AS std_value
FROM posts GROUP BY ALL""")
def q_period_spread(spark, sf_dir):
    p = period_spread(event_posts(spark, sf_dir), "value")
    return p.select(*_keys(), "n_posts", F.round("std_value", R).alias("std_value"))


@query("period_spread_user_day", sql=f"""WITH {_EV_USER_DAY}
SELECT match_id, period_id, id, count(*) AS n_posts, round(stddev_samp(value), {R}) AS std_value
FROM posts GROUP BY ALL""")
def q_period_spread_user_day(spark, sf_dir):
    p = period_spread(event_posts(spark, sf_dir, "user_day"), "value")
    return p.select(*_keys(), "n_posts", F.round("std_value", R).alias("std_value"))


@query("period_change_lags", sql=f"""WITH {_EV_TYPE_HOUR}, {_VOLUME}
SELECT match_id, period_id, id, n_posts,
  coalesce(n_posts - lag(n_posts, 1) OVER w, 0) AS n_posts_before1,
  coalesce(n_posts - lag(n_posts, 2) OVER w, 0) AS n_posts_before2,
  coalesce(n_posts - lag(n_posts, 3) OVER w, 0) AS n_posts_before3,
  coalesce(n_posts - lead(n_posts, 1) OVER w, 0) AS n_posts_after1
FROM vol WINDOW w AS (PARTITION BY match_id ORDER BY period_id, id)""")
def q_period_change_lags(spark, sf_dir):
    return period_change(period_volume(event_posts(spark, sf_dir)), "n_posts")


@query("volume_change_row_lag", sql=f"""WITH {_EV_TYPE_HOUR}, {_ROW_LAG}
SELECT match_id, period_id, id, n_posts, round(volume_change, {R}) AS volume_change FROM rowlag""")
def q_volume_change_row_lag(spark, sf_dir):
    v = volume_change(period_volume(event_posts(spark, sf_dir)))
    return v.select(*_keys(), "n_posts", F.round("volume_change", R).alias("volume_change"))


@query("volume_change_row_lag_user_day", sql=f"""WITH {_EV_USER_DAY}, {_ROW_LAG}
SELECT match_id, period_id, id, n_posts, round(volume_change, {R}) AS volume_change FROM rowlag""")
def q_volume_change_row_lag_user_day(spark, sf_dir):
    v = volume_change(period_volume(event_posts(spark, sf_dir, "user_day")))
    return v.select(*_keys(), "n_posts", F.round("volume_change", R).alias("volume_change"))


@query("volume_change_period_lag", sql=f"""WITH {_EV_TYPE_HOUR}, {_VOLUME}
SELECT match_id, period_id, id, n_posts,
  CAST(coalesce(n_posts - lag(n_posts, 2) OVER (PARTITION BY match_id ORDER BY period_id, id), 0) AS DOUBLE)
    AS volume_change
FROM vol""")
def q_volume_change_period_lag(spark, sf_dir):
    v = volume_change(period_volume(event_posts(spark, sf_dir)), mode="period_lag")
    return v.select(*_keys(), "n_posts", "volume_change")


@query("volume_change_scaled", sql=f"""WITH {_EV_TYPE_HOUR}, {_ROW_LAG}
SELECT match_id, period_id, id, n_posts,
  round(volume_change / nullif((SELECT max(absmax) FROM rowlag), 0), {R}) AS volume_change_scaled
FROM rowlag""")
def q_volume_change_scaled(spark, sf_dir):
    v = volume_change(period_volume(event_posts(spark, sf_dir)))
    v = max_scale(v, "volume_change", norm_col="volume_change_absmax",
                  out_col="volume_change_scaled")
    return v.select(*_keys(), "n_posts",
                    F.round("volume_change_scaled", R).alias("volume_change_scaled"))


@query("max_scale_global", sql=f"""WITH {_EV_TYPE_HOUR}, {_VOLUME}
SELECT match_id, period_id, id, n_posts,
  round(n_posts / nullif((SELECT max(n_posts) FROM vol), 0), {R}) AS n_posts_scaled
FROM vol""")
def q_max_scale_global(spark, sf_dir):
    v = max_scale(period_volume(event_posts(spark, sf_dir)), "n_posts", out_col="n_posts_scaled")
    return v.select(*_keys(), "n_posts", F.round("n_posts_scaled", R).alias("n_posts_scaled"))


@query("max_scale_by_group", sql=f"""WITH {_EV_TYPE_HOUR}
SELECT match_id, period_id, id, post_id,
  round(value / nullif(max(abs(value)) OVER (PARTITION BY match_id), 0), {R}) AS value_scaled
FROM posts""")
def q_max_scale_by_group(spark, sf_dir):
    p = max_scale(event_posts(spark, sf_dir), "value", by="match_id", absolute=True,
                  out_col="value_scaled")
    return p.select(*_keys(), "post_id", F.round("value_scaled", R).alias("value_scaled"))


@query("period_features_filled", sql=f"""WITH {_EV_USER_DAY}
SELECT match_id, period_id, id, count(*) AS n_posts,
  round(avg(value), {R}) AS value,
  round(coalesce(stddev_samp(value), 0), {R}) AS std_value
FROM posts GROUP BY ALL""")
def q_period_features_filled(spark, sf_dir):
    p = aggregate_periods(event_posts(spark, sf_dir, "user_day"), scalar_cols=["value"],
                          spread_cols=["value"], label_col=None)
    p = fill_nulls(p, ["std_value"])
    return p.select(*_keys(), "n_posts", F.round("value", R).alias("value"),
                    F.round("std_value", R).alias("std_value"))


@query("volume_change_row_lag_index", sql=f"""WITH {_EV_TYPE_HOUR}, {_ROW_LAG}
SELECT match_id, period_id, id, n_posts, round(volume_change, {R}) AS volume_change FROM rowlag""",
       note="matches cut over 24 range partitions, with a halo of neighbours")
def q_volume_change_row_lag_index(spark, sf_dir):
    v = volume_change(period_volume(event_posts(spark, sf_dir)), partitions=24)
    return v.select(*_keys(), "n_posts", F.round("volume_change", R).alias("volume_change"))
