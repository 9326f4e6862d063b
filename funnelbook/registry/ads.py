"""Ads: daily figures, goals, change detection, reload plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.frames import align, in_window, metric_columns, select_prefix, sum_columns
from ..operators.goals import drop_legacy, goal_sets, merge_goal_batches, pivot_goals
from ..operators.summaries import daily_summary, goal_daily, merge_slices
from ..plans.changes import (
    changed_days_ads, diagnostics, goal_deltas, new_goal_days,
)
from ..plans.reload import collapse_ranges, plan_jobs
from ..plans.windows import day_series, window_chunks
from ..sources.reports import ANALYTICS_TYPES, profile_project
from .base import ADS_END, ADS_START, query, table, view

SKIP = ("c3", "c5")
CONVERSIONS = ", ".join(
    f"CAST(COALESCE(SUM(CASE WHEN goal_id = {g} THEN conv END), 0) AS BIGINT) AS conv_{g}" for g in range(1, 8)
)


@query(
    "daily_summary",
    """SELECT client, CAST(dt AS STRING) AS dt, CAST(SUM(impressions) AS BIGINT) AS impressions,
              CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(cost) AS DOUBLE) AS cost,
              CAST(SUM(CASE WHEN regexp_matches(text_metric, '^[+-]?[0-9]+$') THEN CAST(text_metric AS BIGINT) ELSE 0 END) AS BIGINT) AS text_metric
       FROM (SELECT *, CASE WHEN slot = 'O' THEN CAST(clicks AS STRING) ELSE CAST(clicks AS STRING) || '.5' END AS text_metric FROM {ads_src}) s
       GROUP BY client, dt""",
)
def q_daily_summary(spark, sf):
    rows = view(spark, sf, "ads_src")
    text = F.col("clicks").cast("string")
    rows = rows.withColumn("text_metric", F.when(F.col("slot") == "O", text).otherwise(F.concat(text, F.lit(".5"))))
    daily = daily_summary(rows, ["impressions", "clicks", "cost", "text_metric"], ADS_START, ADS_END)
    return daily.withColumn("cost", F.col("cost").cast("double"))


@query(
    "date_window",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_shipdate AS DATE) AS STRING) AS dt FROM {lineitem}
       WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-02-28' AND DATE '2000-02-29'""",
)
def q_date_window(spark, sf):
    from datetime import date

    rows = table(spark, sf, "lineitem").where(in_window(F.col("l_shipdate"), date(1996, 2, 28), date(2000, 2, 29)))
    return rows.select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("dt"))


@query(
    "goal_daily",
    """SELECT client, CAST(dt AS STRING) AS dt, goal_id, CAST(SUM(conv) AS BIGINT) AS conversions
       FROM {ads_wh} WHERE goal_id IS NOT NULL GROUP BY client, dt, goal_id""",
)
def q_goal_daily(spark, sf):
    return goal_daily(view(spark, sf, "ads_wh"), ADS_START, ADS_END)


def _batches(spark, sf):
    """Reports of two goal batches with the same keys and base metrics, in wide form."""
    keys = ["client", "dt", "network"]
    base = view(spark, sf, "ads_src").groupBy(*keys).agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"))
    low = pivot_goals(view(spark, sf, "ads_src"), keys, "conv", [1, 2, 3], "conv_")
    high = pivot_goals(view(spark, sf, "ads_src").where("goal_id > 3"), keys, "conv", [4, 5, 6, 7], "conv_")
    return base.join(low, keys), base.join(high, keys), keys


@query(
    "goal_batch_merge",
    f"""SELECT client, CAST(dt AS STRING) AS dt, network, CAST(SUM(impressions) AS BIGINT) AS impressions,
               CAST(SUM(clicks) AS BIGINT) AS clicks, {CONVERSIONS}
        FROM {{ads_src}} GROUP BY client, dt, network""",
)
def q_goal_batch_merge(spark, sf):
    low, high, keys = _batches(spark, sf)
    return merge_goal_batches([low, high], keys, ["impressions", "clicks"])


@query(
    "sum_conversion",
    """SELECT client, CAST(dt AS STRING) AS dt, network, CAST(SUM(conv) AS BIGINT) AS sum_conversion
       FROM {ads_src} GROUP BY client, dt, network""",
)
def q_sum_conversion(spark, sf):
    wide = pivot_goals(view(spark, sf, "ads_src"), ["client", "dt", "network"], "conv", range(1, 8), "conv_")
    columns = [c for c in wide.columns if c.startswith("conv_")]
    return wide.select("client", "dt", "network", sum_columns(wide, columns).alias("sum_conversion"))


@query(
    "metric_slice_merge",
    """WITH a AS (SELECT client, dt, SUM(impressions) AS impressions FROM {ads_src} GROUP BY client, dt),
            b AS (SELECT client, dt, SUM(clicks) AS clicks, SUM(conv) AS conv FROM {ads_wh} GROUP BY client, dt)
       SELECT COALESCE(a.client, b.client) AS client, CAST(COALESCE(a.dt, b.dt) AS STRING) AS dt,
              CAST(COALESCE(impressions, 0) AS BIGINT) AS impressions, CAST(COALESCE(clicks, 0) AS BIGINT) AS clicks,
              CAST(COALESCE(conv, 0) AS BIGINT) AS conv
       FROM a FULL OUTER JOIN b ON a.client = b.client AND a.dt = b.dt""",
)
def q_metric_slice_merge(spark, sf):
    a = daily_summary(view(spark, sf, "ads_src"), ["impressions"], ADS_START, ADS_END)
    b = daily_summary(view(spark, sf, "ads_wh"), ["clicks", "conv"], ADS_START, ADS_END)
    return merge_slices([a, b])


@query(
    "profile_project",
    """SELECT client, CAST(dt AS STRING) AS "Date", CAST(campaign_id AS STRING) AS "CampaignName", clicks AS "Clicks",
              CAST(cost AS DOUBLE) AS "Cost", impressions AS "Impressions", network AS "AdNetworkType" FROM {ads_src}""",
)
def q_profile_project(spark, sf):
    rows = view(spark, sf, "ads_src")
    report = rows.select(
        "client", F.col("dt").alias("Date"), F.col("campaign_id").cast("string").alias("CampaignName"),
        F.col("slot").alias("Slot"), F.col("clicks").alias("Clicks"), F.col("cost").cast("double").alias("Cost"),
        F.col("impressions").alias("Impressions"), F.col("network").alias("AdNetworkType"), "group_id",
    )
    return profile_project(report, "light")


CHANGED_DAYS_ADS = """
    WITH s AS (SELECT client, dt, SUM(impressions) AS i, SUM(clicks) AS k, SUM(cost) AS c, SUM(conv) AS v FROM {ads_src} GROUP BY client, dt),
         w AS (SELECT client, dt, SUM(impressions) AS i, SUM(clicks) AS k, SUM(cost) AS c,
                      SUM(CASE WHEN goal_id IS NOT NULL THEN conv ELSE 0 END) AS v FROM {ads_wh} GROUP BY client, dt),
         known AS (SELECT DISTINCT client, goal_id FROM {ads_wh} WHERE goal_id IS NOT NULL),
         sg AS (SELECT client, dt, goal_id, SUM(conv) AS v FROM {ads_src} GROUP BY client, dt, goal_id),
         wg AS (SELECT client, dt, goal_id, SUM(conv) AS v FROM {ads_wh} WHERE goal_id IS NOT NULL GROUP BY client, dt, goal_id),
         g AS (SELECT COALESCE(sg.client, wg.client) AS client, COALESCE(sg.dt, wg.dt) AS dt,
                      BOOL_OR(k.goal_id IS NOT NULL AND COALESCE(sg.v, 0) <> COALESCE(wg.v, 0)) AS differs,
                      BOOL_OR(k.goal_id IS NULL AND COALESCE(sg.v, 0) > 0) AS fresh
               FROM sg FULL OUTER JOIN wg ON sg.client = wg.client AND sg.dt = wg.dt AND sg.goal_id = wg.goal_id
               LEFT JOIN known k ON k.client = COALESCE(sg.client, wg.client) AND k.goal_id = COALESCE(sg.goal_id, wg.goal_id)
               GROUP BY 1, 2),
         d AS (SELECT COALESCE(s.client, w.client) AS client, COALESCE(s.dt, w.dt) AS dt,
                      COALESCE(s.i, 0) AS si, COALESCE(s.k, 0) AS sk, COALESCE(s.c, 0) AS sc, COALESCE(s.v, 0) AS sv,
                      COALESCE(w.i, 0) AS wi, COALESCE(w.k, 0) AS wk, COALESCE(w.c, 0) AS wc, COALESCE(w.v, 0) AS wv
               FROM s FULL OUTER JOIN w ON s.client = w.client AND s.dt = w.dt),
         r AS (SELECT d.client, d.dt,
                      CASE WHEN (si + sk + sc + sv > 0) <> (wi + wk + wc + wv > 0) THEN 'presence'
                           WHEN si + sk + sc + sv > 0 AND (si <> wi OR sk <> wk OR g.differs
                                OR (ABS(sc - wc) > 500 AND d.client NOT IN ('c3', 'c5'))) THEN 'metrics'
                           WHEN g.fresh THEN 'new_goal' END AS reason
               FROM d LEFT JOIN g ON g.client = d.client AND g.dt = d.dt
               WHERE d.client IN (SELECT client FROM s)),
         days AS (SELECT client, dt, reason FROM r WHERE reason IS NOT NULL
                  UNION ALL
                  SELECT client, DATE '2001-12-31', 'forced' FROM (SELECT DISTINCT client FROM s) x
                  WHERE client NOT IN (SELECT client FROM w)
                    AND client NOT IN (SELECT client FROM r WHERE reason IS NOT NULL AND dt = DATE '2001-12-31'))"""


def _changes(spark, sf):
    return changed_days_ads(
        view(spark, sf, "ads_src"), view(spark, sf, "ads_wh"), ADS_START, ADS_END, tolerance=500, skip_cost=SKIP
    )


@query("changed_days_ads", CHANGED_DAYS_ADS + " SELECT client, CAST(dt AS STRING) AS dt, reason FROM days")
def q_changed_days_ads(spark, sf):
    return _changes(spark, sf)


RANGES = """, runs_of AS (SELECT client, dt, dt - CAST(ROW_NUMBER() OVER (PARTITION BY client ORDER BY dt) AS INT) AS island
                          FROM (SELECT DISTINCT client, dt FROM days) x),
              ranges AS (SELECT client, MIN(dt) AS start_day, MAX(dt) AS end_day FROM runs_of GROUP BY client, island)"""


@query(
    "reload_ranges",
    CHANGED_DAYS_ADS + RANGES + ' SELECT client, CAST(start_day AS STRING) AS "start", CAST(end_day AS STRING) AS "end" FROM ranges',
)
def q_reload_ranges(spark, sf):
    return collapse_ranges(_changes(spark, sf))


@query(
    "reload_plan",
    CHANGED_DAYS_ADS + RANGES + """, clients AS (SELECT 'c' || CAST(s_suppkey AS STRING) AS client,
                 's' || CAST(s_nationkey AS STRING) AS token FROM {supplier} WHERE s_acctbal > 0)
       SELECT COALESCE(r.client, c.client) AS client, c.token, CAST(start_day AS STRING) AS "start",
              CAST(end_day AS STRING) AS "end", 'analytics' AS profile,
              CASE WHEN start_day IS NULL THEN 'unchanged' WHEN c.token IS NULL THEN 'no_access' ELSE 'job' END AS status
       FROM ranges r FULL OUTER JOIN clients c ON r.client = c.client""",
)
def q_reload_plan(spark, sf):
    suppliers = table(spark, sf, "supplier").where("s_acctbal > 0")
    clients = suppliers.select(
        F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("client"),
        F.concat(F.lit("s"), F.col("s_nationkey").cast("string")).alias("token"),
    )
    return plan_jobs(_changes(spark, sf), clients, "analytics")


@query(
    "new_goal_days",
    """WITH sg AS (SELECT client, dt, goal_id, SUM(conv) AS v FROM {ads_src} GROUP BY client, dt, goal_id),
            known AS (SELECT DISTINCT client, goal_id FROM {ads_wh} WHERE goal_id IS NOT NULL),
            fresh AS (SELECT * FROM sg WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.client = sg.client AND k.goal_id = sg.goal_id))
       SELECT client, goal_id, CAST(dt AS STRING) AS dt FROM fresh WHERE v > 0
       UNION ALL
       SELECT client, goal_id, NULL FROM fresh GROUP BY client, goal_id HAVING MAX(v) <= 0""",
)
def q_new_goal_days(spark, sf):
    known = view(spark, sf, "ads_wh").where("goal_id IS NOT NULL")
    return new_goal_days(goal_daily(view(spark, sf, "ads_src"), ADS_START, ADS_END), known)


@query(
    "goal_sets",
    """WITH s AS (SELECT DISTINCT client, goal_id FROM {ads_src}),
            w AS (SELECT DISTINCT client, goal_id FROM {ads_wh} WHERE goal_id IS NOT NULL)
       SELECT client, goal_id, 'both' AS side FROM (SELECT * FROM s INTERSECT SELECT * FROM w) x
       UNION ALL SELECT client, goal_id, 'source' FROM (SELECT * FROM s EXCEPT SELECT * FROM w) x
       UNION ALL SELECT client, goal_id, 'warehouse' FROM (SELECT * FROM w EXCEPT SELECT * FROM s) x""",
)
def q_goal_sets(spark, sf):
    return goal_sets(view(spark, sf, "ads_src"), view(spark, sf, "ads_wh"))


@query(
    "goal_deltas",
    """WITH s AS (SELECT client, dt, goal_id, SUM(conv) AS v FROM {ads_src} GROUP BY client, dt, goal_id),
            w AS (SELECT client, dt, goal_id, SUM(conv) AS v FROM {ads_wh} WHERE goal_id IS NOT NULL GROUP BY client, dt, goal_id),
            d AS (SELECT COALESCE(s.client, w.client) AS client, COALESCE(s.dt, w.dt) AS dt, COALESCE(s.goal_id, w.goal_id) AS goal_id,
                         COALESCE(s.v, 0) AS sv, COALESCE(w.v, 0) AS wv
                  FROM s FULL OUTER JOIN w ON s.client = w.client AND s.dt = w.dt AND s.goal_id = w.goal_id),
            x AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY client, dt ORDER BY goal_id) AS rn, COUNT(*) OVER (PARTITION BY client, dt) AS n
                  FROM d WHERE sv <> wv)
       SELECT client, CAST(dt AS STRING) AS dt, goal_id, CAST(sv AS BIGINT) AS s_conversions, CAST(wv AS BIGINT) AS w_conversions,
              CAST(sv - wv AS BIGINT) AS delta, CAST(GREATEST(n - 15, 0) AS BIGINT) AS more FROM x WHERE rn <= 15""",
)
def q_goal_deltas(spark, sf):
    source = goal_daily(view(spark, sf, "ads_src"), ADS_START, ADS_END)
    return goal_deltas(source, goal_daily(view(spark, sf, "ads_wh"), ADS_START, ADS_END))


@query(
    "tracker_diagnostics",
    """WITH s AS (SELECT client, dt, SUM(clicks) AS v, SUM(conv) AS c FROM {ads_src} GROUP BY client, dt),
            w AS (SELECT client, dt, SUM(clicks) AS v, SUM(conv) AS c FROM {ads_wh} GROUP BY client, dt),
            a AS (SELECT client, SUM(v) AS v, SUM(c) AS c, SUM(CASE WHEN v > 0 OR c > 0 THEN 1 ELSE 0 END) AS n FROM s GROUP BY client),
            b AS (SELECT client, SUM(v) AS v, SUM(c) AS c, SUM(CASE WHEN v > 0 OR c > 0 THEN 1 ELSE 0 END) AS n FROM w GROUP BY client)
       SELECT COALESCE(a.client, b.client) AS client, CAST(COALESCE(a.v, 0) AS BIGINT) AS s_visits,
              CAST(COALESCE(a.c, 0) AS BIGINT) AS s_conversions, CAST(COALESCE(b.v, 0) AS BIGINT) AS w_visits,
              CAST(COALESCE(b.c, 0) AS BIGINT) AS w_conversions, CAST(COALESCE(a.n, 0) AS BIGINT) AS s_days,
              CAST(COALESCE(b.n, 0) AS BIGINT) AS w_days, a.client IS NULL AS s_empty, b.client IS NULL AS w_empty
       FROM a FULL OUTER JOIN b ON a.client = b.client""",
)
def q_tracker_diagnostics(spark, sf):
    def side(name):
        daily = daily_summary(view(spark, sf, name), ["clicks", "conv"], ADS_START, ADS_END)
        return daily.withColumnsRenamed({"clicks": "visits", "conv": "conversions"})

    return diagnostics(side("ads_src"), side("ads_wh"))


def _client_windows(spark, sf):
    return view(spark, sf, "ads_src").groupBy("client").agg(F.min("dt").alias("start"), F.max("dt").alias("end"))


@query(
    "day_series",
    """SELECT client, CAST(CAST(UNNEST(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS STRING) AS dt
       FROM (SELECT client, MIN(dt) AS a, MAX(dt) AS b FROM {ads_src} GROUP BY client) x""",
)
def q_day_series(spark, sf):
    return day_series(_client_windows(spark, sf))


@query(
    "window_chunks",
    """SELECT client, CAST(a + CAST(n * 5 AS INT) AS STRING) AS chunk_start,
              CAST(LEAST(a + CAST(n * 5 + 4 AS INT), b) AS STRING) AS chunk_end
       FROM (SELECT client, a, b, UNNEST(range(0, (b - a) // 5 + 1)) AS n
             FROM (SELECT client, MIN(dt) AS a, MAX(dt) AS b FROM {ads_src} GROUP BY client) x) y""",
)
def q_window_chunks(spark, sf):
    return window_chunks(_client_windows(spark, sf))


ANALYTICS = {
    "Date": "CAST(dt AS STRING)", "AdId": "campaign_id", "Slot": "slot", "AdNetworkType": "network", "Impressions": "impressions", "Clicks": "clicks",
    "Cost": "CAST(cost AS DOUBLE)", "Conversions": "conv",
}


def _analytics(spark, sf):
    return view(spark, sf, "ads_src").select(
        "client", F.col("dt").alias("Date"), F.col("campaign_id").alias("AdId"), F.col("slot").alias("Slot"), F.col("network").alias("AdNetworkType"),
        F.col("impressions").alias("Impressions"), F.col("clicks").alias("Clicks"), F.col("cost").cast("double").alias("Cost"), F.col("conv").alias("Conversions"),
        F.col("conv").alias("Conversions_1_LSC"), "group_id",
    )


@query("profile_analytics", f"SELECT client, {', '.join(f'{e} AS {chr(34)}{c}{chr(34)}' for c, e in ANALYTICS.items())}, conv AS \"Conversions_1_LSC\" FROM {{ads_src}}")
def q_profile_analytics(spark, sf):
    return profile_project(_analytics(spark, sf))


@query(
    "align_columns",
    f"""SELECT client, {', '.join(f"{ANALYTICS.get(c, 'NULL')} AS {chr(34)}{c}{chr(34)}" if c in ANALYTICS else f"'-' AS {chr(34)}{c}{chr(34)}" for c in ('Date', 'AdId', 'Slot', 'Age', 'Device', 'Clicks', 'Cost'))}
        FROM {{ads_src}}""",
)
def q_align_columns(spark, sf):
    types = {"client": "string"} | {c: ANALYTICS_TYPES[c] for c in ("Date", "AdId", "Slot", "Age", "Device", "Clicks", "Cost")}
    return align(_analytics(spark, sf), types, {"Age": "-", "Device": "-"})


@query(
    "prefix_columns",
    """SELECT client, CAST(SUM(conv) AS BIGINT) AS total, CAST(SUM(CASE WHEN goal_id IN (1, 2) THEN conv ELSE 0 END) AS BIGINT) AS some FROM {ads_src} GROUP BY client""",
)
def q_prefix_columns(spark, sf):
    wide = pivot_goals(view(spark, sf, "ads_src"), ["client"], "conv", range(1, 8), "conv_")
    low = wide.withColumnsRenamed({"conv_1": "Goal_1", "conv_2": "goal_2"})
    some = select_prefix(low, "GOAL_", ignore_case=True)
    return low.select("client", sum_columns(low, [*some, *select_prefix(low, "conv_")]).alias("total"), sum_columns(low, some).alias("some"))


@query(
    "metric_columns",
    """SELECT client, CAST(dt AS STRING) AS dt, CAST(SUM(impressions) AS BIGINT) AS "Impressions", CAST(SUM(cost) AS DOUBLE) AS "Cost",
              CAST(SUM(conv) AS BIGINT) AS "Conversions_1_LSC" FROM {ads_src} GROUP BY client, dt""",
)
def q_metric_columns(spark, sf):
    rows = _analytics(spark, sf).withColumnRenamed("Date", "dt")
    daily = daily_summary(rows, metric_columns(rows, ["impressions", "cost"], ["conversions_"]), ADS_START, ADS_END)
    return daily.withColumn("Cost", F.round("Cost", 2)).select("client", "dt", "Impressions", "Cost", "Conversions_1_LSC")


@query(
    "drop_legacy",
    """SELECT client, CAST(dt AS STRING) AS dt, CAST(SUM(CASE WHEN goal_id = 1 THEN conv ELSE 0 END) AS BIGINT) AS g_goal_1,
              CAST(SUM(CASE WHEN goal_id = 2 THEN conv ELSE 0 END) AS BIGINT) AS u_goal_2 FROM {ads_src} GROUP BY client, dt""",
)
def q_drop_legacy(spark, sf):
    wide = pivot_goals(view(spark, sf, "ads_src"), ["client", "dt"], "conv", [1, 2, 3, 4], "x_")
    old = wide.withColumnsRenamed({"x_1": "g_goal_1", "x_2": "u_goal_2", "x_3": "g_goal_3", "x_4": "goal_4"}).withColumn("sum_goal", F.lit(1))
    return drop_legacy(old, marked=[1])


@query(
    "goal_deltas_first",
    """WITH s AS (SELECT network AS client, dt, group_id % 50 AS goal_id, COUNT(*) AS v FROM {ads_src} GROUP BY 1, 2, 3),
            w AS (SELECT network AS client, dt, group_id % 50 AS goal_id, COUNT(*) AS v FROM {ads_wh} WHERE mark_a < 0.04 GROUP BY 1, 2, 3),
            d AS (SELECT s.client, s.dt, s.goal_id, s.v AS sv, COALESCE(w.v, 0) AS wv FROM s LEFT JOIN w ON s.client = w.client AND s.dt = w.dt AND s.goal_id = w.goal_id),
            x AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY client, dt ORDER BY goal_id) AS rn, COUNT(*) OVER (PARTITION BY client, dt) AS n FROM d WHERE sv <> wv)
       SELECT client, CAST(dt AS STRING) AS dt, goal_id, sv AS s_conversions, wv AS w_conversions, sv - wv AS delta, GREATEST(n - 2, 0) AS more FROM x WHERE rn <= 2""",
)
def q_goal_deltas_first(spark, sf):
    """As ``goal_deltas`` with networks in the place of clients and a limit that days reach."""

    def side(name, where):
        rows = view(spark, sf, name).where(where).select(F.col("network").alias("client"), "dt", (F.col("group_id") % 50).alias("goal_id"), F.lit(1).alias("conv"))
        return goal_daily(rows, ADS_START, ADS_END)

    return goal_deltas(side("ads_src", "true"), side("ads_wh", "mark_a < 0.04"), limit=2)
