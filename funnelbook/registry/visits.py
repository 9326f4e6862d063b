"""Visits: daily figures, goal lists, change detection, shaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.nested import list_of_longs, list_of_strings
from ..operators.goals import drop_goals, goal_dimension, goal_flags, goal_hits, goal_list_daily, stale_goals
from ..operators.summaries import daily_visits, day_goal_detail, day_snapshot, goal_daily
from ..operators.visits import collapse_visits, dedup_visits, enrich_visits, shape_visits, unmatched_visits
from ..plans.changes import changed_days_visits
from ..plans.warehouse import Warehouse
from ..session import shared_dir
from ..sources.reports import read_visit_parts
from .base import VISITS_END, VISITS_START, query, view

KEYS = ["client", "visit_id"]


def _stored(spark, sf, name):
    """Visit rows with the columns a stored visit table has."""
    return view(spark, sf, name).withColumns(
        {"visits": F.lit(1), "u_sum_goal": F.when(F.col("goal_id").isNotNull(), 1).otherwise(0), "conv": F.lit(1)}
    )


def _daily(spark, sf, name):
    return daily_visits(_stored(spark, sf, name), VISITS_START, VISITS_END)


def _goals(spark, sf, name):
    return goal_daily(_stored(spark, sf, name), VISITS_START, VISITS_END)


@query(
    "daily_visits",
    """SELECT client, CAST(dt AS STRING) AS dt, COUNT(*) AS visits, COUNT(goal_id) AS conversions FROM {vis_wh} GROUP BY client, dt""",
)
def q_daily_visits(spark, sf):
    return _daily(spark, sf, "vis_wh")


@query(
    "changed_days_visits",
    """WITH s AS (SELECT client, dt, COUNT(*) AS v, COUNT(goal_id) AS c FROM {vis_src} GROUP BY client, dt),
            w AS (SELECT client, dt, COUNT(*) AS v, COUNT(goal_id) AS c FROM {vis_wh} GROUP BY client, dt),
            listed AS (SELECT DISTINCT client, goal_id FROM {vis_src} WHERE goal_id IS NOT NULL),
            known AS (SELECT DISTINCT client, goal_id FROM {vis_wh} WHERE goal_id IS NOT NULL),
            missing AS (SELECT DISTINCT client FROM (SELECT * FROM known EXCEPT SELECT * FROM listed) x),
            sg AS (SELECT v.client, v.dt, SUM(CASE WHEN k.goal_id IS NOT NULL THEN 1 ELSE 0 END) AS kn,
                          SUM(CASE WHEN k.goal_id IS NULL THEN 1 ELSE 0 END) AS fresh
                   FROM {vis_src} v LEFT JOIN known k ON k.client = v.client AND k.goal_id = v.goal_id
                   WHERE v.goal_id IS NOT NULL GROUP BY v.client, v.dt),
            d AS (SELECT COALESCE(s.client, w.client) AS client, COALESCE(s.dt, w.dt) AS dt, COALESCE(s.v, 0) AS sv, COALESCE(s.c, 0) AS sc,
                         COALESCE(w.v, 0) AS wv, COALESCE(w.c, 0) AS wc
                  FROM s FULL OUTER JOIN w ON s.client = w.client AND s.dt = w.dt),
            r AS (SELECT d.client, d.dt,
                         CASE WHEN (sv + sc > 0) <> (wv + wc > 0) THEN 'presence'
                              WHEN sv <> wv THEN 'visits'
                              WHEN d.client NOT IN (SELECT client FROM missing)
                                   AND CASE WHEN d.client IN (SELECT client FROM known) THEN COALESCE(sg.kn, 0) <> wc ELSE sc <> wc END THEN 'conversions'
                              WHEN COALESCE(sg.fresh, 0) > 0 THEN 'new_goal' END AS reason
                  FROM d LEFT JOIN sg ON sg.client = d.client AND sg.dt = d.dt)
       SELECT client, CAST(dt AS STRING) AS dt, reason FROM r WHERE reason IS NOT NULL""",
)
def q_changed_days_visits(spark, sf):
    return changed_days_visits(
        _daily(spark, sf, "vis_src"), _goals(spark, sf, "vis_src"), _daily(spark, sf, "vis_wh"), _goals(spark, sf, "vis_wh")
    )


@query(
    "day_snapshot",
    """SELECT client, CAST(dt AS STRING) AS dt, COUNT(*) AS rows, CAST(date_trunc('second', MIN(ts)) AS STRING) AS min_ts,
              CAST(date_trunc('second', MAX(ts)) AS STRING) AS max_ts FROM {vis_wh} GROUP BY client, dt""",
)
def q_day_snapshot(spark, sf):
    days = day_snapshot(view(spark, sf, "vis_wh"))
    return days.withColumns({c: F.date_trunc("second", c).cast("timestamp_ntz") for c in ("min_ts", "max_ts")})


@query(
    "day_goal_detail",
    """WITH d AS (SELECT client, dt, COUNT(*) AS visits FROM {vis_wh} GROUP BY client, dt),
            g AS (SELECT client, dt, goal_id, COUNT(*) AS conversions FROM {vis_wh} WHERE goal_id IS NOT NULL GROUP BY client, dt, goal_id)
       SELECT d.client, CAST(d.dt AS STRING) AS dt, d.visits, COALESCE(g.goal_id, 0) AS goal_id, COALESCE(g.conversions, 0) AS conversions
       FROM d LEFT JOIN g ON g.client = d.client AND g.dt = d.dt""",
)
def q_day_goal_detail(spark, sf):
    detail = day_goal_detail(_goals(spark, sf, "vis_wh"), _daily(spark, sf, "vis_wh").drop("conversions"))
    return detail.fillna(0, ["goal_id", "conversions"])


@query(
    "stale_goals",
    """SELECT client, goal_all AS goal_id FROM {vis_src} WHERE goal_all IS NOT NULL
       EXCEPT SELECT client, CAST(id AS BIGINT) FROM {goal_names} WHERE lower(name) LIKE '%madd%'""",
)
def q_stale_goals(spark, sf):
    stored = view(spark, sf, "vis_src").where("goal_all IS NOT NULL")
    stored = stored.select("client", F.col("goal_all").alias("goal_id"), F.lit("g").alias("class")).distinct()
    return stale_goals(stored, goal_dimension(view(spark, sf, "goal_names"))).select("client", "goal_id")


FIRST_OF = ", ".join(f"ARG_MIN({c}, pos) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("gender", "area", "user_visits"))
COLLAPSED = f"""
    one AS (SELECT client, visit_id, {FIRST_OF} FROM {{report}} GROUP BY client, visit_id),
    it AS (SELECT client, visit_id, STRING_AGG(interest, ', ' ORDER BY p) AS interest
           FROM (SELECT client, visit_id, interest, MIN(pos) AS p FROM {{report}} GROUP BY client, visit_id, interest) x GROUP BY client, visit_id),
    collapsed AS (SELECT one.*, it.interest FROM one JOIN it ON it.client = one.client AND it.visit_id = one.visit_id)"""


def _collapsed(spark, sf):
    return collapse_visits(view(spark, sf, "report"), KEYS, ["gender", "area", "user_visits"], "interest", "pos")


@query(
    "visit_collapse",
    f"""WITH {COLLAPSED} SELECT client, visit_id, gender, area, COALESCE(user_visits, -1) AS user_visits, interest FROM collapsed""",
)
def q_visit_collapse(spark, sf):
    return _collapsed(spark, sf).fillna(-1, ["user_visits"])


@query(
    "visit_enrich",
    f"""WITH {COLLAPSED}
        SELECT c.client, c.visit_id, c.interest, l.duration AS "visitDuration", l.page_views AS "pageViews"
        FROM collapsed c JOIN {{vis_log}} l ON l.client = c.client AND l.visit_id = c.visit_id""",
)
def q_visit_enrich(spark, sf):
    logs = view(spark, sf, "vis_log").withColumnsRenamed({"duration": "visitDuration", "page_views": "pageViews"})
    joined = enrich_visits(_collapsed(spark, sf), logs, KEYS)
    return joined.select(*KEYS, "interest", "visitDuration", "pageViews")


@query(
    "visit_dedup",
    """SELECT client, visit_id, pos, interest FROM {report} r
       WHERE pos = (SELECT MAX(pos) FROM {report} x WHERE x.client = r.client AND x.visit_id = r.visit_id)""",
)
def q_visit_dedup(spark, sf):
    return dedup_visits(view(spark, sf, "report"), KEYS, "pos").select(*KEYS, "pos", "interest")


HITS = """
    lists AS (SELECT client, visit_id, CASE WHEN goals_id = '[]' THEN [] ELSE string_split(goals_id[2:-2], ',') END AS ids,
                     string_split(goals_time[2:-2], ',') AS times FROM {vis_log}),
    each AS (SELECT client, visit_id, UNNEST(range(1, len(ids) + 1)) AS i, ids, times FROM lists),
    pairs AS (SELECT client, visit_id, i, CAST(ids[i] AS BIGINT) AS goal_id, replace(times[i], chr(39), '') AS t FROM each),
    hits AS (SELECT client, visit_id, goal_id, COUNT(*) AS hits,
                    COALESCE(CAST(TRY_CAST(ARG_MIN(t, i) AS TIMESTAMP) AS STRING), 'none') AS first_time
             FROM pairs GROUP BY client, visit_id, goal_id)"""


def _parsed_log(spark, sf):
    return view(spark, sf, "vis_log").withColumns(
        {"goals_id": list_of_longs(F.col("goals_id")), "goals_time": list_of_strings(F.col("goals_time"))}
    )


def _hits(spark, sf):
    return goal_hits(_parsed_log(spark, sf), KEYS, "goals_id", "goals_time")


@query("goal_counts", f"WITH {HITS} SELECT client, visit_id, goal_id, hits FROM hits")
def q_goal_counts(spark, sf):
    return _hits(spark, sf).drop("first_time")


@query("goal_first_time", f"WITH {HITS} SELECT client, visit_id, goal_id, first_time FROM hits")
def q_goal_first_time(spark, sf):
    hits = _hits(spark, sf).drop("hits")
    return hits.withColumn("first_time", F.coalesce(F.col("first_time").cast("string"), F.lit("none")))


@query(
    "goal_flags",
    f"""WITH {HITS}
        SELECT h.client, h.visit_id, h.goal_id, 1 AS u_flag, CASE WHEN lower(n.name) LIKE '%madd%' THEN 1 ELSE 0 END AS g_flag
        FROM hits h JOIN {{goal_names}} n ON n.client = h.client AND CAST(n.id AS BIGINT) = h.goal_id""",
)
def q_goal_flags(spark, sf):
    return goal_flags(_hits(spark, sf), goal_dimension(view(spark, sf, "goal_names")))


@query(
    "shape_visits",
    f"""WITH {COLLAPSED}, {HITS},
             sums AS (SELECT h.client, h.visit_id, COUNT(*) AS u, SUM(CASE WHEN lower(n.name) LIKE '%madd%' THEN 1 ELSE 0 END) AS g
                      FROM hits h JOIN {{goal_names}} n ON n.client = h.client AND CAST(n.id AS BIGINT) = h.goal_id
                      GROUP BY h.client, h.visit_id)
        SELECT c.client, c.visit_id, c.gender, c.interest, l.duration AS "visitDuration", l.page_views AS "pageViews",
               CASE l.device WHEN 1 THEN 'десктоп' WHEN 2 THEN 'мобильные телефоны' ELSE '0' END AS "deviceCategory",
               CAST(l.first_ts AS STRING) AS "dateTime",
               CAST(COALESCE(s.u, 0) AS BIGINT) AS u_sum_goal, CAST(COALESCE(s.g, 0) AS BIGINT) AS g_sum_goal
        FROM collapsed c JOIN {{vis_log}} l ON l.client = c.client AND l.visit_id = c.visit_id
        LEFT JOIN sums s ON s.client = c.client AND s.visit_id = c.visit_id""",
)
def q_shape_visits(spark, sf):
    report = view(spark, sf, "report").withColumnsRenamed({"area": "regionArea", "user_visits": "userVisits"})
    logs = view(spark, sf, "vis_log").withColumnsRenamed(
        {
            "duration": "ym:s:visitDuration", "page_views": "ym:s:pageViews", "device": "ym:s:deviceCategory",
            "goals_id": "ym:s:goalsID", "goals_time": "ym:s:goalsDateTime", "first_ts": "ym:s:dateTime",
        }
    )
    visits = shape_visits(report, logs, goal_dimension(view(spark, sf, "goal_names")), KEYS, "pos")
    return visits.select(
        *KEYS, "gender", "interest", "visitDuration", "pageViews", "deviceCategory", "dateTime", "u_sum_goal", "g_sum_goal"
    )


@query(
    "drop_goals",
    """WITH marked AS (SELECT client, CAST(id AS BIGINT) AS goal_id FROM {goal_names} WHERE lower(name) LIKE '%madd%')
       SELECT client, CAST(dt AS STRING) AS dt, goal_all AS goal_id, COUNT(*) AS conversions FROM {vis_src} v
       WHERE goal_all IS NOT NULL AND EXISTS (SELECT 1 FROM marked m WHERE m.client = v.client AND m.goal_id = v.goal_all) GROUP BY client, dt, goal_all""",
)
def q_drop_goals(spark, sf):
    stored = view(spark, sf, "vis_src").where("goal_all IS NOT NULL")
    daily = stored.groupBy("client", "dt", F.col("goal_all").alias("goal_id")).agg(F.count("*").alias("conversions"))
    marked = daily.select("client", "goal_id").distinct().withColumn("class", F.lit("g"))
    return drop_goals(daily, stale_goals(marked, goal_dimension(view(spark, sf, "goal_names"))))


@query(
    "unmatched_visits",
    """SELECT client, COUNT(*) AS unmatched FROM {report} r
       WHERE NOT EXISTS (SELECT 1 FROM {vis_log} l WHERE l.client = r.client AND l.visit_id = r.visit_id) GROUP BY client""",
)
def q_unmatched_visits(spark, sf):
    return unmatched_visits(view(spark, sf, "report"), view(spark, sf, "vis_log"), KEYS)


@query(
    "day_goals_first",
    """WITH v AS (SELECT client, dt, user_id % 30 AS goal_id FROM {vis_src}),
            d AS (SELECT client, dt, COUNT(*) AS visits FROM v GROUP BY client, dt),
            g AS (SELECT client, dt, goal_id, COUNT(*) AS conversions, ROW_NUMBER() OVER (PARTITION BY client, dt ORDER BY goal_id) AS n FROM v GROUP BY client, dt, goal_id)
       SELECT d.client, CAST(d.dt AS STRING) AS dt, d.visits, g.goal_id, g.conversions FROM d JOIN g ON g.client = d.client AND g.dt = d.dt WHERE n <= 20""",
)
def q_day_goals_first(spark, sf):
    """As ``day_goal_detail`` with clients put together, so that a day has more goals than the report shows."""
    rows = view(spark, sf, "vis_src").withColumns({"goal_id": F.col("user_id") % 30, "visits": F.lit(1), "conv": F.lit(1)})
    return day_goal_detail(goal_daily(rows, VISITS_START, VISITS_END), daily_visits(rows, VISITS_START, VISITS_END).drop("conversions"))


LOG_TYPES = {
    "client": "string", "ym:s:visitID": "string", "ym:s:dateTime": "string", "ym:s:visitDuration": "bigint", "ym:s:pageViews": "bigint",
    "ym:s:deviceCategory": "string", "ym:s:goalsID": "string", "ym:s:goalsDateTime": "string",
}
REPORT_TYPES = {"client": "string", "ym:s:visitID": "string", "pos": "bigint", "ym:s:interest": "string", "ym:s:gender": "string"}


@query(
    "visits_files_to_changes",
    f"""WITH {HITS},
            visit AS (SELECT client, visit_id, CAST(CAST(first_ts AS TIMESTAMP) AS DATE) AS dt, page_views <= 3 AS stored FROM {{vis_log}}),
            source_goals AS (SELECT client, CAST(id AS BIGINT) AS goal_id FROM {{goal_names}}),
            known AS (SELECT * FROM source_goals WHERE goal_id <> 5 UNION ALL SELECT 'm_1', CAST(99 AS BIGINT)),
            hit AS (SELECT v.client, v.dt, v.stored, h.goal_id FROM hits h JOIN visit v ON v.client = h.client AND v.visit_id = h.visit_id),
            s AS (SELECT v.client, v.dt, v.n AS v, COALESCE(c.n, 0) AS c FROM (SELECT client, dt, COUNT(*) AS n FROM visit GROUP BY client, dt) v
                  LEFT JOIN (SELECT h.client, h.dt, COUNT(*) AS n FROM hit h JOIN source_goals g ON g.client = h.client AND g.goal_id = h.goal_id GROUP BY 1, 2) c ON c.client = v.client AND c.dt = v.dt),
            w AS (SELECT v.client, v.dt, v.n AS v, COALESCE(c.n, 0) AS c FROM (SELECT client, dt, COUNT(*) AS n FROM visit WHERE stored GROUP BY client, dt) v
                  LEFT JOIN (SELECT h.client, h.dt, COUNT(*) AS n FROM hit h JOIN known g ON g.client = h.client AND g.goal_id = h.goal_id WHERE stored GROUP BY 1, 2) c ON c.client = v.client AND c.dt = v.dt),
            missing AS (SELECT DISTINCT client FROM (SELECT client, goal_id FROM known EXCEPT SELECT client, goal_id FROM source_goals) x),
            sg AS (SELECT h.client, h.dt, SUM(CASE WHEN k.goal_id IS NOT NULL THEN 1 ELSE 0 END) AS kn, SUM(CASE WHEN k.goal_id IS NULL THEN 1 ELSE 0 END) AS fresh
                   FROM hit h LEFT JOIN known k ON k.client = h.client AND k.goal_id = h.goal_id GROUP BY h.client, h.dt),
            wg AS (SELECT h.client, h.dt, COUNT(*) AS kn FROM hit h JOIN known k ON k.client = h.client AND k.goal_id = h.goal_id WHERE stored GROUP BY h.client, h.dt),
            r AS (SELECT s.client, s.dt, CASE WHEN w.v IS NULL THEN 'presence' WHEN s.v <> w.v THEN 'visits'
                         WHEN s.client NOT IN (SELECT client FROM missing)
                              AND CASE WHEN s.client IN (SELECT client FROM known) THEN COALESCE(sg.kn, 0) <> COALESCE(wg.kn, 0) ELSE s.c <> w.c END THEN 'conversions'
                         WHEN COALESCE(sg.fresh, 0) > 0 THEN 'new_goal' END AS reason
                  FROM s LEFT JOIN w ON w.client = s.client AND w.dt = s.dt LEFT JOIN sg ON sg.client = s.client AND sg.dt = s.dt LEFT JOIN wg ON wg.client = s.client AND wg.dt = s.dt)
       SELECT client, CAST(dt AS STRING) AS dt, reason FROM r WHERE reason IS NOT NULL""",
)
def q_visits_files_to_changes(spark, sf):
    """Log and report files to visits, a part of them stored, and both sides compared by day and goal."""
    folder = shared_dir(spark)
    view(spark, sf, "vis_log").select(
        "client", F.col("visit_id").alias("ym:s:visitID"), F.col("first_ts").alias("ym:s:dateTime"), F.col("duration").alias("ym:s:visitDuration"),
        F.col("page_views").alias("ym:s:pageViews"), F.col("device").alias("ym:s:deviceCategory"), F.col("goals_id").alias("ym:s:goalsID"), F.col("goals_time").alias("ym:s:goalsDateTime"),
    ).write.csv(f"{folder}/log", sep="\t", header=True)
    view(spark, sf, "report").select("client", F.col("visit_id").alias("ym:s:visitID"), "pos", F.col("interest").alias("ym:s:interest"), F.col("gender").alias("ym:s:gender")).write.csv(
        f"{folder}/report", sep="\t", header=True
    )
    logs, report = read_visit_parts(spark, f"{folder}/log", LOG_TYPES), read_visit_parts(spark, f"{folder}/report", REPORT_TYPES)
    listed = goal_dimension(view(spark, sf, "goal_names"))
    known = listed.where("goal_id <> 5").unionByName(spark.createDataFrame([("m_1", 99, "u")], listed.schema))
    source = shape_visits(report, logs, listed, ["client", "visitID"], "pos")
    house = Warehouse(spark, buckets=2)
    stored = shape_visits(report, logs, known, ["client", "visitID"], "pos").where("pageViews <= 3")
    house.write("visits", stored.withColumn("Date", F.to_date("dateTime")))
    stored = house.read("visits", VISITS_START, VISITS_END)

    def sides(visits):
        rows = visits.withColumn("visits", F.lit(1))
        return daily_visits(rows, VISITS_START, VISITS_END, date_col="dateTime"), goal_list_daily(visits, VISITS_START, VISITS_END, "goalsID")

    return changed_days_visits(*sides(source), *sides(stored), goal_list=listed, known_goals=known)
