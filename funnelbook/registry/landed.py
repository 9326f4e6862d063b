"""Landed report files with headers of their own, cut files, and the way from files to changed days.

The files are written to the shared folder from the test tables: per client one file of goals 1 to 4 and one of goals 5 to 7, and
every third client reports goal 3 under a second attribution model too, so that three headers meet in one scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.changes import changed_days_ads
from ..session import shared_dir
from ..sources import ad_reports, landed
from .base import query, view

START, END = date(1994, 1, 1), date(2001, 12, 31)
BATCHES = (range(1, 5), range(5, 8))


def _report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """client, batch, line, place: the header first, then a line for each day and network."""
    keys = ["client", "number", "dt", "network"]
    daily = view(spark, sf, "rep_src").groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "cost")],
        *[F.coalesce(F.sum(F.when(F.col("goal_id") == g, F.col("conv"))), F.lit(0)).alias(f"g{g}") for goals in BATCHES for g in goals],
    )
    text = lambda *values: F.concat_ws("\t", *values)
    out = []
    for batch, goals in enumerate(BATCHES):
        names = [f"Conversions_{g}_LSC" for g in goals]
        value = [F.when(F.col(f"g{g}") == 0, "--").otherwise(F.col(f"g{g}").cast("string")) for g in goals]
        base = [F.col("dt").cast("string"), F.col("network"), *[F.col(c).cast("string") for c in ("impressions", "clicks")], (F.col("cost") * 1_000_000).cast("string")]
        second = (F.col("number") % 3 == 0) & F.lit(batch == 0)
        head = F.when(second, text(*map(F.lit, ["Date", "AdNetworkType", "Impressions", "Clicks", "Cost", *names, "conversions_3_LC"]))).otherwise(
            text(*map(F.lit, ["Date", "AdNetworkType", "Impressions", "Clicks", "Cost", *names]))
        )
        line = F.when(second, text(*base, *value, (F.col("g3") * 2).cast("string"))).otherwise(text(*base, *value))
        rows = daily.select("client", F.lit(batch).alias("batch"), head.alias("head"), line.alias("line"), F.lit(1).alias("place"))
        out += [rows.drop("head"), rows.select("client", "batch", F.col("head").alias("line"), F.lit(0).alias("place")).distinct()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def _land(lines: DataFrame, *folders: str) -> str:
    """One file for each combination of folder values, the header first."""
    path = shared_dir(lines.sparkSession)
    dealt = lines.repartition(8, *folders).sortWithinPartitions(*folders, "place", "line")
    dealt.select(*folders, "line").write.partitionBy(*folders).text(path)
    return path


def _scan(spark: SparkSession, sf: str) -> DataFrame:
    return landed.strict(ad_reports.scan_reports(spark, _land(_report_lines(spark, sf), "client", "batch")))


@query(
    "goal_unpivot",
    """SELECT client, CAST(dt AS STRING) AS dt, network, goal_id, 'LSC' AS model, CAST(SUM(conv) AS BIGINT) AS conv
       FROM {rep_src} GROUP BY client, dt, network, goal_id HAVING SUM(conv) > 0
       UNION ALL
       SELECT client, CAST(dt AS STRING), network, 3, 'LC', CAST(2 * SUM(conv) AS BIGINT)
       FROM {rep_src} WHERE goal_id = 3 AND number % 3 = 0 GROUP BY client, dt, network HAVING SUM(conv) > 0""",
)
def q_goal_unpivot(spark, sf):
    return ad_reports.goal_rows(_scan(spark, sf), ["client"], {"AdNetworkType": "network"})


@query(
    "report_base",
    """SELECT client, CAST(dt AS STRING) AS dt, network, CAST(SUM(impressions) AS BIGINT) AS "Impressions", CAST(SUM(clicks) AS BIGINT) AS "Clicks",
              CAST(SUM(cost) AS DOUBLE) AS "Cost" FROM {rep_src} GROUP BY client, dt, network""",
)
def q_report_base(spark, sf):
    return ad_reports.base_rows(_scan(spark, sf), ["client"], ["Impressions", "Clicks", "Cost"], {"AdNetworkType": "network"}, micros=True)


@query(
    "goal_columns",
    """SELECT DISTINCT client, g AS goal_id, 'LSC' AS model FROM {rep_src}, (SELECT UNNEST(range(1, 8)) AS g) x
       UNION ALL SELECT DISTINCT client, CAST(3 AS BIGINT), 'LC' FROM {rep_src} WHERE number % 3 = 0""",
)
def q_goal_columns(spark, sf):
    return ad_reports.goal_columns(_scan(spark, sf), ["client"])


@query(
    "ads_files_to_changes",
    """WITH src AS (SELECT client, dt, goal_id, impressions, clicks, cost, CASE WHEN goal_id = 3 AND number % 3 = 0 THEN 3 * conv ELSE conv END AS conv
                    FROM {rep_src} WHERE dt >= DATE '1994-01-01'),
            wh AS (SELECT * FROM {rep_wh} WHERE dt >= DATE '1994-01-01'),
            known AS (SELECT DISTINCT client, goal_id FROM {rep_wh} WHERE goal_id IS NOT NULL),
            s AS (SELECT client, dt, SUM(impressions) AS i, SUM(clicks) AS k, SUM(cost) AS c, SUM(conv) AS v FROM src GROUP BY client, dt),
            w AS (SELECT client, dt, SUM(impressions) AS i, SUM(clicks) AS k, SUM(cost) AS c, SUM(CASE WHEN goal_id IS NOT NULL THEN conv ELSE 0 END) AS v FROM wh GROUP BY client, dt),
            sg AS (SELECT client, dt, goal_id, SUM(conv) AS v FROM src GROUP BY client, dt, goal_id),
            wg AS (SELECT client, dt, goal_id, SUM(conv) AS v FROM wh WHERE goal_id IS NOT NULL GROUP BY client, dt, goal_id),
            g AS (SELECT COALESCE(sg.client, wg.client) AS client, COALESCE(sg.dt, wg.dt) AS dt,
                         BOOL_OR(k.goal_id IS NOT NULL AND COALESCE(sg.v, 0) <> COALESCE(wg.v, 0)) AS differs,
                         BOOL_OR(k.goal_id IS NULL AND COALESCE(sg.v, 0) > 0) AS fresh
                  FROM sg FULL OUTER JOIN wg ON sg.client = wg.client AND sg.dt = wg.dt AND sg.goal_id = wg.goal_id
                  LEFT JOIN known k ON k.client = COALESCE(sg.client, wg.client) AND k.goal_id = COALESCE(sg.goal_id, wg.goal_id) GROUP BY 1, 2),
            d AS (SELECT COALESCE(s.client, w.client) AS client, COALESCE(s.dt, w.dt) AS dt, COALESCE(s.i, 0) AS si, COALESCE(s.k, 0) AS sk, COALESCE(s.c, 0) AS sc,
                         COALESCE(s.v, 0) AS sv, COALESCE(w.i, 0) AS wi, COALESCE(w.k, 0) AS wk, COALESCE(w.c, 0) AS wc, COALESCE(w.v, 0) AS wv
                  FROM s FULL OUTER JOIN w ON s.client = w.client AND s.dt = w.dt),
            r AS (SELECT d.client, d.dt, CASE WHEN (si + sk + sc + sv > 0) <> (wi + wk + wc + wv > 0) THEN 'presence'
                              WHEN si + sk + sc + sv > 0 AND (si <> wi OR sk <> wk OR g.differs OR ABS(sc - wc) > 2) THEN 'metrics'
                              WHEN g.fresh THEN 'new_goal' END AS reason
                  FROM d LEFT JOIN g ON g.client = d.client AND g.dt = d.dt)
       SELECT client, CAST(dt AS STRING) AS dt, reason FROM r WHERE reason IS NOT NULL
       UNION ALL SELECT client, '2001-12-31', 'forced' FROM (SELECT DISTINCT client FROM s) x
       WHERE client NOT IN (SELECT client FROM w) AND client NOT IN (SELECT client FROM r WHERE reason IS NOT NULL AND dt = DATE '2001-12-31')""",
)
def q_ads_files_to_changes(spark, sf):
    source = ad_reports.ads_rows(_scan(spark, sf), micros=True)
    return changed_days_ads(source, view(spark, sf, "rep_wh"), START, END, profile="light")


# -- faults ---------------------------------------------------------------------------------------

VISIT_COLUMNS = ("ym:s:visitID", "ym:s:clientID", "ym:s:pageViews")


def _visit_lines(spark, sf) -> DataFrame:
    """Visit parts of which the third has a header of two columns more, and rows cut in the middle."""
    events = view(spark, sf, "vis_src").select((F.col("visit_id") % 4).alias("part"), "visit_id", "user_id", F.floor("value").alias("pages"))
    cut = (F.col("part") == 1) & (F.col("user_id") % 50 == 0)
    line = F.concat_ws("\t", F.col("visit_id").cast("string"), F.when(~cut, F.col("user_id").cast("string")), F.when(~cut, F.col("pages").cast("string")), F.when(F.col("part") == 2, F.lit("x")))
    heads = spark.createDataFrame([(p, "\t".join((*VISIT_COLUMNS, "ym:s:browser") if p == 2 else VISIT_COLUMNS), 0) for p in (0, 1, 2)], "part bigint, line string, place int")
    return events.select("part", line.alias("line"), F.lit(1).alias("place")).unionByName(heads)


@query(
    "scan_ledger",
    """SELECT 'reports' AS input, client AS part, fault, CAST(COUNT(*) AS BIGINT) AS rows FROM
         (SELECT client, CASE WHEN number = 1 AND network = 'A' THEN 'short row' WHEN number = 2 AND network = 'N' THEN 'no day'
                              WHEN number = 4 AND network = 'R' THEN 'no number' END AS fault FROM
            (SELECT DISTINCT client, number, dt, network, b FROM {rep_src}, (SELECT UNNEST([0, 1]) AS b) x) y) z WHERE fault IS NOT NULL GROUP BY client, fault
       UNION ALL
       SELECT 'visits', CAST(part AS STRING), fault, COUNT(*) FROM
         (SELECT visit_id % 4 AS part, CASE WHEN visit_id % 4 = 3 THEN 'no header' WHEN visit_id % 4 = 1 AND user_id % 50 = 0 THEN 'short row' END AS fault FROM {vis_src}) v
       WHERE fault IS NOT NULL GROUP BY part, fault
       UNION ALL
       SELECT 'pages', CAST(part AS STRING), fault, COUNT(*) FROM
         (SELECT visit_id % 4 AS part, CASE WHEN user_id % 40 = 1 THEN 'no JSON' WHEN user_id % 40 = 2 THEN 'missing records' END AS fault FROM {vis_src}) p
       WHERE fault IS NOT NULL GROUP BY part, fault""",
)
def q_scan_ledger(spark, sf):
    lines = _report_lines(spark, sf)
    number, network = F.regexp_extract("client", "[0-9]+", 0), F.split("line", "\t")[1]
    bad = (
        F.when((number == "1") & (network == "A"), F.substring_index("line", "\t", 3))
        .when((number == "2") & (network == "N"), F.concat(F.lit("x"), F.col("line")))
        .when((number == "4") & (network == "R"), F.regexp_replace("line", r"^([^\t]*\t[^\t]*\t)", "$1n"))
    )
    reports = ad_reports.scan_reports(spark, _land(lines.withColumn("line", F.when(F.col("place") == 1, F.coalesce(bad, F.col("line"))).otherwise(F.col("line"))), "client", "batch"))
    visits = landed.scan_headed(landed.read_lines(spark, _land(_visit_lines(spark, sf), "part")), [*VISIT_COLUMNS, "ym:s:browser"])
    page = F.to_json(F.struct("visit_id", F.when(F.col("user_id") % 40 != 2, F.array("user_id")).alias("records")))
    page = F.when(F.col("user_id") % 40 == 1, F.substring(page, F.lit(1), F.length(page) - 3)).otherwise(page)
    written = view(spark, sf, "vis_src").select((F.col("visit_id") % 4).alias("part"), page.alias("line"), F.lit(1).alias("place"))
    pages = landed.scan_json(landed.read_lines(spark, _land(written, "part")), "visit_id bigint, records array<bigint>", ["records"])
    found = [landed.ledger(df, [key]).select(F.lit(name).alias("input"), F.col(key).cast("string").alias("part"), "fault", "rows") for name, df, key in (("reports", reports, "client"), ("visits", visits, "part"), ("pages", pages, "part"))]
    return found[0].unionByName(found[1]).unionByName(found[2])
