"""Visits, goals, calls, groups, skew join."""

import random
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from funnelbook.operators.calls import CANONICAL, calls_leads
from funnelbook.operators.goals import (
    campaign_goals, drop_goals, drop_legacy, goal_dimension, goal_flags, goal_hits, goal_sums, merge_goal_batches, pivot_goals, stale_goals,
    wide_flags,
)
from funnelbook.operators.groups import GROUP_COLUMNS, active_clients, attach_group, normalize_groups, run_summary
from funnelbook.operators.visits import collapse_visits, dedup_visits, enrich_visits, shape_visits, unmatched_visits
from funnelbook.plans.skew import skew_join


def test_collapse(spark):
    rows = [("v", 1, None, "b"), ("v", 2, "m", "a"), ("v", 3, "f", "b"), ("w", 4, None, None), ("w", 5, None, None)]
    df = spark.createDataFrame(rows, "visit string, pos int, gender string, interest string").repartition(3)
    out = collapse_visits(df, ["visit"], ["gender"], "interest", "pos")
    assert {tuple(r) for r in out.select("visit", "gender", "interest").collect()} == {("v", "m", "b, a"), ("w", None, "")}


def test_goal_hits(spark):
    rows = [
        ("v1", [1, 2, 1], ["2024-01-01 10:00:00", "bad", "2024-01-01 11:00:00"]),
        ("v2", [], []),
        ("v3", [5, 6], ["2024-01-02 00:00:00"]),
        ("v4", None, None),
        ("v5", [3, None], None),
    ]
    df = spark.createDataFrame(rows, "v string, g array<bigint>, t array<string>")
    got = {tuple(r) for r in goal_hits(df, ["v"], "g", "t").collect()}
    assert got == {
        ("v1", 1, 2, datetime(2024, 1, 1, 10)), ("v1", 2, 1, None), ("v3", 5, 1, datetime(2024, 1, 2)), ("v3", 6, 1, None), ("v5", 3, 1, None)
    }


def goals(spark):
    return goal_dimension(
        spark.createDataFrame([("a", "1", "mADD x"), ("a", "2", None), ("a", "x", "madd"), ("b", "9", "o")], "client string, id string, name string")
    )


def test_goal_flags_sums_and_dimension(spark):
    dim = goals(spark)
    assert {tuple(r) for r in dim.collect()} == {("a", 1, "g"), ("a", 2, "u"), ("b", 9, "u")}
    hits = spark.createDataFrame([("a", "v", 1, 3), ("a", "v", 7, 1), ("a", "w", 2, 1)], "client string, visit string, goal_id bigint, hits bigint")
    got = {tuple(r) for r in goal_flags(hits, dim).select("visit", "goal_id", "u_flag", "g_flag").collect()}
    assert got == {("v", 1, 1, 1), ("w", 2, 1, 0)}
    visits = spark.createDataFrame([("a", [1, 1, 2, 7]), ("a", None), ("zz", [1])], "client string, ids array<bigint>")
    sums = sorted((r.client, r.g_sum_goal, r.u_sum_goal) for r in goal_sums(visits, dim, "ids").collect())
    assert sums == [("a", 0, 0), ("a", 1, 2), ("zz", 0, 0)]
    wide = wide_flags(visits, "ids", [1, 9]).select("u_goal_1", "u_goal_9").collect()
    assert [tuple(r) for r in wide] == [(1, 0), (0, 0), (1, 0)]


def test_a_client_with_very_many_goals(spark):
    dim = spark.range(20_000).selectExpr("'a' AS client", "id AS goal_id", "IF(id % 2 = 0, 'g', 'u') AS class")
    visits = spark.createDataFrame([("a", list(range(0, 30_000, 3))), ("a", [1, 1, 2]), ("a", [1, 1, 2]), ("a", []), (None, [1])], "client string, ids array<bigint>")
    got = sorted((r.u_sum_goal, r.g_sum_goal) for r in goal_sums(visits, dim, "ids").collect())
    assert got == [(0, 0), (0, 0), (2, 1), (2, 1), (6667, 3334)]


def test_goal_lists_of_any_length_and_order(spark):
    rng = random.Random(3)
    lists = [[rng.choice([None, *range(k)]) for _ in range(n)] for n, k in ((0, 1), (1, 1), (40, 3), (300, 200), (2000, 7))]
    time = lambda i: f"2024-01-{i % 28 + 1:02d} 00:00:00"
    rows = [(v, g, [time(i) for i in range(len(g))]) for v, g in enumerate(lists)]
    got = {(r.v, r.goal_id): (r.hits, r.first_time) for r in goal_hits(spark.createDataFrame(rows, "v int, g array<bigint>, t array<string>"), ["v"], "g", "t").collect()}
    want = {(v, x): (g.count(x), datetime(2024, 1, g.index(x) % 28 + 1)) for v, g in enumerate(lists) for x in set(g) - {None}}
    assert got == want


def test_a_visit_of_many_hits_takes_seconds(spark):
    visit = spark.range(1).selectExpr("id AS v", "transform(sequence(0, 99999), i -> i * 7919L % 10000) AS g", "CAST(NULL AS array<string>) AS t")
    begun = time.monotonic()
    n, hits = goal_hits(visit, ["v"], "g", "t").agg(F.count("*"), F.sum("hits")).first()
    assert (n, hits) == (10_000, 100_000) and time.monotonic() - begun < 20


def test_batches_pivot_stale_and_legacy(spark):
    low = spark.createDataFrame([("k", 5, 1), ("m", 6, 2)], "key string, clicks int, conv_1 bigint")
    high = spark.createDataFrame([("m", 6, 9), ("k", 5, 7)], "key string, clicks int, conv_2 bigint")
    merged = sorted(tuple(r) for r in merge_goal_batches([low, high], ["key"], ["clicks"]).collect())
    assert merged == [("k", 5, 1, 7), ("m", 6, 2, 9)]
    long = spark.createDataFrame([("k", 1, 2), ("k", 1, 3), ("k", 9, 1)], "key string, goal_id bigint, n bigint")
    assert pivot_goals(long, ["key"], "n", [1, 2], "g_").collect() == [("k", 5, 0)]
    stored = spark.createDataFrame([("a", 1, "g"), ("a", 2, "g"), ("a", 3, "u")], "client string, goal_id bigint, class string")
    stale = stale_goals(stored, goals(spark))
    assert [r.goal_id for r in stale.collect()] == [2]
    assert {r.goal_id for r in drop_goals(stored, stale).collect()} == {1, 3}
    wide = spark.sql("SELECT 1 AS goal_1, 1 AS sum_goal, 1 AS g_goal_1, 1 AS g_goal_2, 1 AS u_goal_2, 1 AS g_sum_goal")
    assert drop_legacy(wide, [1]).columns == ["g_goal_1", "u_goal_2", "g_sum_goal"]


def test_campaign_goals(spark):
    df = spark.read.json(
        spark.sparkContext.parallelize(
            [
                '{"client":"a","TextCampaign":{"PriorityGoals":{"Items":[{"GoalId":12},{"GoalId":3}]}}}',
                '{"client":"a","SmartCampaign":{"PriorityGoals":{"Items":[{"GoalId":3},{"GoalId":null}]}}}',
                '{"client":"b","SmartCampaign":{"PriorityGoals":null}}',
            ]
        )
    )
    assert [tuple(r) for r in campaign_goals(df).collect()] == [("a", 3)]


def brute_join(one, many, left):
    index = dict(one)
    return [(k, index.get(k), v) for k, v in many if left or k in index]


def test_skew_join_equals_plain_join(spark):
    one = [(k, f"o{k}") for k in range(0, 50)]
    many = [(7, f"m{i}") for i in range(3000)] + [(7, "copy")] * 3000 + [(i % 60, f"r{i}") for i in range(2000)] + [(None, "null")] * 50
    o = spark.createDataFrame(one, "k int, o string")
    m = spark.createDataFrame(many, "k int, m string").repartition(4)
    key = lambda t: (t[0] or 0, t[1] or "", t[2])
    for how in ("inner", "left"):
        for counted in (None, m.select("k"), m.limit(0)):  # a wrong count changes nothing but the spread
            got = sorted(((r.k, r.o, r.m) for r in skew_join(o, m, ["k"], how, counted=counted).collect()), key=key)
            assert got == sorted(brute_join(one, many, how == "left"), key=key)


def spread_of(spark, join, condition):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return sorted(r.n for r in join.where(condition).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_keys_are_dealt_by_their_share(spark):
    # a third of the rows has key 7, three in a hundred have key 8
    many = spark.range(0, 60_000, 1, 4).selectExpr("IF(id % 3 = 0, 7, IF(id % 33 = 1, 8, 1000 + id)) AS k", "id AS m")
    one = spark.range(0, 100_000).selectExpr("id AS k", "id AS o")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = skew_join(one, many, ["k"], counted=many.select("k"))
    sizes = spread_of(spark, joined, "k = 7")
    assert sum(sizes) == 20_000 and len(sizes) >= parts - 2 and sizes[-1] < 10_000
    wide = skew_join(one, many, ["k"], counted=many.select("k"), partitions=64)
    assert sum(spread_of(spark, wide, "k = 7")) == 20_000
    text = skew_join(one, many, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Range (") == 2  # without a count each side is read once


def test_skew_join_with_empty_sides(spark):
    o = spark.createDataFrame([(1, "x")], "k int, o string")
    m = spark.createDataFrame([], "k int, m string")
    for counted in (None, m.select("k")):
        assert skew_join(o, m, ["k"], counted=counted).count() == 0 and skew_join(o, m, ["k"], "left", counted=counted).count() == 0
    assert skew_join(o.limit(0), o.withColumnRenamed("o", "m"), ["k"], "left").collect()[0].o is None


def test_enrich_unmatched_dedup(spark):
    report = spark.createDataFrame([("a", "v1"), ("a", "v2"), ("a", "v3")], "client string, visit string")
    logs = spark.createDataFrame([("a", "v1", 5, 1), ("a", "v2", None, 1)], "client string, visit string, visitDuration int, pageViews int")
    assert [r.visit for r in enrich_visits(report, logs, ["client", "visit"]).collect()] == ["v1"]
    assert unmatched_visits(report, logs, ["client", "visit"]).collect() == [("a", 1)]
    dup = spark.createDataFrame([("v", 1, "old"), ("v", 2, "new"), ("w", 1, "w")], "visit string, n int, x string")
    assert {r.x for r in dedup_visits(dup, ["visit"], "n").collect()} == {"new", "w"}


def test_shape_visits_words_and_types(spark):
    report = spark.createDataFrame(
        [("a", "v", 1, "Роботы", "undefined", " ", "3"), ("b", "w", 2, "Люди", "male", "x", None)],
        "client string, visitID string, pos int, isRobot string, gender string, interest string, userVisitsPeriod string",
    )
    logs = spark.createDataFrame(
        [("a", "v", "10", "2", "1", "[1,2]", "['2024-01-01 00:00:00']", "nan", "2024-01-01 01:02:03"),
         ("b", "w", "0", "0", "7", "[]", "[]", "Chrome", "oops")],
        "client string, visitID string, `ym:s:visitDuration` string, `ym:s:pageViews` string, `ym:s:deviceCategory` string,"
        "`ym:s:goalsID` string, `ym:s:goalsDateTime` string, `ym:s:browser` string, `ym:s:dateTime` string",
    )
    out = {r.visitID: r for r in shape_visits(report, logs, goals(spark), ["client", "visitID"], "pos").collect()}
    v, w = out["v"], out["w"]
    assert (v.isRobot, v.gender, v.interest, v.userVisitsPeriod, v.visitDuration) == (1, None, None, 3, 10)
    assert (v.deviceCategory, v.browser, v.dateTime, v.g_sum_goal, v.u_sum_goal) == ("десктоп", None, datetime(2024, 1, 1, 1, 2, 3), 1, 2)
    assert (w.isRobot, w.userVisitsPeriod, w.deviceCategory, w.dateTime, w.u_sum_goal) == (0, None, "7", None, 0)


def test_calls_without_leads_and_flags(spark):
    calls = spark.createDataFrame(
        [("01/02/2024 03:04:05", True, "12.0", "https://www.x.ru/a", "(none)"), ("oops", None, "x", "x.ru", "kw")],
        "date string, successful boolean, duration string, url string, keyword string",
    )
    leads = spark.createDataFrame([], "dateStr string")
    rows = calls_leads(calls, leads).orderBy(F.col("event_ts").asc_nulls_last()).collect()
    first, second = rows
    assert calls_leads(calls, leads).columns == ["Date", "event_ts", *CANONICAL, "domain"] and len(CANONICAL) == 33
    assert (first.Date, first.event_ts) == (date(2024, 2, 1), datetime(2024, 2, 1, 3, 4, 5))
    assert (first.CallSuccessful, first.CallDuration, first.domain, first.keywords, first.additionalTags) == (True, 12, "x.ru", None, None)
    assert (second.Date, second.CallSuccessful, second.CallDuration, second.domain, second.keywords) == (None, False, None, None, "kw")


def test_leads_nested_columns(spark):
    leads = spark.sql(
        "SELECT '01/02/2024 00:00:00' AS dateStr, named_struct('city', 'Paris', 'ip', '1', 'additionalTags', 't') AS session,"
        " array(named_struct('category', 'c', 'type', cast(null as string), 'names', array('n'))) AS RequestTags, 5 AS requestId, 'x' AS status"
    )
    calls = spark.createDataFrame([], "date string")
    row = calls_leads(calls, leads).first()
    assert (row.city, row.additionalTags, row.tag_category, row.tag_type, row.tag_names, row.requestId) == ("Paris", "t", "c", None, "n", 5)
    assert row.CallSuccessful is False and row.comment_text is None


def test_groups(spark):
    plans = spark.createDataFrame(
        [(1, "p", [(10, "g"), (11, None), (12, "")]), (2, None, [(20, "h")])],
        "plan_id int, plan_name string, groups array<struct<group_id:int,name:string>>",
    )
    stats = spark.createDataFrame([(10, '{"shows":"5","spent":1.5}'), (11, "{}"), (99, "{}"), (20, "oops")], "group_id int, base string")
    joined = attach_group(stats, plans)
    assert {(r.group_id, r.campaign_name) for r in joined.collect()} == {(10, "p"), (20, None)}
    out = normalize_groups(joined.withColumn("date", F.lit("2024-01-01")))
    assert out.columns == list(GROUP_COLUMNS) and len(out.columns) == 49
    row = out.where("group_id = '10'").first()
    assert (row.base_shows, row.base_spent, row.base_vk_goals, row.video_started, row.date) == (5, 1.5, 0, 0, date(2024, 1, 1))


def test_active_clients_and_run_summary(spark):
    clients = spark.createDataFrame([("a", "active"), ("b", "active"), ("c", "blocked")], "client string, status string")
    daily = spark.createDataFrame([(c, date(2024, 1, d), n) for c, d, n in [("a", 1, 3), ("a", 9, 4), ("b", 1, 0), ("c", 1, 5)]], "client string, dt date, shows bigint")
    assert active_clients(clients, daily, date(2024, 1, 1), date(2024, 1, 5)).collect() == [("a", 3)]
    results = spark.createDataFrame([("g", "a", True, 5), ("g", "b", False, None), ("h", "c", True, 2)], "agency string, client string, success boolean, rows bigint")
    assert run_summary(results).collect() == [(2, 3, 2, 7)]
