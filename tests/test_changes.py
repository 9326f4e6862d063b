"""Change detection: the edge rows."""

from datetime import date
from decimal import Decimal

from funnelbook.plans.changes import changed_days_ads, changed_days_visits, goal_deltas, new_goal_days

START, END = date(2024, 1, 1), date(2024, 1, 10)
ADS = "client string, dt date, impressions bigint, clicks bigint, cost decimal(18,2), goal_id bigint, conv bigint"


def day(n):
    return date(2024, 1, n)


def ads(spark, rows):
    return spark.createDataFrame([(c, day(d), i, k, Decimal(str(m)), g, v) for c, d, i, k, m, g, v in rows], ADS)


def found(df):
    return {(r.client, r.dt.day): r.reason for r in df.collect()}


def detect(spark, src, wh, **kw):
    kw.setdefault("tolerance", 5)
    return found(changed_days_ads(ads(spark, src), ads(spark, wh), START, END, **kw))


def test_equal_and_one_sided_days(spark):
    src = [("a", 1, 10, 1, 5, None, 0), ("a", 2, 10, 1, 5, None, 0)]
    wh = [("a", 1, 10, 1, 5, None, 0), ("a", 3, 10, 1, 5, None, 0)]
    assert detect(spark, src, wh) == {("a", 2): "presence", ("a", 3): "presence"}


def test_all_zero_equals_absent(spark):
    src = [("a", 1, 10, 1, 5, None, 0), ("a", 2, 0, 0, 0, None, 0)]
    wh = [("a", 1, 10, 1, 5, None, 0), ("a", 4, 0, 0, 0, 1, 0)]
    assert detect(spark, src, wh) == {}


def test_tolerance_is_strict(spark):
    wh = [("a", 1, 10, 1, 100, None, 0), ("a", 2, 10, 1, 100, None, 0)]
    src = [("a", 1, 10, 1, 105, None, 0), ("a", 2, 10, 1, "105.01", None, 0)]
    assert detect(spark, src, wh) == {("a", 2): "metrics"}


def test_skip_list_in_any_spelling(spark):
    names = ["my_shop", "my-shop", "other"]
    wh = [(c, 1, 10, 1, 100, None, 0) for c in names]
    src = [(c, 1, 10, 1, 900, None, 0) for c in names]
    assert detect(spark, src, wh, skip_cost=["my_shop"]) == {("other", 1): "metrics"}


def test_source_empty_client_is_never_reported(spark):
    assert detect(spark, [("a", 1, 1, 1, 1, None, 0)], [("a", 1, 1, 1, 1, None, 0), ("b", 2, 5, 5, 5, None, 0)]) == {}


def test_forced_last_day(spark):
    src = [("a", 1, 0, 0, 0, None, 0), ("b", 1, 3, 0, 0, None, 0), ("c", 10, 3, 0, 0, None, 0)]
    assert detect(spark, src, []) == {("a", 10): "forced", ("b", 1): "presence", ("b", 10): "forced", ("c", 10): "presence"}


def test_conversions_of_known_and_new_goals(spark):
    base = [("a", d, 10, 1, 5, 1, 2) for d in (1, 2, 3)]
    src = base + [("a", 2, 0, 0, 0, 9, 4), ("a", 3, 0, 0, 0, 8, 0)]
    wh = [("a", 1, 10, 1, 5, 1, 3), ("a", 2, 10, 1, 5, 1, 2), ("a", 3, 10, 1, 5, 1, 2)]
    assert detect(spark, src, wh) == {("a", 1): "metrics", ("a", 2): "new_goal"}
    # without conversion check the known goal is not looked at; a new goal still reloads its day
    assert detect(spark, src, wh, compare_conversions=False) == {("a", 2): "new_goal"}


def test_window_limits_both_sides(spark):
    src = ads(spark, [("a", 1, 10, 1, 5, None, 0), ("a", 20, 10, 1, 5, None, 0)])
    wh = ads(spark, [("a", 1, 10, 1, 5, None, 0), ("a", 25, 10, 1, 5, None, 0)])
    assert found(changed_days_ads(src, wh, START, END)) == {}


def test_new_goal_days(spark):
    daily = spark.createDataFrame(
        [("a", day(1), 1, 5), ("a", day(1), 2, 3), ("a", day(2), 2, 0), ("a", day(1), 3, 0), ("a", day(2), 3, 0)],
        "client string, dt date, goal_id bigint, conversions bigint",
    )
    known = spark.createDataFrame([("a", 1), ("b", 2)], "client string, goal_id bigint")
    rows = {(r.goal_id, r.dt and r.dt.day) for r in new_goal_days(daily, known).collect()}
    assert rows == {(2, 1), (3, None)}


VIS, GOAL = "client string, dt date, visits bigint, conversions bigint", "client string, dt date, goal_id bigint, conversions bigint"


def visits(spark, src, sg, wh, wg, **kw):
    def frame(rows, schema):
        return spark.createDataFrame([(c, day(d), *rest) for c, d, *rest in rows], schema)

    return found(changed_days_visits(frame(src, VIS), frame(sg, GOAL), frame(wh, VIS), frame(wg, GOAL), **kw))


def test_visits_presence_and_count(spark):
    src = [("a", 1, 5, 0), ("a", 2, 5, 0), ("a", 3, 0, 0)]
    assert visits(spark, src, [], [("a", 1, 4, 0)], []) == {("a", 1): "visits", ("a", 2): "presence"}


def test_visits_differences_that_cancel(spark):
    src, wh = [("a", 1, 5, 3)], [("a", 1, 5, 3)]
    sg, wg = [("a", 1, 1, 1), ("a", 1, 2, 2)], [("a", 1, 1, 2), ("a", 1, 2, 1)]
    assert visits(spark, src, sg, wh, wg) == {}


def test_visits_known_goal_missing_at_source(spark):
    src, wh = [("a", 1, 5, 1), ("a", 2, 6, 1)], [("a", 1, 5, 4), ("a", 2, 5, 4)]
    sg, wg = [("a", 1, 1, 1), ("a", 2, 1, 1)], [("a", 1, 1, 2), ("a", 1, 2, 2), ("a", 2, 1, 4)]
    assert visits(spark, src, sg, wh, wg) == {("a", 2): "visits"}
    # the missing goal is ignored: known goals are compared again
    ignored = spark.createDataFrame([("a", 2)], "client string, goal_id bigint")
    assert visits(spark, src, sg, wh, wg, ignored=ignored) == {("a", 1): "conversions", ("a", 2): "visits"}


def test_visits_without_known_goals_compare_totals(spark):
    assert visits(spark, [("a", 1, 5, 2)], [], [("a", 1, 5, 3)], []) == {("a", 1): "conversions"}
    assert visits(spark, [("a", 1, 5, 2)], [], [("a", 1, 5, 3)], [], compare_conversions=False) == {}


def test_visits_new_goal_and_goal_lists(spark):
    src, wh = [("a", 1, 5, 3), ("a", 2, 5, 1)], [("a", 1, 5, 1), ("a", 2, 5, 1)]
    sg, wg = [("a", 1, 1, 1), ("a", 1, 7, 2), ("a", 2, 1, 1)], [("a", 1, 1, 1), ("a", 2, 1, 1)]
    assert visits(spark, src, sg, wh, wg) == {("a", 1): "new_goal"}
    known = spark.createDataFrame([("a", 1), ("a", 7)], "client string, goal_id bigint")
    assert visits(spark, src, sg, wh, wg, known_goals=known) == {("a", 1): "conversions"}
    listed = spark.createDataFrame([("a", 7)], "client string, goal_id bigint")
    assert visits(spark, src, sg, wh, wg, known_goals=known, goal_list=listed) == {}


def test_goal_deltas_limit_and_rest(spark):
    rows = [("a", day(1), g, 1) for g in range(1, 21)]
    src = spark.createDataFrame(rows, GOAL)
    out = goal_deltas(src, src.limit(0)).collect()
    assert sorted(r.goal_id for r in out) == list(range(1, 16)) and {r.more for r in out} == {5}


def test_hot_client_is_reduced_before_the_shuffle(spark):
    """One client with nearly all rows: what is shuffled is its days and goals, not its rows."""
    df = spark.range(200_000).selectExpr(
        "'hot' AS client", "date_add(date'2024-01-01', CAST(id % 10 AS INT)) AS dt", "1L AS impressions", "1L AS clicks",
        "CAST(1 AS DECIMAL(18,2)) AS cost", "id % 3 AS goal_id", "1L AS conv",
    )
    changed = changed_days_ads(df, df.where("dt > date'2024-01-03'"), START, END)
    plan = changed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_sum" in plan
    assert found(changed) == {("hot", n): "presence" for n in (1, 2, 3)}


def test_reasons_meet_by_client_without_a_second_sort_of_its_days(spark):
    src = [(None, 1, 1, 1, 1, None, 0), (None, 4, 1, 1, 1, None, 0), ("a", 1, 1, 1, 1, None, 0), ("b", 2, 0, 0, 0, None, 0)]
    wh = [("a", 1, 1, 1, 1, None, 0), ("a", 2, 1, 1, 1, None, 0), ("d", 1, 1, 1, 1, None, 0)]
    days = changed_days_ads(ads(spark, src), ads(spark, wh), START, END, tolerance=5)
    # the goals that the warehouse knows are the only window
    assert days._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    assert found(days) == {(None, 1): "presence", (None, 4): "presence", (None, 10): "forced", ("a", 2): "presence", ("b", 10): "forced"}
