"""Windows, blocks, ranges and reload jobs."""

from datetime import date, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from funnelbook.plans.reload import collapse_ranges, plan_jobs
from funnelbook.plans.windows import day_series, resolve_window, window_chunks

D = date(2024, 1, 1)


def windows(spark, rows):
    return spark.createDataFrame(rows, "client string, start date, end date")


@pytest.mark.parametrize(("length", "blocks"), [(1, [1]), (5, [5]), (6, [5, 1]), (7, [5, 2]), (10, [5, 5])])
def test_chunks_lose_no_tail(spark, length, blocks):
    df = window_chunks(windows(spark, [("a", D, D + timedelta(days=length - 1))]))
    got = sorted((r.chunk_start, r.chunk_end) for r in df.collect())
    assert [(b - a).days + 1 for a, b in got] == blocks
    assert all(b + timedelta(days=1) == a for (_, b), (a, _) in zip(got, got[1:]))


def test_empty_window(spark):
    df = windows(spark, [("a", D + timedelta(days=1), D)])
    assert window_chunks(df).count() == 0 and day_series(df).count() == 0


def test_resolve_window():
    as_of = date(2024, 3, 1)
    assert resolve_window(as_of, 60) == (date(2024, 1, 1), date(2024, 2, 29))
    assert resolve_window(as_of, 10, extra_day=True) == (date(2024, 2, 19), date(2024, 2, 29))
    assert resolve_window(as_of, 60, date(2023, 1, 1), date(2023, 1, 5)) == (date(2023, 1, 1), date(2023, 1, 5))
    assert resolve_window(as_of, 0) == (date(2024, 2, 29), date(2024, 2, 29))


def ranges(spark, days, schema="client string, dt date"):
    return sorted((r.client, r.start, r.end) for r in collapse_ranges(spark.createDataFrame(days, schema)).collect())


def test_ranges_over_month_year_and_leap_day(spark):
    days = [("a", date(2023, 12, 31)), ("a", date(2024, 1, 1)), ("a", date(2024, 1, 1)), ("a", date(2024, 2, 28)), ("a", date(2024, 2, 29)),
            ("a", date(2024, 3, 1)), ("b", date(2024, 1, 2))]
    assert ranges(spark, days) == [
        ("a", date(2023, 12, 31), date(2024, 1, 1)), ("a", date(2024, 2, 28), date(2024, 3, 1)), ("b", date(2024, 1, 2), date(2024, 1, 2))
    ]


def test_ranges_skip_bad_text_and_empty_input(spark):
    assert ranges(spark, [("a", "2024-01-05"), ("a", "oops"), ("a", "2024-13-40"), ("a", None)], "client string, dt string") == [
        ("a", date(2024, 1, 5), date(2024, 1, 5))
    ]
    assert ranges(spark, []) == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.sampled_from("ab"), st.integers(0, 40)), min_size=1))
def test_ranges_cover_exactly_the_days(spark, picked):
    days = {(c, D + timedelta(days=n)) for c, n in picked}
    out = collapse_ranges(spark.createDataFrame(sorted(days), "client string, dt date"))
    back = day_series(out).collect()
    assert len(back) == len(days) and {(r.client, r.dt) for r in back} == days
    got = sorted((r.client, r.start, r.end) for r in out.collect())
    assert all(c1 != c2 or (s2 - e1).days > 1 for (c1, _, e1), (c2, s2, _) in zip(got, got[1:]))


def test_plan_jobs(spark):
    changes = spark.createDataFrame([("a", D), ("x", D)], "client string, dt date")
    clients = spark.createDataFrame([("a", "t1"), ("b", "t2")], "client string, token string")
    got = {(r.client, r.token, r.start, r.status) for r in plan_jobs(changes, clients, "light").collect()}
    assert got == {("a", "t1", D, "job"), ("b", "t2", None, "unchanged"), ("x", None, D, "no_access")}
