"""Partitioned tables: replace, append, schema changes."""

from datetime import date
from decimal import Decimal

import pytest

from funnelbook.plans.changes import changed_days_ads
from funnelbook.plans.reload import collapse_ranges
from funnelbook.plans.warehouse import PART, Warehouse

SCHEMA = "client string, Date date, clicks bigint"


def d(m, n):
    return date(2024, m, n)


@pytest.fixture()
def house(spark):
    return Warehouse(spark, buckets=2)


def rows(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def ranges(spark, data):
    return rows(spark, data, "client string, start date, end date")


def stored(house, table="t"):
    return sorted((r.client, r.Date, r.clicks) for r in house.read(table).collect())


OLD = [("a", d(1, 1), 1), ("a", d(1, 2), 2), ("a", d(2, 1), 3), ("b", d(1, 1), 4), ("b", d(3, 1), 5)]


def test_replace_removes_vanished_days_and_keeps_the_rest(spark, house):
    house.write("t", rows(spark, OLD))
    new = rows(spark, [("a", d(1, 1), 10), ("a", d(1, 1), 11), ("a", d(2, 1), 99), ("c", d(1, 5), 7)])
    plan = ranges(spark, [("a", d(1, 1), d(1, 3)), ("c", d(1, 5), d(1, 5)), ("b", d(3, 1), d(3, 1))])
    want = [("a", d(1, 1), 10), ("a", d(1, 1), 11), ("a", d(2, 1), 3), ("b", d(1, 1), 4), ("c", d(1, 5), 7)]
    house.range_replace("t", new, plan)
    assert stored(house) == want
    house.range_replace("t", new, plan)
    assert stored(house) == want
    parts = {r[0][:6] for r in spark.sql(f"SHOW PARTITIONS {house.schema}.t").select("partition").collect()}
    assert not any("202403" in p for p in parts)


def test_untouched_partitions_keep_their_files(spark, house):
    house.write("t", rows(spark, OLD))

    def files():
        df = spark.table(f"{house.schema}.t")
        return {f for f in df.inputFiles() if f"{PART}=202401" not in f}

    before = files()
    house.range_replace("t", rows(spark, [("a", d(1, 1), 0)]), ranges(spark, [("a", d(1, 1), d(1, 1))]))
    assert before and files() == before


def test_replace_into_absent_table_and_with_nothing(spark, house):
    house.range_replace("t", rows(spark, OLD), ranges(spark, [("a", d(1, 1), d(1, 31))]))
    assert stored(house) == OLD[:2]
    house.range_replace("t", rows(spark, []), ranges(spark, [("a", d(1, 2), d(1, 2))]))
    assert stored(house) == OLD[:1]
    house.range_replace("t", rows(spark, OLD), ranges(spark, []))
    assert stored(house) == OLD[:1]


def test_erase_and_cleanup(spark, house):
    house.write("t", rows(spark, OLD))
    clients = rows(spark, [("a",)], "client string")
    house.erase_range("t", clients, d(1, 2), d(2, 10))
    assert stored(house) == [OLD[0], OLD[3], OLD[4]]
    assert house.cleanup_clients(rows(spark, [("b",), ("zz",)], "client string"), ["t", "absent"]) == 1
    assert stored(house) == [OLD[0]]
    other = rows(spark, [("elsewhere", "a")], "source string, client string")
    assert house.cleanup_clients(other, ["t"]) == 0 and stored(house) == [OLD[0]]
    house.erase_range("absent", clients, d(1, 1), d(1, 1))
    assert not house.exists("absent")


def test_full_reload(spark, house):
    house.write("t", rows(spark, OLD))
    house.full_reload("t", rows(spark, [("a", d(1, 1), 50)]), d(1, 1), d(1, 31))
    assert stored(house) == [("a", d(1, 1), 50), OLD[2], OLD[4]]
    house.full_reload("t", rows(spark, []), d(1, 1), d(3, 31), rows(spark, [("b",)], "client string"))
    assert stored(house) == [("a", d(1, 1), 50), OLD[2]]


def test_window_read_prunes(spark, house):
    house.write("t", rows(spark, OLD))
    df = house.read("t", d(1, 2), d(2, 28))
    assert sorted(r.clicks for r in df.collect()) == [2, 3]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_additive_schema_and_order(spark, house):
    house.write("t", rows(spark, OLD[:1]))
    house.write("t", rows(spark, [(9, "a", d(1, 9), "x")], "clicks bigint, client string, Date date, note string"))
    schema = house.add_missing_columns("t", rows(spark, [("a", 1.5)], "client string, share double"))
    assert schema.names == ["client", "Date", "clicks", "note", "share"]
    got = {(r.clicks, r.note, r.share) for r in house.read("t").collect()}
    assert got == {(1, None, None), (9, "x", None)}


def test_replace_table_from_itself_and_without_dates(spark, house):
    house.write("t", rows(spark, OLD))
    house.replace_table("t", house.read("t").where("client = 'a'").selectExpr("*", "1 AS extra"))
    assert stored(house) == OLD[:3] and house.read("t").columns == ["client", "Date", "clicks", "extra"]
    house.replace_table("t", house.read("t").limit(0))
    assert stored(house) == []
    goals = rows(spark, [("a", 1)], "client string, goal_id bigint")
    house.write("goals", goals)
    house.replace_table("goals", house.read("goals").unionByName(goals))
    assert house.read("goals").count() == 2
    house.replace_table("plain", rows(spark, [("x",)], "login string"), ("type",))
    assert house.read("plain").collect() == [("x",)]


def test_type_upgrade_counts_bad_values(spark, house):
    house.write("t", rows(spark, [("a", d(1, 1), "5"), ("a", d(1, 2), "x"), ("b", d(2, 1), None)], "client string, Date date, clicks string"))
    assert house.upgrade_types("t", {"clicks": "bigint", "client": "string"}) == {"clicks": 1}
    assert [r[2] for r in stored(house)] == [5, None, None]
    assert house.upgrade_types("t", {"clicks": "double"}) == {}


def test_goal_columns_read_zero(spark, house):
    assert house.add_goal_columns("t", ["u_goal_1"]) == 0
    house.write("t", rows(spark, OLD))
    assert house.add_goal_columns("t", ["u_goal_1", "clicks"]) == 1
    assert {r.u_goal_1 for r in house.read("t").collect()} == {0}
    house.write("t", rows(spark, OLD[:1]))
    assert {r.u_goal_1 for r in house.read("t").collect()} == {0}
    house.range_replace("t", rows(spark, OLD[:1]), ranges(spark, [("a", d(1, 1), d(1, 1))]))
    assert {r.u_goal_1 for r in house.read("t").collect()} == {0}


def test_second_detection_is_empty(spark, house, sf):
    from funnelbook.registry.base import ADS_END, ADS_START, view

    cols = ["client", "Date", "impressions", "clicks", "cost", "goal_id", "conv"]
    src = view(spark, sf, "ads_src")
    new = src.withColumnRenamed("dt", "Date").select(*cols)
    small = Warehouse(spark, buckets=1, period="year")
    small.write("ads", view(spark, sf, "ads_wh").withColumnRenamed("dt", "Date").select(*cols))

    def changes():
        return changed_days_ads(src, small.read("ads").withColumnRenamed("Date", "dt"), ADS_START, ADS_END, tolerance=Decimal("0"))

    assert changes().count() > 0
    small.range_replace("ads", new, collapse_ranges(changes()))
    assert changes().count() == 0


def parts_of(spark, house, table="t"):
    return {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {house.schema}.{table}").collect()}


def folders(house):
    import os

    return {name for name in os.listdir(house.location) if not name.startswith((".", "_"))}


def test_day_layout_rewrites_only_planned_days(spark):
    house = Warehouse(spark, buckets=2, period="day")
    days = [("a", d(1, k), k) for k in range(1, 11)] + [("b", d(1, k), 100 + k) for k in range(1, 11)]
    house.write("t", rows(spark, days))

    def files():
        return {f.split(f"{PART}=")[1][:8]: f for f in spark.table(f"{house.schema}.t").where(f"client = 'a' AND {PART} > '0'").inputFiles()}

    before = files()
    plan = ranges(spark, [("a", d(1, 3), d(1, 4)), ("a", d(1, 4), d(1, 5)), ("a", d(1, 9), d(1, 9))])
    house.range_replace("t", rows(spark, [("a", d(1, 3), 30), ("a", d(1, 6), 60)]), plan)
    want = [("a", d(1, k), 30 if k == 3 else k) for k in (1, 2, 3, 6, 7, 8, 10)]
    assert stored(house) == want + days[10:]
    after = files()
    assert {k for k in before if after.get(k) == before[k]} >= {f"2024010{k}" for k in (1, 2, 6, 7, 8)} | {"20240110"}
    assert len(folders(house)) == 1  # the plan's folder is gone


def test_replace_reads_and_shuffles_once(spark):
    house = Warehouse(spark, buckets=2, period="day")
    house.write("t", rows(spark, OLD))
    plan = ranges(spark, [("a", d(1, 1), d(1, 2))])
    from funnelbook.plans.reload import interval_plan

    parts = house._touched("t", interval_plan(plan))
    assert parts and set(parts) < parts_of(spark, house) and all(p[:8] in ("20240101", "20240102") for p in parts)
    kept = house._in_plan(spark.table(f"{house.schema}.t").where(f"{PART} IN ({', '.join(map(repr, parts))})"), house._sent(interval_plan(plan)), inside=False)
    text = house._laid_out(kept.drop(PART), ("client", "Date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in text and text.count("Exchange RebalancePartitions".lower()) + text.lower().count("rebalance_partitions_by_col") == 1
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_null_clients_are_replaced(spark, house):
    house.write("t", rows(spark, [*OLD, (None, d(1, 1), 8), (None, None, 9)]))
    house.full_reload("t", rows(spark, [(None, d(1, 2), 80), ("a", d(1, 1), 50)]), d(1, 1), d(1, 31))
    got = sorted(((r.client or "", str(r.Date), r.clicks) for r in house.read("t").collect()))
    assert got == sorted([("", "2024-01-02", 80), ("", "None", 9), ("a", "2024-01-01", 50), ("a", "2024-02-01", 3), ("b", "2024-03-01", 5)])
    house.range_replace("t", rows(spark, [(None, d(1, 2), 81)]), ranges(spark, [(None, d(1, 2), d(1, 2))]))
    assert sorted(r.clicks for r in house.read("t").where("client IS NULL").collect()) == [9, 81]


def test_ranges_without_rows(spark, house):
    house.write("t", rows(spark, OLD))
    new, plan = rows(spark, [("a", d(1, 1), 10)]), ranges(spark, [("a", d(1, 1), d(1, 2)), ("b", d(1, 1), d(1, 1)), ("c", d(1, 1), d(1, 1))])
    audit = {(r.client, r.removed, r.added) for r in house.audit("t", new, plan).collect()}
    assert audit == {("a", 2, 1), ("b", 1, 0), ("c", 0, 0)}
    with pytest.raises(ValueError, match="b 2024-01-01..2024-01-01, c 2024"):
        house.range_replace("t", new, plan, empty="fail")
    assert stored(house) == OLD
    house.range_replace("t", new, plan, empty="keep")
    assert stored(house) == [("a", d(1, 1), 10), OLD[2], OLD[3], OLD[4]]
    house.range_replace("t", new, plan)
    assert stored(house) == [("a", d(1, 1), 10), OLD[2], OLD[4]]


def test_a_swap_that_was_cut_off_is_finished(spark, house, monkeypatch):
    house.write("t", rows(spark, OLD))
    house.add_goal_columns("t", ["u_goal_1"])
    rename = house._rename
    with monkeypatch.context() as patch:

        def stop(old, new):
            if new == "t":
                raise RuntimeError("lost")
            rename(old, new)

        patch.setattr(house, "_rename", stop)
        with pytest.raises(RuntimeError):
            house.replace_table("t", house.read("t").where("client = 'b'"))
    again = Warehouse(spark, house.schema, house.location, buckets=2)
    assert again.exists("t") and stored(again) == OLD[3:] and not again._there("t__old")
    with monkeypatch.context() as patch:
        patch.setattr(again, "_rename", lambda *a: (_ for _ in ()).throw(RuntimeError("before the swap")))
        with pytest.raises(RuntimeError):
            again.replace_table("t", rows(spark, OLD[:1]))
    assert stored(again) == OLD[3:]
    again.replace_table("t", rows(spark, OLD[:1]))
    assert stored(again) == OLD[:1] and {r.u_goal_1 for r in again.read("t").collect()} == {0}
    again.write("t", rows(spark, OLD[1:2]))
    assert {r.u_goal_1 for r in again.read("t").collect()} == {0}


def test_cleanup_reads_the_buckets_of_the_clients(spark):
    house = Warehouse(spark, buckets=16)
    names = [f"c{k}" for k in range(40)]
    house.write("t", rows(spark, [(n, d(1, 1), k) for k, n in enumerate(names)]))
    before = set(spark.table(f"{house.schema}.t").inputFiles())
    assert house.cleanup_clients(rows(spark, [("c3",), (None,)], "client string"), ["t"]) == 1
    after = set(spark.table(f"{house.schema}.t").inputFiles())
    assert len(before - after) == 1 and sorted(r.client for r in house.read("t").collect()) == sorted(set(names) - {"c3"})


def test_planned_days_are_found_by_halving(spark, house):
    from datetime import timedelta

    from pyspark.sql import functions as F

    from funnelbook.plans.reload import interval_plan, range_of

    start = d(1, 1)
    spans = {c: [(start + timedelta(3 * k), start + timedelta(3 * k + k % 2)) for k in range(n)] for c, n in ((None, 1), ("a", 2), ("b", 7), ("c", 8), ("d", 100))}
    plan = interval_plan(ranges(spark, [(c, *s) for c, of in spans.items() for s in of] * 2))
    days = [start + timedelta(k) for k in range(-2, 310)] + [None]
    data = [(c, day, 0) for c in [*spans, "e"] for day in days]
    both = rows(spark, data).withColumnRenamed("client", "c").join(plan, F.col("c").eqNullSafe(F.col("client")))
    got = {(r.c, r.Date): r.r for r in both.select("c", "Date", range_of(F.col("Date")).alias("r")).collect()}
    want = {(c, day): next((s for s in spans[c] if day and s[0] <= day <= s[1]), None) for c in spans for day in days}
    assert {k: v and (v.start, v.end) for k, v in got.items()} == want
    # a row is tested in as many strides as its client's number of ranges has binary digits
    assert {r.client: r.n for r in plan.select("client", F.size("__steps").alias("n")).collect()} == {None: 1, "a": 2, "b": 3, "c": 4, "d": 7}
    inside = {(r.client, r.Date) for r in house._in_plan(rows(spark, data), plan).collect()}
    outside = house._in_plan(rows(spark, data), plan, inside=False)
    assert inside == {k for k, v in want.items() if v}
    assert {(r.client, r.Date) for r in outside.collect()} == {(c, day) for c, day, _ in data} - inside
    # the lists stay in the join
    assert "LeftAnti" in outside._jdf.queryExecution().executedPlan().toString()


def test_audit_works_the_plan_out_once(spark, house):
    house.write("t", rows(spark, OLD))
    new, plan = rows(spark, [("a", d(1, 1), 10), (None, d(1, 1), 11)]), ranges(spark, [("a", d(1, 1), d(1, 2)), ("a", d(2, 1), d(2, 1)), (None, d(1, 1), d(1, 3)), ("b", d(1, 1), d(1, 1))])
    for table, removed in (("t", (2, 1, 0, 1)), ("absent", (0, 0, 0, 0))):
        audit = house.audit(table, new, plan)
        assert "Window" not in audit._jdf.queryExecution().executedPlan().toString()
        got = {(r.client, r.start): (r.removed, r.added) for r in audit.collect()}
        want = (("a", d(1, 1), 1), ("a", d(2, 1), 0), (None, d(1, 1), 1), ("b", d(1, 1), 0))
        assert got == {(c, start): (out, added) for (c, start, added), out in zip(want, removed, strict=True)}
