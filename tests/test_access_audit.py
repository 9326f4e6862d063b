"""Credentials, files, audit and the alert stream."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from funnelbook.operators.access import (
    agencies, delete_access, import_access, keep_favourites, latest, lookup_access, pick_credential, read_access, refresh_agency, split_access,
    upsert_access, with_legacy,
)
from funnelbook.operators.audit import cleanup_entries, failed, fan_out, newest_runs, stale_clients
from funnelbook.operators.users import add_users, current_users, delete_users, users_by_role
from funnelbook.session import shared_dir
from funnelbook.sources.access_files import access_export, export_csv, read_access_file
from funnelbook.sources.pages import zip_dims_metrics
from funnelbook.sources.reports import LIGHT_TYPES, profile_project, read_report_tsv, resolve_profiles
from funnelbook.streaming.monitor import failed_run_stream, write_alerts

ACCESS = "login string, token string, container string, type string"


def access(spark, rows):
    return spark.createDataFrame(rows, ACCESS)


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(x or "" for x in t))


STORED = [
    ("a", "t", "k", "ads:x"), ("b", "old", "k", "ads:x"), ("gone", "t", "k", "ads:x"), (None, "t", "k", "ads:x"),
    ("a", "t9", "other", "ads:x"), ("a", "t", "k", "ads"), ("z", "t", None, None),
]


def incoming(spark, rows):
    return spark.createDataFrame(rows, "container string, login string, token string")


def test_upsert_replace(spark):
    new = incoming(spark, [("k", "a", "t"), ("k", "b", "t"), ("k", "c", "t"), ("k", "c", "t")])
    out = upsert_access(access(spark, STORED), new, "ads", "x", replace=True)
    want = [("a", "t", "k", "ads:x"), ("b", "t", "k", "ads:x"), ("c", "t", "k", "ads:x"), *STORED[3:]]
    assert values(out) == values(access(spark, want))
    assert values(upsert_access(out, new, "ads", "x", replace=True)) == values(out)


def test_upsert_keep_and_null_login(spark):
    new = incoming(spark, [("k", None, "n")])
    out = values(upsert_access(access(spark, STORED), new, "ads", "x", replace=False))
    assert (None, "n", "k", "ads:x") in out and (None, "t", "k", "ads:x") not in out and len(out) == len(STORED)


def test_upsert_empty_list_clears_the_scope(spark):
    empty, scope = incoming(spark, []), spark.createDataFrame([("k",)], "container string")
    out = values(upsert_access(access(spark, STORED), empty, "ads", "x", replace=True, containers=scope))
    assert out == values(access(spark, STORED[4:]))
    assert values(upsert_access(access(spark, STORED), empty, "ads", "x", replace=False, containers=scope)) == values(access(spark, STORED))


def test_refresh_agency(spark):
    lists = spark.createDataFrame([("k", "tk", ["n_1", "n.2"]), ("e", "te", []), ("q", "", ["n3"])], "container string, token string, logins array<string>")
    stored = access(spark, [("old", "x", "k", "ads:agency_parsed"), ("left", "x", "e", "ads:agency_parsed"), ("keep", "x", "q", "ads:agency_parsed")])
    assert values(refresh_agency(stored, lists, "ads")) == [
        ("keep", "x", "q", "ads:agency_parsed"), ("n-1", "tk", "k", "ads:agency_parsed"), ("n-2", "tk", "k", "ads:agency_parsed")
    ]


def test_delete(spark):
    assert len(values(delete_access(access(spark, STORED), "a", "ads"))) == len(STORED) - 3
    assert len(values(delete_access(access(spark, STORED), "a", "ads", "x", "k"))) == len(STORED) - 1
    assert len(values(delete_access(access(spark, STORED), "a", None))) == len(STORED) - 3


def test_read_and_priority(spark):
    df = access(spark, STORED)
    assert {r.service for r in read_access(df, "ads", include_null_type=True).collect()} == {"ads", None}
    assert len(read_access(df, "ads", ["x"], container="k").collect()) == 4
    rows = [
        ("s_1", "agency", "1", "ads:agency_parsed"), ("s-1", "own", "2", "ads:not_agency_token"), ("s.1", "plain", "3", None),
        ("t", "one", "1", "ads"), ("t", "two", "2", "ads"), ("u", "x", "1", "ads:odd"), ("v", "", "1", "ads"), ("w", "x", "1", "visits"),
    ]
    best = {r.login: r.token for r in pick_credential(access(spark, rows), "ads", ["container"]).collect()}
    assert best == {"s-1": "own", "t": "two"}
    found = {r.client_id for r in agencies(access(spark, rows), "visits", ["token"]).collect()}
    assert found == {"s.1", "w"}


def test_lookup(spark):
    keys = spark.createDataFrame([("a",), ("miss",)], "login string")
    got = {r.login: (r.token, r.found) for r in lookup_access(keys, access(spark, STORED[:1])).collect()}
    assert got == {"a": ("t", True), "miss": (None, False)}


def test_favourites_and_legacy(spark):
    rows = [("11", "t1", None, "visits"), ("x", "t2", "22", "visits"), ("y", "t3", "n", "visits:agency"), (None, "t4", "n", "visits"), ("33", "", None, "visits")]
    explicit, agency = split_access(access(spark, rows), "visits", ["token"])
    assert {(r.counter_id, r.fact_login) for r in explicit.collect()} == {(11, "11"), (22, "x")}
    assert {r.token for r in agency.collect()} == {"t3", "t4"}

    def ids(favourites, forced=()):
        fav = spark.createDataFrame([(f,) for f in favourites], "counter_id bigint")
        return sorted(r.counter_id for r in keep_favourites(explicit, fav, forced).collect())

    assert ids([11, 99]) == [11] and ids([]) == [11, 22] and ids([], [22]) == [22] and ids([99]) == []
    none = keep_favourites(explicit.limit(0), spark.createDataFrame([], "counter_id bigint"))
    assert {r.source for r in with_legacy(none, access(spark, rows), "visits").collect()} == {"legacy_config"}
    some = keep_favourites(explicit, spark.createDataFrame([], "counter_id bigint"))
    assert {r.source for r in with_legacy(some, access(spark, rows), "visits").collect()} == {"explicit_token"}


def test_import_export_files(spark):
    df = spark.createDataFrame(
        [("a", "t", "null", None, "ads", "x"), ("a", "t", None, None, "ads", "x"), ("b", "NaN", "k", None, "", ""), ("", "", "none", "", None, "")],
        "Login string, TOKEN string, container string, type string, service string, subtype string",
    )
    kept, stats = import_access(df)
    assert kept.collect() == [("a", "t", None, "ads:x")] and stats.collect() == [(1, 1, 1)]
    with pytest.raises(ValueError, match="missing_columns:token"):
        import_access(df.drop("TOKEN"))
    path = shared_dir(spark)
    export_csv(access_export(access(spark, STORED)), path)
    back = read_access_file(spark, path)
    assert back.columns == ["login", "token", "container", "type", "service", "subtype"] and back.count() == len(STORED)


def test_report_file_and_profiles(spark):
    path = shared_dir(spark)
    lines = spark.createDataFrame([("2024-01-01", "c", "--", "1.5"), ("bad", "d", "1", "2")], "Date string, CampaignName string, Clicks string, Cost string")
    lines.write.csv(path, sep="\t", header=True)
    out = read_report_tsv(spark, path, {c: LIGHT_TYPES[c] for c in lines.columns}, drop_bad_days=True)
    assert out.collect() == [(date(2024, 1, 1), "c", 0, 1.5)]
    assert profile_project(out.withColumn("Extra", F.lit(1)).withColumn("Conversions_7", F.lit(1)), "light").columns == [
        "Date", "CampaignName", "Clicks", "Cost", "Conversions_7"
    ]
    assert resolve_profiles("both") == ["analytics", "light"] and resolve_profiles("light") == ["light"]


def test_zip_dims(spark):
    rows = spark.createDataFrame(
        [([("n", "1"), (None, "2"), ("", "3")], [1.0, None]), ([], [5.0])], "dimensions array<struct<name:string,id:string>>, metrics array<double>"
    )
    assert zip_dims_metrics(rows, ["a", "b", "c"], ["x", "y", "z"]).collect() == [("n", "2", "3", 1.0, 0.0, 0.0)]


def test_stale(spark):
    rows = [("edge", date(2024, 1, 1)), ("old", date(2023, 12, 31)), ("old", date(2023, 1, 1)), ("none", None)]
    df = spark.createDataFrame(rows, "client string, dt date")
    out = stale_clients({"ads": (df, "dt")}, date(2024, 1, 31))
    assert [(r.client, r.max_date, r.days_since_update, r.source) for r in out.collect()] == [("old", date(2023, 12, 31), 31, "ads")]


def test_latest(spark):
    df = spark.createDataFrame([(1, 1, "user"), (1, 2, "admin"), (2, 1, "user")], "id int, v int, role string")
    assert {(r.id, r.role) for r in latest(df, "id", "v").collect()} == {(1, "admin"), (2, "user")}


def test_users(spark):
    log = spark.createDataFrame([(1, "a", "User", 1), (1, "a", "Admin", 2), (2, "b", "Admin", 1), (2, "b", "User", 3)], "id bigint, name string, role string, version bigint")
    assert [r.id for r in users_by_role(log, " Admin ").collect()] == [1]
    fresh = spark.createDataFrame([("1", "a", "User"), ("3", " c ", None), ("x", "d", "User")], "id string, name string, role string")
    assert add_users(log, fresh, 9).collect() == [(3, "c", "", 9)]
    gone = spark.createDataFrame([("1",), ("b",), (" ",), (None,)], "identifier string")
    assert delete_users(log, gone).count() == 0 and delete_users(log, gone.limit(1)).count() == 2


def test_cleanup_entries(spark):
    def parse(values, selected=None):
        df = spark.createDataFrame([(v,) for v in values], "entry string")
        return [(r.source, r.client, r.error) for r in cleanup_entries(df, ["ads", "calls"], selected).collect()]

    assert parse(["ADS: x", "x", "odd:x", "ads:", "ads:a:b"]) == [
        ("ads", "x", None), (None, None, "bad_source"), (None, None, "bad_source"), (None, None, "no_client"), ("ads", "a:b", None)
    ]
    assert parse(["x", "calls:x", "ads:y"], "ads") == [("ads", "x", None), (None, None, "bad_source"), ("ads", "y", None)]


RUNS = "id string, state string, end_time timestamp_ntz, tags array<string>"


def run_rows():
    at = datetime(2024, 1, 2)
    return [
        ("1", "FAILED", at, []), ("2", "crashed", at, None), ("3", "COMPLETED", at, []), ("4", "FAILED", at, ["admin_bot"]),
        ("5", "CANCELLED", datetime(2024, 1, 1), []), ("1", "FAILED", at, []),
    ]


def test_failed_and_fan_out(spark):
    runs = spark.createDataFrame(run_rows(), RUNS)
    bad = failed(runs, datetime(2024, 1, 1))
    assert sorted(r.id for r in bad.collect()) == ["1", "1", "2"]
    assert [r.id for r in newest_runs(bad, 1).collect()] == ["2"]
    admins = spark.createDataFrame([(7,), (8,), (7,)], "admin_id bigint")
    assert len(fan_out(bad, admins).collect()) == 6
    assert fan_out(bad, spark.range(20_000).withColumnRenamed("id", "admin_id")).distinct().count() == 40_000
    assert fan_out(bad, admins.limit(0)).count() == 0


def test_stream_alerts_once(spark):
    base = shared_dir(spark)
    runs = spark.createDataFrame(run_rows(), RUNS)
    runs.write.parquet(f"{base}/in")

    def run():
        stream = spark.readStream.schema(runs.schema).parquet(f"{base}/in")
        write_alerts(failed_run_stream(stream, datetime(2024, 1, 1)), f"{base}/out", f"{base}/progress").awaitTermination()
        return sorted(r.id for r in spark.read.parquet(f"{base}/out").collect())

    assert run() == ["1", "2"]
    more = [("1", "FAILED", datetime(2024, 1, 2), []), ("6", "FAILED", datetime(2024, 1, 2, 1), [])]
    spark.createDataFrame(more, RUNS).write.mode("append").parquet(f"{base}/in")
    assert run() == ["1", "2", "6"]
    # days late, after newer runs were alerted: nothing is dropped, and a repeat gives no second alert
    late = [("7", "FAILED", datetime(2024, 1, 1, 3), []), ("2", *[r[1:] for r in run_rows() if r[0] == "2"][0]), ("7", "FAILED", datetime(2024, 1, 1, 3), [])]
    newer = [("8", "FAILED", datetime(2024, 3, 1), [])]
    spark.createDataFrame(newer, RUNS).write.mode("append").parquet(f"{base}/in")
    assert run() == ["1", "2", "6", "8"]
    spark.createDataFrame(late, RUNS).write.mode("append").parquet(f"{base}/in")
    assert run() == ["1", "2", "6", "7", "8"]
    assert run() == ["1", "2", "6", "7", "8"]


def test_a_batch_that_runs_again_replaces_itself(spark):
    base = shared_dir(spark)
    runs = spark.createDataFrame(run_rows(), RUNS)
    runs.write.parquet(f"{base}/in")
    for attempt in ("first", "second"):  # the progress of the first is lost after its alerts were written
        stream = spark.readStream.schema(runs.schema).parquet(f"{base}/in")
        write_alerts(failed_run_stream(stream, datetime(2024, 1, 1)), f"{base}/out", f"{base}/{attempt}").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{base}/out").collect()) == ["1", "2"]


def test_equal_versions_have_one_winner(spark):
    log = spark.createDataFrame([(1, "n", "user", 5), (1, "n", "admin", 5), (1, "m", "user", 5), (1, "z", "zz", 4)], "id bigint, name string, role string, version bigint")
    for rows in (log, log.orderBy("role"), log.repartition(3)):
        assert [tuple(r) for r in current_users(rows).collect()] == [(1, "n", "user")]
