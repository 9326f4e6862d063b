"""Landed files: headers of their own, faults that are named, loads that fail."""

from datetime import date

import pytest

from funnelbook.plans.changes import changed_days_ads
from funnelbook.sources import ad_reports, landed
from funnelbook.sources.pages import read_pages
from funnelbook.sources.reports import ANALYTICS_TYPES, read_report_tsv, read_visit_parts

KNOWN = ["Date", "Clicks", "Criterion"]


def put(folder, **files):
    for name, text in files.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


def scan(spark, path, prefixes=("conversions",)):
    return landed.scan_headed(landed.read_lines(spark, path), KNOWN, prefixes)


def test_three_headers_in_one_scan(spark, tmp_path):
    path = put(
        tmp_path,
        a="Date\tClicks\tConversions_1_LSC\n2024-01-01\t5\t2\n2024-01-02\t6\t--\n",
        b='﻿"Date"\tClicks\tconversions_2_LSC\tConversions_1_LC\r\n2024-01-01\t5\t7\t1\r\n',
        c="Clicks\tDate\n3\t2024-01-03",
        empty="",
        only_header="Date\tClicks\n",
    )
    types = {"Date": "date", "Clicks": "bigint"}
    rows = landed.strict(ad_reports.scan_reports(spark, path, types))
    base = {tuple(r) for r in ad_reports.base_rows(rows, [], ["Clicks"], types=types).collect()}
    assert base == {(date(2024, 1, 1), 5), (date(2024, 1, 2), 6), (date(2024, 1, 3), 3)}
    goals = {tuple(r) for r in ad_reports.goal_rows(rows, []).collect()}
    assert goals == {(date(2024, 1, 1), 1, "LSC", 2), (date(2024, 1, 1), 2, "LSC", 7), (date(2024, 1, 1), 1, "LC", 1)}
    assert {tuple(r) for r in ad_reports.goal_columns(rows, []).collect()} == {(1, "LSC"), (2, "LSC"), (1, "LC")}


def test_batches_repeat_base_metrics_and_goals_once(spark, tmp_path):
    path = put(
        tmp_path,
        a="Date\tCriterion\tClicks\tConversions_1_LSC\n2024-01-01\tx\t5\t2\n2024-01-01\ty\t1\t3\n",
        b="Date\tCriterion\tClicks\tConversions_1_LSC\tConversions_9_LSC\n2024-01-01\tx\t5\t2\t4\n2024-01-01\ty\t1\t3\t0\n",
    )
    rows = ad_reports.scan_reports(spark, path, {"Date": "date", "Criterion": "string", "Clicks": "bigint"})
    assert [tuple(r) for r in ad_reports.base_rows(rows, [], ["Clicks"]).collect()] == [(date(2024, 1, 1), 6)]
    assert {tuple(r) for r in ad_reports.goal_rows(rows, []).collect()} == {(date(2024, 1, 1), 1, "LSC", 5), (date(2024, 1, 1), 9, "LSC", 4)}
    by_word = {tuple(r) for r in ad_reports.goal_rows(rows, [], {"Criterion": "word"}).collect()}
    assert (date(2024, 1, 1), "y", 1, "LSC", 3) in by_word and len(by_word) == 3


def test_every_cut_is_named(spark, tmp_path):
    path = put(
        tmp_path,
        good='Date\tClicks\tCriterion\n2024-01-01\t5\t"a ""b"""\n2024-01-01\t5\tDate\n',
        short="Date\tClicks\tCriterion\n2024-01-01\t5\n2024-01-02\t5\tx\n2024-0",
        long="Date\tClicks\n2024-01-01\t5\t6\n",
        quoted='Date\tClicks\tCriterion\n2024-01-01\t5\t"a\tb"\n',
        bare="2024-01-01\t5\n",
        two="Date\tClicks\n2024-01-01\t5\nDate\tCriterion\n",
        twice="Date\tClicks\tClicks\n2024-01-01\t5\t5\n",
        words="Date\tClicks\nsoon\t5\n2024-01-01\tmany\n2024-01-01\t--\n2024-01-01\t\n",
    )
    rows = ad_reports.scan_reports(spark, path, {"Date": "date", "Clicks": "bigint", "Criterion": "string"})
    found = {(r["file"].rsplit("/", 1)[1], r["fault"]): r["rows"] for r in landed.ledger(rows).collect()}
    assert found == {
        ("short", "short row"): 2, ("long", "long row"): 1, ("quoted", "long row"): 1, ("bare", "no header"): 1, ("two", "several headers"): 2,
        ("twice", "repeated column"): 1, ("words", "no day"): 1, ("words", "no number"): 1,
    } or found == {**found, ("two", "several headers"): 1}
    counts = {r["file"].rsplit("/", 1)[1]: (r["good"], r["faulty"]) for r in landed.scan_counts(rows).collect()}
    assert counts["good"] == (2, 0) and counts["short"] == (1, 2) and counts["words"] == (2, 2)
    assert sorted(r["fields"]["Criterion"] for r in landed.good(rows).collect() if "/good" in r["file"]) == ["Date", 'a "b"']
    with pytest.raises(Exception, match="short row in .*short"):
        landed.strict(rows.where("file LIKE '%/short'")).collect()


def test_cut_pages(spark, tmp_path):
    path = put(tmp_path, p='{"id": 1, "records": [1]}\n{"id": 2, "records": [2\n{"id": 3}\n{"id": "x", "records": []}\n')
    rows = landed.scan_json(landed.read_lines(spark, path), "id bigint, records array<bigint>", ["records"])
    assert sorted((r["fault"] or "", r["id"]) for r in rows.collect() if r["fault"] != "no JSON") == [("", 1), ("missing records", 3)]
    assert {(r["fault"], r["rows"]) for r in landed.ledger(rows).collect()} == {("no JSON", 2), ("missing records", 1)}
    with pytest.raises(Exception, match="broken page"):
        read_pages(spark, path, "id bigint, records array<bigint>").collect()


def test_plain_readers_fail_on_broken_rows(spark, tmp_path):
    types = {"Date": "date", "Clicks": "bigint"}
    path = put(tmp_path, a="Date\tClicks\n2024-01-01\t5\n")
    assert [tuple(r) for r in read_report_tsv(spark, path, types).collect()] == [(date(2024, 1, 1), 5)]
    assert read_report_tsv(spark, path, types).select("Clicks").first()[0] == 5
    put(tmp_path, b="Date\tClicks\n2024-01-01\n")
    with pytest.raises(Exception, match="broken row"):
        read_report_tsv(spark, path, types).collect()
    with pytest.raises(Exception, match="broken row"):
        read_visit_parts(spark, path, types).select("Clicks").collect()
    put(tmp_path, b="Date\tClicks\n2024-0\t5\n")
    with pytest.raises(Exception, match="no day"):
        read_report_tsv(spark, path, types).select("Date").collect()


def test_goals_known_before_the_window_are_not_new(spark):
    columns = "client string, dt date, goal_id bigint, impressions bigint, clicks bigint, cost double, conv bigint"
    day, before = date(2024, 1, 5), date(2023, 6, 1)
    base = ("a", day, None, 10, 1, 1.0, 0)
    source = spark.createDataFrame([base, ("a", day, 6, 0, 0, 0.0, 3), ("b", *base[1:]), ("b", day, 7, 0, 0, 0.0, 3)], columns)
    stored = spark.createDataFrame([base, ("b", *base[1:]), ("a", before, 6, 1, 1, 1.0, 1)], columns)

    def found(**more):
        return {(r["client"], r["reason"]) for r in changed_days_ads(source, stored, date(2024, 1, 1), date(2024, 1, 31), **more).collect()}

    assert found() == {("a", "metrics"), ("b", "new_goal")}
    listed = spark.createDataFrame([("b", 7)], "client string, goal_id bigint")
    assert found(known_goals=listed) == {("a", "new_goal"), ("b", "metrics")}
    assert "Criterion" in ANALYTICS_TYPES
