"""Column functions: edge values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from funnelbook.functions import dates, frames, labels, nested, numbers, text


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


NUMBERS = ["12", " 12 ", "12.5", "", None, "abc", "99999999999999999999", "-7", "+7", "12d", "NaN", "Infinity", "0x1p3", "1e3", ".5", "5.", "--"]


def test_lenient_numbers(spark):
    assert apply(spark, NUMBERS, numbers.int64_or_zero) == [12, 0, 0, 0, 0, 0, 0, -7, 7, 0, 0, 0, 0, 0, 0, 0, 0]
    assert apply(spark, NUMBERS, numbers.lenient_long) == [12, 12, 12, 0, 0, 0, 0, -7, 7, 0, 0, 0, 0, 1000, 0, 5, 0]
    assert apply(spark, NUMBERS, numbers.lenient_double) == [12, 12, 12.5, 0, 0, 0, 1e20, -7, 7, 0, 0, 0, 0, 1000, 0.5, 5, 0]
    assert apply(spark, ["9007199254740993"], numbers.lenient_long) == [9007199254740993]


def test_rounding_flags_and_infinity(spark):
    inf, nan = float("inf"), float("nan")
    assert apply(spark, [0.5, 1.5, 2.5, -0.5], numbers.round_half_even, "double") == [0, 2, 2, 0]
    assert apply(spark, [0.0, 2.0, None, -1.0], numbers.flag, "double") == [0, 1, 0, 0]
    assert apply(spark, [1.0, inf, -inf, nan, None], numbers.finite_or_null, "double") == [1.0, None, None, None, None]
    assert apply(spark, [1_500_000.0], numbers.micros_to_units, "double") == [1.5]


def test_logins(spark):
    values = ["a_b.c", "12345", "a b", "", None, "  x-1 ", "имя"]
    assert apply(spark, values, lambda c: text.sanitize_login(c)[0]) == ["a-b-c", None, None, None, None, "x-1", None]
    errors = [None, "login_digits_only", "login_invalid_chars", "login_required", "login_required", None, "login_invalid_chars"]
    assert apply(spark, values, lambda c: text.sanitize_login(c)[1]) == errors
    assert apply(spark, values, text.login_canonical) == ["a-b-c", "12345", "a b", None, None, "x-1", "имя"]


def test_types(spark):
    df = spark.createDataFrame([("a", "b"), ("a", ""), (" ", "b"), (None, None)], "s string, t string")
    got = [r[0] for r in df.select(text.compose_type(F.col("s"), F.col("t"))).collect()]
    assert got == ["a:b", "a", "b", None]
    assert apply(spark, ["a:b:c", "a", ":b", "a:", None], lambda c: text.split_type(c)[0]) == ["a", "a", None, "a", None]
    assert apply(spark, ["a:b:c", "a", ":b", "a:", None], lambda c: text.split_type(c)[1]) == ["b:c", None, "b", None, None]


@pytest.mark.parametrize(
    ("args", "kept"),
    [
        (("ads", None, False), ["ads", "ads:x"]),
        (("ads", None, True), ["ads", "ads:x", None]),
        (("ads", "x", True), ["ads:x"]),
        ((None, "x", False), ["x"]),
        ((None, None, True), [None]),
    ],
)
def test_type_predicate(spark, args, kept):
    df = spark.createDataFrame([("ads",), ("ads:x",), ("adsx",), ("x",), (None,)], "type string")
    assert [r.type for r in df.where(text.type_predicate(F.col("type"), *args)).collect()] == kept


def test_type_predicate_without_restriction():
    assert text.type_predicate(None, None, " ", False) is None


def test_tokens(spark):
    values = [None, "  ", "ab", "abc", "abcdefgh", "abcdefghi"]
    assert apply(spark, values, text.mask_token) == ["<empty>", "<empty>", "***", "a***c", "a***h", "abcd...fghi"]
    assert apply(spark, ["abc"], text.token_fingerprint) == ["a9993e36"]


def test_goals_urls_words(spark):
    assert apply(spark, ["xMAddx", "other", None], text.goal_class) == ["g", "u", "u"]
    assert apply(spark, ["u_goal_12", "ym:s:goal7visits", "goal_x", "goal_12_b"], text.goal_id_of) == [12, 7, None, None]
    urls = ["https://www.a.ru/x", "http://b.ru", "b.ru/x", "ftp://c.ru", None, "https://www.a.ru"]
    assert apply(spark, urls, text.url_domain) == ["a.ru", "b.ru", None, None, None, "a.ru"]
    assert apply(spark, ["None", "none", " ", "", "(not set)", None], text.null_words) == [None, "none", " ", None, None, None]
    assert apply(spark, ["x", " "], lambda c: text.null_words(c, blank=True)) == ["x", None]
    assert apply(spark, [" None ", "null", "", "a", None], text.clean_access_value) == [None, None, None, "a", None]
    assert apply(spark, ["5", " 7 ", "0", "-1", "x", "1.0", None], text.positive_key) == [5, 7, None, None, None, None, None]


def test_dates(spark):
    assert apply(spark, ["2024-02-29", "2023-02-29", "oops", "2024-01-01 10:00:00", None], dates.parse_day) == [date(2024, 2, 29), None, None, None, None]
    assert apply(spark, ["31/12/2023 23:59:59", "31/02/2024 00:00:00", "2024-01-01"], dates.parse_call_ts) == [datetime(2023, 12, 31, 23, 59, 59), None, None]
    # an hour that a time zone skips is still a wall-clock time
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert apply(spark, ["2024-03-31 02:30:00", "bad"], dates.parse_visit_ts) == [datetime(2024, 3, 31, 2, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert apply(spark, [date(2024, 3, 1)], dates.year_month, "date") == ["202403"]


def test_labels(spark):
    assert apply(spark, [1, 4, 9, None], labels.device_label, "int") == ["десктоп", "TV", "9", None]
    assert apply(spark, ["Люди", "Роботы", "?", None], labels.robot_flag) == [0, 1, 0, 0]


def test_list_literals(spark):
    assert apply(spark, ["[1,2,1]", "[]", "x", None], nested.list_of_longs) == [[1, 2, 1], [], None, None]
    assert apply(spark, [r"[\'a\',\'b\']", "['c']", "[]"], nested.list_of_strings) == [["a", "b"], ["c"], []]


def test_tags_and_comments(spark):
    tags = [
        [("c", "t", ["n", "", None]), (None, "u", None), ("", None, ["m"])],
        [],
        None,
    ]
    kind = nested.TAGS_TYPE
    assert apply(spark, tags, nested.tag_category, kind) == ["c", "", ""]
    assert apply(spark, tags, nested.tag_type, kind) == ["t, u", "", ""]
    assert apply(spark, tags, nested.tag_names, kind) == ["n, m", "", ""]
    assert apply(spark, [[("x",), ("y",)], [(None,)], [], None], nested.first_comment, nested.COMMENTS_TYPE) == ["x", "", "", ""]


def flat(spark, values, targets):
    df = spark.createDataFrame([(v,) for v in values], "base string")
    return [tuple(r) for r in nested.flatten_json(df, ["base"], targets).collect()]


def test_flatten_json(spark):
    values = ['{"k":1,"in":{"a_b":"x","e":{}}}', '{"in":"{\\"a_b\\": 2}"}', '{"k":{}}', "{}", "oops", None, '{"in_a_b":7,"in":{"a_b":8}}']
    assert flat(spark, values, ["base_k", "base_in_a_b", "base_in_e"]) == [
        ("1", "x", "{}"), (None, "2", None), ("{}", None, None), (None, None, None), (None, None, None), (None, None, None), (None, "7", None)
    ]


def test_flatten_json_levels_and_repeated_paths(spark):
    deep = '{"a":{"b":{"c":"deep"}},"a_b":{"c":"first"}}'
    assert flat(spark, [deep], ["base_a_b_c"]) == [("first",)]
    assert flat(spark, ['{"a":{"b":{"c":"deep"}}}'], ["base_a_b_c"]) == [("deep",)]
    assert flat(spark, [r'{"a":{"b":{"c":"{\"d\":1}"}}}'], ["base_a_b_c_d"]) == [("1",)]
    assert flat(spark, ['{"a":{"b_c":"one"},"a_b":{"c":"two"}}'], ["base_a_b_c"]) == [("one",)]


def test_aliases_and_structs(spark):
    df = spark.createDataFrame([(None, 2, 3), (1, None, None)], "base_vk_goals int, base_goals int, base_conversions int")
    out = nested.coalesce_aliases(df, "base_vk_goals", nested.GOAL_ALIASES)
    assert [r.base_vk_goals for r in out.collect()] == [2, 1]
    assert nested.coalesce_aliases(df, "x", ["absent"]).columns == df.columns
    s = spark.sql("SELECT named_struct('a', named_struct('b', 1), 'c', array(1)) AS x, 2 AS y")
    assert nested.flatten_structs(s).columns == ["x.a.b", "x.c", "y"]


def test_frames(spark):
    df = spark.createDataFrame([("5", "x", 1)], "`ym:s:a` string, b string, Conversions_1 int")
    df = frames.strip_prefix(df, "ym:s:")
    assert df.columns == ["a", "b", "Conversions_1"]
    assert frames.align(df, {"b": "string", "n": "bigint", "a": "bigint"}, {"n": 0}).collect() == [("x", 0, 5)]
    assert frames.ensure_columns(df, {"a": "string", "z": "double"}).columns == ["a", "b", "Conversions_1", "z"]
    assert frames.drop_known(df, ["b", "nope"]).columns == ["a", "Conversions_1"]
    assert frames.select_prefix(df, "conv", ignore_case=True) == ["Conversions_1"] and frames.select_prefix(df, "conv") == []
    assert frames.metric_columns(df, ["A"], ["conversions_"]) == ["a", "Conversions_1"]
    assert frames.cast_present(df, {"a": "bigint", "zz": "bigint"}).dtypes[0] == ("a", "bigint")


def test_lists_with_either_quote_inside(spark):
    df = spark.createDataFrame([("""['a"b','c']""",), ("""["it's"]""",), (r"""['it\'s']""",)], "v string")
    assert [r[0] for r in df.select(nested.list_of_strings(F.col("v"))).collect()] == [['a"b', "c"], ["it's"], ["it's"]]
