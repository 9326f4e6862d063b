"""Column functions on whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..functions.dates import age_days, parse_call_ts, parse_day, year_month
from ..functions.labels import device_label, robot_flag
from ..functions.nested import list_of_longs, list_of_strings
from ..functions.numbers import flag, int64_or_zero, lenient_double, lenient_long, micros_to_units, round_half_even
from ..functions.text import (
    clean_access_value, compose_type, goal_class, goal_id_of, login_canonical, login_to_api, login_to_table, mask_token, null_words,
    positive_key, sanitize_login, split_type, token_fingerprint, url_domain,
)
from .base import query, table

LOGIN = """CASE WHEN c_acctbal < -900 THEN NULL WHEN c_acctbal < -800 THEN '  ' WHEN c_acctbal < -700 THEN ' None '
                WHEN c_acctbal < -500 THEN CAST(c_custkey AS STRING) WHEN c_acctbal < 0 THEN 'bad login ' || CAST(c_custkey AS STRING)
                WHEN c_acctbal < 1000 THEN ' ' || replace(c_name, '#', '_') || '.x ' ELSE replace(c_name, '#', '-') END"""


@query(
    "login_forms",
    f"""WITH x AS (SELECT c_custkey AS id, {LOGIN} AS login, lower(c_mktsegment) AS seg FROM {{customer}}),
             y AS (SELECT *, translate(COALESCE(regexp_replace(login, '^\\s+|\\s+$', '', 'g'), ''), '_.', '--') AS t FROM x),
             z AS (SELECT *, CASE WHEN t = '' THEN 'login_required' WHEN regexp_full_match(t, '[0-9]+') THEN 'login_digits_only'
                                  WHEN NOT regexp_full_match(t, '[A-Za-z0-9-]+') THEN 'login_invalid_chars' END AS error FROM y)
        SELECT id, COALESCE(CASE WHEN error IS NULL THEN t END, '-') AS login, COALESCE(error, '-') AS error,
               COALESCE(translate(login, '-', '_'), '-') AS table_form, COALESCE(translate(login, '_', '-'), '-') AS api_form,
               COALESCE(NULLIF(t, ''), '-') AS canonical,
               COALESCE(CASE WHEN lower(trim(login)) NOT IN ('none', 'null', 'nan', '') THEN trim(login) END, '-') AS cleaned,
               COALESCE(CASE WHEN regexp_full_match(trim(login), '\\+?[0-9]+') AND CAST(trim(login) AS BIGINT) > 0 THEN CAST(trim(login) AS BIGINT) END, -1) AS key_number,
               CASE WHEN seg = 'building' THEN 'ads' WHEN seg = 'machinery' THEN seg ELSE 'ads:' || seg END AS composed,
               CASE WHEN seg = 'machinery' THEN seg ELSE 'ads' END AS service,
               CASE WHEN seg IN ('building', 'machinery') THEN '-' ELSE seg END AS subtype
        FROM z""",
)
def q_login_forms(spark, sf):
    seg = F.lower("c_mktsegment")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.expr(LOGIN).alias("login"), seg.alias("seg"))
    valid, error = sanitize_login(F.col("login"))
    service_in = F.when(F.col("seg") == "machinery", " ").otherwise(F.lit("ads"))
    composed = compose_type(service_in, F.when(F.col("seg") != "building", F.col("seg")))
    service, subtype = split_type(F.col("composed"))
    dash = F.lit("-")
    return rows.withColumn("composed", composed).select(
        "id",
        F.coalesce(valid, dash).alias("login"),
        F.coalesce(error, dash).alias("error"),
        F.coalesce(login_to_table(F.col("login")), dash).alias("table_form"),
        F.coalesce(login_to_api(F.col("login")), dash).alias("api_form"),
        F.coalesce(login_canonical(F.col("login")), dash).alias("canonical"),
        F.coalesce(clean_access_value(F.col("login")), dash).alias("cleaned"),
        F.coalesce(positive_key(F.col("login")), F.lit(-1)).alias("key_number"),
        "composed",
        service.alias("service"),
        F.coalesce(subtype, dash).alias("subtype"),
    )


@query(
    "url_domain",
    r"""SELECT page_id, COALESCE(NULLIF(regexp_extract(url, '^https?://(?:www\.)?([^/]+)', 1), ''), '-') AS domain FROM {pages}""",
)
def q_url_domain(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.coalesce(url_domain(F.col("url")), F.lit("-")).alias("domain"))


TOKEN = "CASE WHEN o_orderstatus = 'P' THEN o_orderpriority WHEN o_orderstatus = 'F' THEN '' ELSE ' ' || left(CAST(o_orderkey AS STRING), 2) || ' ' END"


@query(
    "token_mask",
    f"""WITH x AS (SELECT o_orderkey, {TOKEN} AS token FROM {{orders}}), y AS (SELECT *, trim(token) AS t FROM x)
        SELECT o_orderkey, CASE WHEN length(t) = 0 THEN '<empty>' WHEN length(t) <= 2 THEN '***'
                                WHEN length(t) <= 8 THEN t[1] || '***' || t[-1] ELSE left(t, 4) || '...' || right(t, 4) END AS masked,
               left(sha1(token), 8) AS fingerprint FROM y""",
)
def q_token_mask(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", F.expr(TOKEN).alias("token"))
    return rows.select("o_orderkey", mask_token(F.col("token")).alias("masked"), token_fingerprint(F.col("token")).alias("fingerprint"))


GOAL_NAME = "CASE WHEN p_size % 3 = 0 THEN 'MAdd ' || p_name ELSE p_name END"
GOAL_COLUMN = """CASE WHEN p_size % 4 = 0 THEN 'u_goal_' || CAST(p_partkey AS STRING) WHEN p_size % 4 = 1 THEN 'ym:s:goal' || CAST(p_partkey AS STRING) || 'visits'
                      WHEN p_size % 4 = 2 THEN 'goal_' || CAST(p_partkey AS STRING) || '_x' ELSE p_name END"""


@query(
    "goal_class",
    f"""SELECT p_partkey, CASE WHEN contains(lower({GOAL_NAME}), 'madd') THEN 'g' ELSE 'u' END AS class,
               CASE WHEN p_size % 4 IN (0, 1) THEN p_partkey ELSE -1 END AS goal_id FROM {{part}}""",
)
def q_goal_class(spark, sf):
    rows = table(spark, sf, "part")
    return rows.select(
        "p_partkey",
        goal_class(F.expr(GOAL_NAME)).alias("class"),
        F.coalesce(goal_id_of(F.expr(GOAL_COLUMN)), F.lit(-1)).alias("goal_id"),
    )


NUMBER = """CASE l_returnflag WHEN 'A' THEN CAST(l_orderkey AS STRING) WHEN 'N' THEN ' ' || CAST(CAST(l_quantity AS INT) AS STRING) || '.5 '
                 ELSE CASE l_linenumber WHEN 1 THEN '--' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN '99999999999999999999'
                           WHEN 5 THEN '12d' WHEN 6 THEN '-' || CAST(l_orderkey AS STRING) ELSE 'abc' END END"""


@query(
    "lenient_numbers",
    f"""WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_extendedprice AS BIGINT) AS price, {NUMBER} AS raw FROM {{lineitem}}),
             y AS (SELECT *, CASE WHEN regexp_full_match(trim(raw), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS d,
                          CASE WHEN regexp_full_match(raw, '[+-]?[0-9]+') THEN TRY_CAST(raw AS BIGINT) END AS n FROM x)
        SELECT l_orderkey, l_linenumber, l_partkey, COALESCE(n, 0) AS strict_long,
               COALESCE(n, CASE WHEN ABS(d) < 9e18 THEN CAST(TRUNC(d) AS BIGINT) END, 0) AS lenient_long, COALESCE(d, 0) AS lenient_double,
               CASE WHEN d > 0 THEN 1 ELSE 0 END AS flag, CAST(round_even(CAST(l_partkey AS DOUBLE) / 2, 0) AS BIGINT) AS half_even,
               CAST(l_partkey AS DOUBLE) / 1000000 AS units
        FROM y""",
)
def q_lenient_numbers(spark, sf):
    raw = F.col("raw")
    rows = table(spark, sf, "lineitem").withColumn("raw", F.expr(NUMBER))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        int64_or_zero(raw).alias("strict_long"),
        lenient_long(raw).alias("lenient_long"),
        lenient_double(raw).alias("lenient_double"),
        flag(lenient_double(raw)).alias("flag"),
        round_half_even(F.col("l_partkey") / 2).alias("half_even"),
        micros_to_units(F.col("l_partkey").cast("double")).alias("units"),
    )


@query(
    "code_labels",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              CASE l_linenumber WHEN 1 THEN 'десктоп' WHEN 2 THEN 'мобильные телефоны' WHEN 3 THEN 'планшеты' WHEN 4 THEN 'TV'
                                ELSE CAST(l_linenumber AS STRING) END AS device,
              CASE l_returnflag WHEN 'A' THEN 1 ELSE 0 END AS robot FROM {lineitem}""",
)
def q_code_labels(spark, sf):
    robot = F.when(F.col("l_returnflag") == "A", "Роботы").when(F.col("l_returnflag") == "N", "Люди").otherwise("?")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", device_label(F.col("l_linenumber")).alias("device"), robot_flag(robot).alias("robot")
    )


WORD = """CASE WHEN p_size < 5 THEN 'None' WHEN p_size < 10 THEN '<не указано>' WHEN p_size < 15 THEN '(not set)' WHEN p_size < 18 THEN ''
               WHEN p_size < 20 THEN '  ' WHEN p_size < 25 THEN 'none of it' ELSE p_type END"""


@query(
    "null_sentinels",
    f"""SELECT p_partkey, COALESCE(CASE WHEN p_size >= 18 THEN {WORD} END, '<null>') AS exact,
               COALESCE(CASE WHEN p_size >= 20 THEN {WORD} END, '<null>') AS with_blank FROM {{part}}""",
)
def q_null_sentinels(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.expr(WORD).alias("w"))
    return rows.select(
        "p_partkey",
        F.coalesce(null_words(F.col("w")), F.lit("<null>")).alias("exact"),
        F.coalesce(null_words(F.col("w"), blank=True), F.lit("<null>")).alias("with_blank"),
    )


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
              CASE WHEN o_orderstatus = 'P' THEN 'bad' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:20:30' END AS call_ts,
              strftime(o_orderdate, '%Y%m') AS year_month, DATE '2002-01-01' - CAST(o_orderdate AS DATE) AS age FROM {orders}""",
)
def q_date_parts(spark, sf):
    day_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    call_text = F.when(F.col("o_orderstatus") == "P", "31/02/2000 10:00:00").otherwise(
        F.concat(F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit(" 10:20:30"))
    )
    day = parse_day(day_text)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        day.alias("day"),
        F.coalesce(parse_call_ts(call_text).cast("string"), F.lit("bad")).alias("call_ts"),
        year_month(day).alias("year_month"),
        age_days(F.lit(date(2002, 1, 1)), day).cast("bigint").alias("age"),
    )


@query(
    "array_literals",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN '' ELSE CAST(user_id AS STRING) || '|' || CAST(event_id AS STRING) END AS ids,
              CASE WHEN event_type = 'view' THEN 0 ELSE 2 END AS n, event_type || '|x' AS words FROM {events}""",
)
def q_array_literals(spark, sf):
    ids = F.when(F.col("event_type") == "view", "[]").otherwise(F.concat(F.lit("["), "user_id", F.lit(","), "event_id", F.lit("]")))
    words = F.concat(F.lit("[\\'"), "event_type", F.lit("\\','x']"))
    parsed = table(spark, sf, "events").select("event_id", list_of_longs(ids).alias("i"), list_of_strings(words).alias("w"))
    return parsed.select("event_id", F.array_join(F.col("i").cast("array<string>"), "|").alias("ids"), F.size("i").alias("n"), F.array_join("w", "|").alias("words"))
