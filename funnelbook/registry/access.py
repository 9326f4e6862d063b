"""Credentials and users."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.access import (
    agencies, delete_access, import_access, keep_favourites, latest, lookup_access, pick_credential, read_access, refresh_agency, split_access,
    upsert_access, with_legacy,
)
from ..operators.users import add_users, delete_users, users_by_role
from ..plans.warehouse import Warehouse
from ..session import shared_dir
from ..sources.access_files import access_export, export_csv, read_access_file
from .base import query, table, view

COLS = "COALESCE(login, '-') AS login, COALESCE(token, '-') AS token, COALESCE(container, '-') AS container, COALESCE(type, '-') AS type"


def _filled(df):
    return df.fillna("-")


@query(
    "access_scan",
    f"""SELECT {COLS}, COALESCE(split_part(type, ':', 1), '-') AS service, COALESCE(NULLIF(split_part(type, ':', 2), ''), '-') AS subtype
        FROM {{access}} WHERE type = 'ads' OR type LIKE 'ads:%' OR type IS NULL""",
)
def q_access_scan(spark, sf):
    return _filled(read_access(view(spark, sf, "access"), "ads", include_null_type=True).drop("seq"))


@query(
    "access_export",
    f"""SELECT {COLS}, COALESCE(split_part(type, ':', 1), '-') AS service, COALESCE(NULLIF(split_part(type, ':', 2), ''), '-') AS subtype
        FROM {{access}} ORDER BY 1, 3, 4, 2""",
)
def q_access_export(spark, sf):
    return _filled(access_export(view(spark, sf, "access")))


UPLOAD = """SELECT CASE WHEN c_acctbal < -900 THEN ' none ' WHEN c_acctbal < -800 THEN NULL ELSE ' ' || c_mktsegment END AS login,
                   CASE WHEN c_acctbal < -850 THEN '' WHEN c_acctbal > 9000 THEN 'NaN' ELSE 'tok-' || n_name END AS token,
                   CASE WHEN c_acctbal < -800 THEN 'null' ELSE n_name END AS container,
                   CASE WHEN c_mktsegment = 'BUILDING' THEN 'visits' END AS type,
                   CASE WHEN c_acctbal < -800 THEN NULL ELSE 'ads' END AS service,
                   CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 0 THEN 'agency_parsed' END AS subtype
            FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""
CLEAN = ", ".join(
    f"CASE WHEN lower(trim({c})) NOT IN ('', 'none', 'null', 'nan') THEN trim({c}) END AS {c}"
    for c in ("login", "token", "container", "type", "service", "subtype")
)
PREPARED = f"""WITH u AS ({UPLOAD}), cl AS (SELECT {CLEAN} FROM u),
    p AS (SELECT login, token, container, COALESCE(type, CASE WHEN service IS NOT NULL AND subtype IS NOT NULL THEN service || ':' || subtype
          ELSE COALESCE(service, subtype) END) AS type FROM cl)"""


def _upload(spark, sf):
    df = spark.sql(UPLOAD, customer=table(spark, sf, "customer"), nation=table(spark, sf, "nation"))
    return df.withColumnsRenamed({"login": "Login", "token": " TOKEN ", "type": "Type"})


@query("access_import", PREPARED + f" SELECT DISTINCT {COLS} FROM p WHERE token IS NOT NULL")
def q_access_import(spark, sf):
    return _filled(import_access(_upload(spark, sf))[0])


@query(
    "access_import_stats",
    PREPARED
    + """ SELECT COUNT(CASE WHEN COALESCE(login, token, container, type) IS NULL THEN 1 END) AS dropped_empty,
                 COUNT(CASE WHEN COALESCE(login, container, type) IS NOT NULL AND token IS NULL THEN 1 END) AS dropped_no_token,
                 (SELECT COUNT(*) FROM (SELECT DISTINCT login, token, container, type FROM p WHERE token IS NOT NULL) d) AS kept FROM p""",
)
def q_access_import_stats(spark, sf):
    return import_access(_upload(spark, sf))[1]


BEST = """best AS (SELECT login, token, ROW_NUMBER() OVER (PARTITION BY login ORDER BY rank DESC, seq DESC) AS rn FROM (
              SELECT translate(NULLIF(trim(login), ''), '_.', '--') AS login, token, seq,
                     CASE type WHEN 'ads:not_agency_token' THEN 2 WHEN 'ads:agency_parsed' THEN 1 ELSE 0 END AS rank
              FROM {access} WHERE type IS NULL OR type IN ('ads', 'ads:not_agency_token', 'ads:agency_parsed')) r
          WHERE login IS NOT NULL AND COALESCE(token, '') <> '')"""


@query("access_priority", f"WITH {BEST} SELECT login, token FROM best WHERE rn = 1")
def q_access_priority(spark, sf):
    return pick_credential(view(spark, sf, "access"), "ads", ["seq"]).select("login", "token")


@query(
    "access_lookup",
    f"""WITH {BEST}, keys AS (SELECT DISTINCT 'shop-' || replace(n_name, '_', '-') || '-' || CAST(o_custkey % 500 AS STRING) AS login
                              FROM {{orders}} JOIN {{nation}} ON o_custkey % 25 = n_nationkey)
        SELECT k.login, COALESCE(b.token, '-') AS token, b.token IS NOT NULL AS found
        FROM keys k LEFT JOIN (SELECT * FROM best WHERE rn = 1) b ON b.login = k.login""",
)
def q_access_lookup(spark, sf):
    orders, nation = table(spark, sf, "orders"), table(spark, sf, "nation")
    joined = orders.join(nation, orders.o_custkey % 25 == nation.n_nationkey)
    login = F.concat(F.lit("shop-"), F.translate("n_name", "_", "-"), F.lit("-"), (F.col("o_custkey") % 500).cast("string"))
    keys = joined.select(login.alias("login")).distinct()
    return _filled(lookup_access(keys, pick_credential(view(spark, sf, "access"), "ads", ["seq"])))


@query(
    "access_favourites",
    """SELECT CAST(login AS BIGINT) AS counter_id, token, login AS fact_login, 'explicit_token' AS source FROM {access}
       WHERE (type IS NULL OR type = 'visits' OR type LIKE 'visits:%') AND COALESCE(token, '') <> '' AND regexp_full_match(login, '[0-9]+')
         AND CAST(login AS BIGINT) IN (SELECT o_custkey FROM {orders} WHERE o_orderpriority = '1-URGENT')""",
)
def q_access_favourites(spark, sf):
    access = view(spark, sf, "access")
    explicit, _ = split_access(access, "visits", ["seq"])
    favourites = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("counter_id"))
    return with_legacy(keep_favourites(explicit, favourites), access, "visits")


INCOMING = """SELECT n_name AS container, 'shop-' || n_name || '-' || CAST(o_custkey % 500 AS STRING) AS login,
                     CASE WHEN MIN(o_custkey) = MAX(o_custkey) THEN 'tok-' || CAST(MIN(o_custkey) AS STRING) ELSE 'tok-new' END AS token
              FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
              WHERE o_orderpriority <> '5-LOW' GROUP BY 1, 2"""


def _upserted(kind: str, incoming: str) -> str:
    return f"""WITH inc AS ({incoming}),
        st AS (SELECT login, token, container, type, COALESCE(type = '{kind}' AND container IN (SELECT container FROM inc), FALSE) AS scoped FROM {{access}}),
        per AS (SELECT container, login, MIN(token) AS lo, MAX(token) AS hi, COUNT(*) - COUNT(token) AS nulls FROM st WHERE scoped GROUP BY container, login),
        v AS (SELECT i.*, NOT COALESCE(p.nulls = 0 AND p.lo = i.token AND p.hi = i.token, FALSE) AS changed
              FROM inc i LEFT JOIN per p ON p.container = i.container AND p.login = i.login),
        res AS (SELECT st.login, st.token, st.container, st.type FROM st LEFT JOIN v ON v.container = st.container AND v.login = st.login
                WHERE NOT scoped OR (v.changed IS NULL AND st.login IS NULL) OR NOT v.changed
                UNION ALL SELECT login, token, container, '{kind}' FROM v WHERE changed)
        SELECT {COLS} FROM res"""


@query("access_upsert", _upserted("ads:not_agency_token", INCOMING))
def q_access_upsert(spark, sf):
    incoming = spark.sql(INCOMING, **{t: table(spark, sf, t) for t in ("orders", "customer", "nation")})
    return _filled(upsert_access(view(spark, sf, "access"), incoming, "ads", "not_agency_token", replace=True))


@query("access_store", _upserted("ads:not_agency_token", INCOMING))
def q_access_store(spark, sf):
    incoming = spark.sql(INCOMING, **{t: table(spark, sf, t) for t in ("orders", "customer", "nation")})
    house = Warehouse(spark, buckets=1)
    house.write("accesses", view(spark, sf, "access").drop("seq"), ("type", "container", "login"))
    updated = upsert_access(house.read("accesses"), incoming, "ads", "not_agency_token", replace=True)
    house.replace_table("accesses", updated, ("type", "container", "login"))
    return _filled(house.read("accesses"))


CLIENT_LISTS = """SELECT n_name AS container, translate('new_' || n_name || '.' || CAST(c_custkey % 300 AS STRING), '_.', '--') AS login,
                         'agency-' || n_name AS token FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey GROUP BY 1, 2, 3"""


@query("agency_refresh", _upserted("ads:agency_parsed", CLIENT_LISTS))
def q_agency_refresh(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    name = F.concat(F.lit("new_"), "n_name", F.lit("."), (F.col("c_custkey") % 300).cast("string"))
    lists = joined.select(
        F.col("n_name").alias("container"), F.concat(F.lit("agency-"), "n_name").alias("token"), F.array(name, F.lit("  "), F.upper(F.lit(None))).alias("logins")
    )
    return _filled(refresh_agency(view(spark, sf, "access"), lists, "ads"))


@query(
    "access_delete",
    f"""SELECT {COLS} FROM {{access}} WHERE NOT COALESCE(login = 'shop-NATION_1-1' AND (type = 'ads' OR type LIKE 'ads:%'), FALSE)""",
)
def q_access_delete(spark, sf):
    return _filled(delete_access(view(spark, sf, "access").drop("seq"), "shop-NATION_1-1", "ads"))


USERS = "SELECT user_id AS id, 'u' || CAST(user_id % 40 AS STRING) AS name, event_type AS role, event_id AS version FROM {events}"


def _users(spark, sf):
    return spark.sql(USERS, events=table(spark, sf, "events"))


@query(
    "users_by_role",
    f"""WITH u AS ({USERS}) SELECT id, name, role FROM u
        WHERE role = 'click' AND version = (SELECT MAX(version) FROM u x WHERE x.id = u.id)""",
)
def q_users_by_role(spark, sf):
    return users_by_role(_users(spark, sf), "click")


@query(
    "users_add",
    f"""WITH u AS ({USERS}) SELECT c_custkey AS id, c_name AS name, c_mktsegment AS role, CAST(7 AS BIGINT) AS version FROM {{customer}}
        WHERE c_custkey > 0 AND c_custkey NOT IN (SELECT id FROM u)""",
)
def q_users_add(spark, sf):
    fresh = table(spark, sf, "customer").select(
        F.concat(F.lit(" "), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("role")
    )
    return add_users(_users(spark, sf), fresh, 7)


@query(
    "users_delete",
    f"""WITH u AS ({USERS}) SELECT * FROM u WHERE id NOT IN (SELECT s_suppkey FROM {{supplier}} WHERE s_acctbal > 5000 AND s_suppkey > 0)
        AND name NOT IN (SELECT 'u' || CAST(s_nationkey AS STRING) FROM {{supplier}} WHERE s_acctbal < 0)""",
)
def q_users_delete(spark, sf):
    supplier = table(spark, sf, "supplier")
    ids = supplier.where("s_acctbal > 5000").select(F.col("s_suppkey").cast("string").alias("identifier"))
    names = supplier.where("s_acctbal < 0").select(F.concat(F.lit("u"), F.col("s_nationkey").cast("string")).alias("identifier"))
    return delete_users(_users(spark, sf), ids.union(names))


@query(
    "latest_role",
    """SELECT user_id AS id, event_type AS role, event_id AS version FROM {events} e
       WHERE event_id = (SELECT MAX(event_id) FROM {events} x WHERE x.user_id = e.user_id)""",
)
def q_latest_role(spark, sf):
    users = table(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("role"), F.col("event_id").alias("version"))
    return latest(users, "id", "version", "role")


@query(
    "agencies",
    """SELECT client_id, client_secret, COALESCE(container, '-') AS container FROM (
           SELECT login AS client_id, token AS client_secret, NULLIF(container, '') AS container, ROW_NUMBER() OVER (PARTITION BY login ORDER BY seq DESC) AS n
           FROM {access} WHERE COALESCE(login, '') <> '' AND COALESCE(token, '') <> '' AND (type IS NULL OR split_part(type, ':', 1) = 'ads')) x WHERE n = 1""",
)
def q_agencies(spark, sf):
    return agencies(view(spark, sf, "access"), "ads", ["seq"]).fillna("-")


@query("access_files", PREPARED + f" SELECT DISTINCT {COLS} FROM p WHERE token IS NOT NULL")
def q_access_files(spark, sf):
    """An uploaded file is read, cleaned, put in the place of the stored table, exported, and read again."""
    folder = shared_dir(spark)
    export_csv(_upload(spark, sf), f"{folder}/upload")
    kept, _ = import_access(read_access_file(spark, f"{folder}/upload"))
    house = Warehouse(spark, buckets=1)
    house.write("access", view(spark, sf, "access").drop("seq"), ("login",))
    house.replace_table("access", kept, ("login",))
    export_csv(access_export(house.read("access")), f"{folder}/export", ["login", "container"])
    return _filled(read_access_file(spark, f"{folder}/export").select("login", "token", "container", "type"))
