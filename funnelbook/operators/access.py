"""Credential and user tables. Each operator maps a stored frame to a new one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_access_value, compose_type, login_canonical, split_type, type_predicate
from ..plans.skew import skew_join

COLUMNS = ("login", "token", "container", "type")

# Rank of the credential kinds for ads, and the kinds of an agency row for visits.
ADS_PRIORITY = {"not_agency_token": 2, "agency_parsed": 1}
AGENCY_PARSED = "agency_parsed"
AGENCY_SUBTYPES = ("agency", "agency_token")


def with_service(access: DataFrame) -> DataFrame:
    service, subtype = split_type(F.col("type"))
    return access.withColumns({"service": service, "subtype": subtype})


def read_access(
    access: DataFrame,
    service: str | None = None,
    subtypes: Sequence[str] = (),
    container: str | None = None,
    include_null_type: bool = False,
) -> DataFrame:
    """Credential rows of a service, with the type split in two."""
    tests = [type_predicate(F.col("type"), service, s, include_null_type) for s in (subtypes or (None,))]
    tests = [t for t in tests if t is not None]
    if tests:
        keep = tests[0]
        for t in tests[1:]:
            keep = keep | t
        access = access.where(keep)
    if container is not None:
        access = access.where(F.col("container") == container)
    return with_service(access)


def prepare_import(df: DataFrame) -> DataFrame:
    """Clean an uploaded credential table; the row kind says whether it is kept.

    Headers are lower-cased; ``login`` and ``token`` are required, the rest is optional. The
    type is composed from ``service`` and ``subtype`` where it is empty.
    """
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    missing = [c for c in ("login", "token") if c not in df.columns]
    if missing:
        raise ValueError("missing_columns:" + ",".join(missing))

    def value(c: str) -> Column:
        return clean_access_value(F.col(c)) if c in df.columns else F.lit(None).cast("string")

    cleaned = df.select(
        value("login").alias("login"),
        value("token").alias("token"),
        value("container").alias("container"),
        F.coalesce(value("type"), compose_type(value("service"), value("subtype"))).alias("type"),
    )
    empty = F.coalesce(*COLUMNS).isNull()
    return cleaned.withColumn(
        "status", F.when(empty, "dropped_empty").when(F.col("token").isNull(), "dropped_no_token").otherwise("kept")
    )


def import_access(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to store, one row of counts) of an uploaded credential table."""
    prepared = prepare_import(df)
    kept = F.col("status") == "kept"
    counts = prepared.agg(
        F.count_if(F.col("status") == "dropped_empty").alias("dropped_empty"),
        F.count_if(F.col("status") == "dropped_no_token").alias("dropped_no_token"),
        F.count_distinct(F.when(kept, F.struct(*COLUMNS))).alias("kept"),
    )
    return prepared.where(kept).select(*COLUMNS).distinct(), counts


def upsert_access(
    stored: DataFrame,
    incoming: DataFrame,
    service: str | None,
    subtype: str | None = None,
    *,
    replace: bool,
    containers: DataFrame | None = None,
) -> DataFrame:
    """Stored table after an upsert of (container, login, token).

    Only rows of the same type and of the containers concerned can change. With ``replace``
    such rows go when their login is not listed; a stored row without a login stays unless a
    login without value is listed. A login whose stored token is already the new one is left
    as it is. ``containers`` names the containers concerned when a list may be empty.
    """
    new_type = compose_type(F.lit(service), F.lit(subtype))
    include_null = not (service or "").strip() and not (subtype or "").strip()
    of_type = type_predicate(F.col("type"), service, subtype, include_null)

    inc = incoming.groupBy("container", "login").agg(F.max("token").alias("new_token"))
    scope = (inc if containers is None else containers).select("container").distinct().withColumn("__scope", F.lit(True))
    s, n = stored.alias("s"), scope.alias("n")
    marked = s.join(n, F.expr("s.container <=> n.container"), "left").select(
        *[F.col(f"s.{c}") for c in COLUMNS],
        (F.col("n.__scope").isNotNull() & F.coalesce(of_type if of_type is not None else F.lit(True), F.lit(False))).alias("in_scope"),
    )

    per_login = (
        marked.where("in_scope")
        .groupBy("container", "login")
        .agg(F.min("token").alias("lo"), F.max("token").alias("hi"), F.count_if(F.col("token").isNull()).alias("nulls"), F.count("*").alias("n"))
    )
    i, p = inc.alias("i"), per_login.alias("p")
    same = F.expr("i.container <=> p.container AND i.login <=> p.login")
    uniform = F.when(F.col("i.new_token").isNull(), F.col("p.nulls") == F.col("p.n")).otherwise(
        (F.col("p.nulls") == 0) & (F.col("p.lo") == F.col("i.new_token")) & (F.col("p.hi") == F.col("i.new_token"))
    )
    verdict = i.join(p, same, "left").select(
        "i.container", "i.login", "i.new_token", (~F.coalesce(uniform, F.lit(False))).alias("changed")
    )

    m, v = marked.alias("m"), verdict.alias("v")
    joined = m.join(v, F.expr("m.in_scope AND m.container <=> v.container AND m.login <=> v.login"), "left")
    listed = F.col("v.changed").isNotNull()
    unlisted_stays = F.lit(True) if not replace else F.col("m.login").isNull()
    stays = F.when(~F.col("m.in_scope"), True).when(listed, ~F.col("v.changed")).otherwise(unlisted_stays)
    if replace and containers is not None:
        # an empty list for a container clears it, rows without a login included
        filled = inc.select("container").distinct().withColumn("__filled", F.lit(True)).alias("f")
        joined = joined.join(filled, F.expr("m.container <=> f.container"), "left")
        stays = F.when(F.col("m.in_scope") & F.col("f.__filled").isNull(), False).otherwise(stays)
    kept = joined.where(stays).select(*[F.col(f"m.{c}") for c in COLUMNS])
    added = verdict.where("changed").select("login", F.col("new_token").alias("token"), "container", new_type.alias("type"))
    return kept.unionByName(added)


def delete_access(stored: DataFrame, login: str, service: str | None, subtype: str | None = None, container: str | None = None) -> DataFrame:
    """Stored table without the matching rows; an unset type or container does not restrict."""
    hit = F.col("login") == login
    kind = type_predicate(F.col("type"), service, subtype)
    if kind is not None:
        hit = hit & kind
    if container is not None:
        hit = hit & (F.col("container") == container)
    return stored.where(~F.coalesce(hit, F.lit(False)))


def refresh_agency(stored: DataFrame, client_lists: DataFrame, service: str) -> DataFrame:
    """Store the clients of each agency: (container, token, logins[]) becomes ``agency_parsed`` rows."""
    lists = client_lists.where(F.col("token").isNotNull() & (F.col("token") != ""))
    each = lists.select("container", "token", F.explode("logins").alias("raw"))
    incoming = each.select("container", login_canonical(F.col("raw")).alias("login"), "token").where(F.col("login").isNotNull())
    return upsert_access(stored, incoming, service, AGENCY_PARSED, replace=True, containers=lists.select("container"))


def pick_credential(
    access: DataFrame, service: str, order: Sequence[str], priority: Mapping[str, int] = ADS_PRIORITY
) -> DataFrame:
    """The best credential of each login; equal ranks are decided by ``order``, highest last value wins."""
    rows = with_service(access).withColumn("login", login_canonical(F.col("login")))
    rows = rows.where(
        F.col("login").isNotNull()
        & (F.coalesce("token", F.lit("")) != "")
        & (F.col("service").isNull() | (F.col("service") == service))
        & (F.col("subtype").isNull() | F.col("subtype").isin(*priority))
    )
    rank = F.lit(0)
    for kind, value in priority.items():
        rank = F.when(F.col("subtype") == kind, value).otherwise(rank)
    w = Window.partitionBy("login").orderBy(rank.desc(), *[F.col(c).desc_nulls_last() for c in order])
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def agencies(access: DataFrame, service: str, order: Sequence[str]) -> DataFrame:
    """One credential per agency id: rows of the service or without a type."""
    rows = with_service(access).where(
        (F.coalesce("login", F.lit("")) != "")
        & (F.coalesce("token", F.lit("")) != "")
        & (F.col("service").isNull() | (F.col("service") == service))
    )
    w = Window.partitionBy("login").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    best = rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1")
    return best.select(F.col("login").alias("client_id"), F.col("token").alias("client_secret"), F.nullif("container", F.lit("")).alias("container"))


def _number(c: str) -> Column:
    return F.when(F.trim(F.col(c)).rlike(r"^[+-]?[0-9]+$"), F.trim(F.col(c)).try_cast("bigint"))


def split_access(access: DataFrame, service: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(explicit counters, agency rows): a numeric login or container names a counter."""
    rows = read_access(access, service, include_null_type=True).where(F.coalesce("token", F.lit("")) != "")
    rows = rows.withColumn("counter_id", F.coalesce(_number("login"), _number("container")))
    w = Window.partitionBy("counter_id").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    explicit = (
        rows.where(F.col("counter_id").isNotNull())
        .withColumn("__rn", F.row_number().over(w))
        .where("__rn = 1")
        .select("counter_id", "token", F.coalesce(F.nullif("login", F.lit("")), "container", F.lit("")).alias("fact_login"))
    )
    agency = rows.where(F.col("counter_id").isNull() & (F.col("subtype").isin(*AGENCY_SUBTYPES) | F.col("login").isNull()))
    return explicit, agency.select(*COLUMNS)


def keep_favourites(explicit: DataFrame, favourites: DataFrame, forced: Sequence[int] = ()) -> DataFrame:
    """Explicit counters among the favourites or the forced ids; without either, all of them."""
    wanted = favourites.select(F.col("counter_id").cast("bigint")).where(F.col("counter_id").isNotNull()).distinct()
    listed = explicit.join(wanted.withColumn("__fav", F.lit(True)), "counter_id", "left")
    keep = F.col("__fav").isNotNull()
    if forced:
        keep = keep | F.col("counter_id").isin(*forced)
    else:
        keep = keep | (wanted.agg(F.count("*")).scalar() == 0)
    return listed.where(keep).drop("__fav").withColumn("source", F.lit("explicit_token"))


def with_legacy(counters: DataFrame, access: DataFrame, service: str) -> DataFrame:
    """The older layout (counter id in the container) as a fallback when no counter was found."""
    legacy = read_access(access, service, include_null_type=True).where(F.col("login").isNotNull() & F.col("token").isNotNull())
    legacy = legacy.select(_number("container").alias("counter_id"), "token", F.col("login").alias("fact_login"), F.lit("legacy_config").alias("source"))
    none_found = counters.agg(F.count("*")).scalar() == 0
    return counters.unionByName(legacy.where(F.col("counter_id").isNotNull() & none_found))


def lookup_access(keys: DataFrame, credentials: DataFrame) -> DataFrame:
    """Each key with its token; ``found`` is false for a miss."""
    joined = skew_join(credentials.select("login", "token"), keys, ["login"], "left")
    return joined.withColumn("found", F.col("token").isNotNull())


def latest(df: DataFrame, key: str, version: str, *ties: str) -> DataFrame:
    """Current row of each key in an append log; equal versions are decided by ``ties``, the largest first. The group limit before the shuffle keeps hot keys harmless."""
    w = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in (version, *ties)])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
