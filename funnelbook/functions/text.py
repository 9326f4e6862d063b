"""String functions for logins, types, tokens, goals and URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for "no value".
CALL_NULL_WORDS = ("None", "<не заполнено>", "<не указано>", "NaN", "", "(not set)", "(none)")
VISIT_NULL_WORDS = ("nan", "NaN", "None")
VISIT_UNDEFINED_WORDS = ("undefined", "Не определено")
ACCESS_NULL_WORDS = ("none", "null", "nan")

# Fixed value: a goal whose lower-cased name contains this text belongs to class "g".
GOAL_MARKER = "madd"


def strip(c: Column) -> Column:
    """Cut white space at both ends (``trim`` alone would cut blanks only)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def login_to_table(c: Column) -> Column:
    return F.translate(c, "-", "_")


def login_to_api(c: Column) -> Column:
    return F.translate(c, "_", "-")


def login_canonical(c: Column) -> Column:
    """The form logins are compared in: underscores and dots become hyphens."""
    return F.translate(blank_to_null(c), "_.", "--")


def sanitize_login(c: Column) -> tuple[Column, Column]:
    """(valid login, error code); exactly one of the two is non-null."""
    login = F.translate(F.coalesce(strip(c), F.lit("")), "_.", "--")
    # The error codes.
    error = (
        F.when(login == "", "login_required")
        .when(login.rlike("^[0-9]+$"), "login_digits_only")
        .when(~login.rlike("^[A-Za-z0-9-]+$"), "login_invalid_chars")
    )
    return F.when(error.isNull(), login), error


def compose_type(service: Column, subtype: Column) -> Column:
    """``service:subtype``, or whichever part is there."""
    return F.nullif(F.concat_ws(":", blank_to_null(service), blank_to_null(subtype)), F.lit(""))


def split_type(c: Column) -> tuple[Column, Column]:
    parts = F.split(c, ":", 2)
    return F.nullif(F.get(parts, F.lit(0)), F.lit("")), F.nullif(F.get(parts, F.lit(1)), F.lit(""))


def type_predicate(
    c: Column, service: str | None, subtype: str | None = None, include_null: bool = False
) -> Column | None:
    """Filter on a stored type; ``None`` when nothing restricts it.

    A service alone also matches its subtypes. With a subtype the match is exact and
    ``include_null`` has no effect.
    """
    service, subtype = (service or "").strip(), (subtype or "").strip()
    if service and not subtype:
        hit = (c == service) | c.startswith(f"{service}:")
        return hit | c.isNull() if include_null else hit
    if subtype:
        return c == (f"{service}:{subtype}" if service else subtype)
    return c.isNull() if include_null else None


def url_domain(c: Column) -> Column:
    """Host of an http(s) URL without ``www.``; null for anything else."""
    return F.nullif(F.regexp_extract(c, r"^https?://(?:www\.)?([^/]+)", 1), F.lit(""))


def mask_token(c: Column) -> Column:
    t = F.coalesce(strip(c), F.lit(""))
    n = F.length(t)
    # The shapes of a mask by length.
    return (
        F.when(n == 0, "<empty>")
        .when(n <= 2, "***")
        .when(n <= 8, F.concat(F.substring(t, 1, 1), F.lit("***"), F.right(t, F.lit(1))))
        .otherwise(F.concat(F.substring(t, 1, 4), F.lit("..."), F.right(t, F.lit(4))))
    )


def token_fingerprint(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 8)


def goal_class(name: Column) -> Column:
    return F.when(F.lower(name).contains(GOAL_MARKER), "g").otherwise("u")


def goal_id_of(name: Column) -> Column:
    """Goal id inside a column name (``..goal_<id>``) or a metric name (``..goal<id>visits``)."""
    text = F.coalesce(
        F.nullif(F.regexp_extract(name, r"goal_([0-9]+)$", 1), F.lit("")),
        F.nullif(F.regexp_extract(name, r"goal([0-9]+)visits", 1), F.lit("")),
    )
    return text.try_cast("bigint")


def clean_access_value(c: Column) -> Column:
    t = blank_to_null(c)
    return F.when(~F.lower(t).isin(*ACCESS_NULL_WORDS), t)


def positive_key(c: Column) -> Column:
    """The value as a positive whole number, else null."""
    n = F.when(strip(c).rlike(r"^\+?[0-9]+$"), strip(c).try_cast("bigint"))
    return F.when(n > 0, n)


def null_words(c: Column, words: Sequence[str] = CALL_NULL_WORDS, blank: bool = False) -> Column:
    """Null where the text is one of ``words`` (exact match), with ``blank`` also where it is white space."""
    hit = c.isin(*words)
    if blank:
        hit = hit | c.rlike(r"^\s*$")
    return F.when(~hit, c)
