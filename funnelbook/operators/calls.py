"""Calls and leads to one canonical table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_call_ts
from ..functions.frames import drop_known, ensure_columns
from ..functions.nested import COMMENTS_TYPE, TAGS_TYPE, first_comment, flatten_structs, tag_category, tag_names, tag_type
from ..functions.numbers import number_or_null
from ..functions.text import null_words, url_domain

# Columns of the raw payloads that are not kept, and their canonical names.
CALL_DROPS = (
    "redirectNumber", "callphase", "callerNumber", "phoneNumber", "customFields", "ctGlobalId", "phonesInText",
    "dcm", "callbackInfo", "siteId", "yandexDirect", "googleAdWords", "timestamp", "mapVisits", "attrs", "ip",
    "callReferenceId", "orders", "order", "sipCallId", "userAgent", "poolType", "ctCallerId", "callUrl",
    "utmSource", "utmMedium", "phrases", "callClientUniqueId", "subPoolName", "clientId", "ctClientId",
    "statusDetails", "sessionDate", "siteName", "hostname", "waitingConnect",
)
CALL_NAMES = {
    "callTags": "tags", "duration": "CallDuration", "successful": "CallSuccessful", "keyword": "keywords",
}
LEAD_DROPS = (
    "date", "siteId", "mapVisits", "dcm", "ctGlobalId", "widgetInfo", "customFields", "client.fio",
    "client.phones", "client.contacts", "session.ip", "session.attrs", "yandexDirect", "googleAdWords", "order",
    "requestUrl", "ctClientId", "orders", "status", "session.utmSource", "session.utmMedium",
    "session.sessionDate", "session.guaClientId", "session.browser", "session.ctGlobalId", "client.clientId",
    "hostname", "requestNumber", "requestType",
)
LEAD_NAMES = {
    "dateStr": "date", "RequestTags": "tags", "session.sessionId": "sessionId", "session.keywords": "keywords",
    "session.city": "city", "session.source": "source", "session.medium": "medium", "session.ref": "ref",
    "session.url": "url", "session.utmTerm": "utmTerm", "session.utmContent": "utmContent",
    "session.utmCampaign": "utmCampaign", "session.attribution": "attribution",
    "session.additionalTags": "additionalTags", "session.yaClientId": "yaClientId", "session.device": "device",
    "session.os": "os", "session.browserName": "browser",
}
FLAGS = (
    "uniqTargetRequest", "uniqueRequest", "targetRequest", "uniqueCall", "targetCall", "uniqTargetCall",
    "callbackCall", "CallSuccessful",
)
LONGS = ("CallDuration", "attribution", "requestId", "sessionId", "callId")
STRINGS = (
    "additionalTags", "manager", "subject", "yaClientId", "city", "browser", "device", "os", "keywords", "ref",
    "url", "source", "medium", "utmTerm", "utmContent", "utmCampaign",
)
CANONICAL = (
    "tag_category", "tag_type", "tag_names", "additionalTags", "comment_text", "manager", "attribution",
    "uniqTargetRequest", "uniqueRequest", "targetRequest", "uniqueCall", "targetCall", "uniqTargetCall",
    "callbackCall", "CallSuccessful", "CallDuration", "subject", "requestId", "sessionId", "callId", "yaClientId",
    "city", "browser", "device", "os", "keywords", "ref", "url", "source", "medium", "utmTerm", "utmContent",
    "utmCampaign",
)


def _prepare(df: DataFrame, drops: tuple[str, ...], names: dict[str, str]) -> DataFrame:
    flat = drop_known(flatten_structs(df), drops)
    flat = flat.toDF(*[names.get(c, c) for c in flat.columns])
    types = {"tags": TAGS_TYPE, "comments": COMMENTS_TYPE, "date": "string"}
    types |= dict.fromkeys(STRINGS + LONGS + FLAGS, "string")
    flat = ensure_columns(flat, types)
    keep = [c for c in ("client",) if c in flat.columns]
    return flat.select(*keep, *[F.col(c).cast(t).alias(c) for c, t in types.items()])


def calls_leads(calls: DataFrame, leads: DataFrame) -> DataFrame:
    """Canonical event table: ``Date``, ``event_ts``, the canonical columns and ``domain``.

    Either side may lack any column. Missing flags are false, ``CallSuccessful`` included.
    The time of day stays in ``event_ts``.
    """
    both = _prepare(leads, LEAD_DROPS, LEAD_NAMES).unionByName(_prepare(calls, CALL_DROPS, CALL_NAMES), allowMissingColumns=True)
    ts = parse_call_ts(F.col("date"))
    derived = {
        "tag_category": null_words(tag_category(F.col("tags"))),
        "tag_type": null_words(tag_type(F.col("tags"))),
        "tag_names": null_words(tag_names(F.col("tags"))),
        "comment_text": null_words(first_comment(F.col("comments"))),
    }
    derived |= {c: F.coalesce(F.col(c).try_cast("boolean"), F.lit(False)) for c in FLAGS}
    derived |= {c: number_or_null(F.col(c)).try_cast("bigint") for c in LONGS}
    derived |= {c: null_words(F.col(c)) for c in STRINGS}
    keep = [F.col(c) for c in ("client",) if c in both.columns]
    return both.select(
        *keep,
        ts.cast("date").alias("Date"),
        ts.alias("event_ts"),
        *[derived[c].alias(c) for c in CANONICAL],
        null_words(url_domain(F.col("url"))).alias("domain"),
    )
