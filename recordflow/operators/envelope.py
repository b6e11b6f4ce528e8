"""Change-event envelopes: replay offset, payload, routing and dead-letter rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recordflow.functions.columns import compute_once
from recordflow.functions.variants import is_number, is_object, number_to_long

CHANGE_KINDS = ("created", "updated", "deleted")
NOT_AN_OBJECT = "not an object"


def replay_offset(doc: Column) -> Column:
    """``event.replayId`` of a parsed event as a long, 0 when it is not a JSON number."""
    raw = F.variant_get(doc, "$.event.replayId", "variant")
    return F.coalesce(F.when(is_number(raw), number_to_long(raw)), F.lit(0).cast("bigint"))


def with_replay_offset(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``replay_id`` next to the raw text."""
    parsed = df.select("*", F.try_parse_json(F.col(value)).alias("_doc"))
    return parsed.select(*df.columns, replay_offset(F.col("_doc")).alias("replay_id"))


def from_offset(df: DataFrame, start: int | None) -> DataFrame:
    """Keep events at or after ``start``.

    Events without a usable offset are kept too, so that they reach the dead letter. With no
    start the frame is returned as it is.
    """
    if start is None:
        return df
    return df.filter((F.col("replay_id") >= F.lit(start)) | (F.col("replay_id") == 0))


def subscribed(df: DataFrame, kinds: tuple[str, ...] = CHANGE_KINDS) -> DataFrame:
    """Keep events whose ``event.type`` is subscribed; events that name no type are kept."""
    change = F.try_variant_get(F.col("doc"), "$.event.type", "string")
    return df.filter(change.isNull() | change.isin(*kinds))


def payload(doc: Column) -> Column:
    """The record inside an envelope: the ``sobject`` member where the key exists, else the text."""
    return F.coalesce(F.variant_get(doc, "$.sobject", "variant"), doc)


def parse_events(df: DataFrame, value: str = "value") -> DataFrame:
    """Add the parsed event as ``doc``; NULL when the text is not JSON."""
    return compute_once(df, doc=F.try_parse_json(F.col(value)))


def route_events(df: DataFrame, value: str = "value", *, unwrap: bool = True) -> DataFrame:
    """Failsafe parse: every event comes out once, with ``payload`` or ``error_message``.

    ``value`` keeps the original text, so nothing is lost on the failed route. Without
    ``unwrap`` the whole object is the payload.
    """
    parsed = df if "doc" in df.columns else parse_events(df, value)
    doc = F.col("doc")
    inner = payload(doc) if unwrap else doc
    error = (
        F.when(doc.isNull(), F.concat(F.lit("invalid JSON: "), F.coalesce(value, F.lit(""))))
        .when(~is_object(inner), F.lit(NOT_AN_OBJECT))
    )
    return compute_once(parsed, payload=inner, error_message=error)


def good(routed: DataFrame) -> DataFrame:
    """The parsed route."""
    return routed.filter(F.col("error_message").isNull())


def failed(routed: DataFrame) -> DataFrame:
    """The failed route."""
    return routed.filter(F.col("error_message").isNotNull())


def dead_letters(
    failures: DataFrame,
    *,
    payload: str = "value",
    message: str = "error_message",
    stacktrace: str | None = None,
    stamped: str = "ingest_ts",
) -> DataFrame:
    """Rows for the dead-letter table; payload columns are NULL when the payload is."""
    text = F.col(payload)
    trace = F.col(stacktrace) if stacktrace else F.lit(None)
    return failures.select(
        F.col(stamped).cast("timestamp").alias("timestamp"),
        text.alias("payloadString"),
        F.encode(text, "UTF-8").alias("payloadBytes"),
        F.array().cast("array<struct<key:string,value:string>>").alias("attributes"),
        F.col(message).cast("string").alias("errorMessage"),
        trace.cast("string").alias("stacktrace"),
    )


def stamp_text(ts: Column) -> Column:
    """Timestamp text with microseconds."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def flatten(*frames: DataFrame) -> DataFrame:
    """Bag union of any number of frames, matched by column name."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first
