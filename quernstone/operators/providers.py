"""The boundary to what isn't relational: a provider (OCR, a model, a parser) called for rows that need it.

A provider is a function from one request to one reply, both text.  Calls are retried, a
second provider can take over, and what fails falls back to a given reply; the status says
which.  Nothing here opens a network connection: providers are passed in.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Provider = Callable[[str], str]


def answered(rows: DataFrame, key: str, request: str, fallback: str, providers: list[Provider], tries: int = 3, wait: float = 1.0, cache: DataFrame | None = None) -> DataFrame:
    """(key, reply, status) for each row: status is cached, ok, fallback_no_provider or fallback_error.

    Equal requests are asked once.  ``cache`` (request_sha1, reply) holds replies of earlier runs.
    """
    asked = rows.select(F.sha1(F.coalesce(request, F.lit(""))).alias("request_sha1"), F.col(request).alias("request")).distinct()
    known = None
    if cache is not None:
        known = cache.select("request_sha1", "reply").withColumn("status", F.lit("cached"))
        asked = asked.join(known.select("request_sha1"), "request_sha1", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            replies, states = [], []
            for text in batch.column(1).to_pylist():
                reply, state = _ask(text, providers, tries, wait)
                replies.append(reply), states.append(state)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(replies, pa.string()), pa.array(states, pa.string())], names=["request_sha1", "reply", "status"])

    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("request_sha1", "reply", "status")])
    done = asked.select("request_sha1", "request").mapInArrow(run, schema)
    done = done if known is None else known.unionByName(done)
    out = rows.select(key, F.sha1(F.coalesce(request, F.lit(""))).alias("request_sha1"), F.col(fallback).alias("_fallback")).join(done, "request_sha1", "left")
    return out.select(key, F.coalesce("reply", "_fallback").alias("reply"), "status")


def _ask(text: str | None, providers: list[Provider], tries: int, wait: float) -> tuple[str | None, str]:
    if not providers:
        return None, "fallback_no_provider"
    for provider in providers:
        for attempt in range(tries):
            try:
                return provider(text or ""), "ok"
            except Exception:  # noqa: BLE001  any failure of a provider is retried, then left to the next
                if attempt + 1 < tries:
                    time.sleep(wait * (attempt + 1))
    return None, "fallback_error"


def is_retryable(message: Column) -> Column:
    """Whether a provider's message tells of a passing state: a limit, a timeout, an overload."""
    return F.coalesce(F.lower(message).rlike(r"\b(?:429|500|502|503|504)\b|timed? ?out|rate limit|quota|overloaded|reset after"), F.lit(False))


def wait_seconds(message: Column, extra: int = 10, default: int = 30) -> Column:
    """How long to wait by the hint "reset after 1h 2m 3s" of a message, and ``extra`` seconds; ``default`` without a hint."""
    part = lambda unit: F.coalesce(F.regexp_extract(F.lower(message), r"reset after (?:\d+[hms] ?)*?(\d+)" + unit, 1).try_cast("int"), F.lit(0))
    total = part("h") * 3600 + part("m") * 60 + part("s")
    return F.when(F.coalesce(total, F.lit(0)) > 0, total + extra).otherwise(F.lit(default))
