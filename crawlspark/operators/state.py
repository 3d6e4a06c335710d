"""Fetch results and the state of a page after them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.functions import urls as U
from crawlspark.operators.frontier import YES

RETIRED_DAYS = 3650
MAX_FAILED_FETCHES = 5

# Response code -> protocol status.
STATUS_BY_CODE = {
    "SUCCESS": (200,),
    "TEMP_MOVED": (302, 303, 307),
    "NOTMODIFIED": (304,),
    "GONE": (400, 410),
    "ACCESS_DENIED": (401,),
    "NOTFOUND": (404,),
}
# Error class -> protocol status.
STATUS_BY_ERROR = {
    "ConnectException": "CONNECTION_TIMED_OUT",
    "SocketTimeoutException": "CONNECTION_TIMED_OUT",
    "UnknownHostException": "UNKNOWN_HOST",
}


def protocol_status(code: Column) -> Column:
    chain = F
    for status, codes in STATUS_BY_CODE.items():
        chain = chain.when(code.isin(*codes), F.lit(status))
    return chain.when(code.between(300, 399), F.lit("MOVED")).otherwise(F.lit("EXCEPTION"))


def failure_status(error_class: Column) -> Column:
    """Status of a fetch that brought no response, by the simple or full name of its error."""
    short = F.substring_index(error_class, ".", -1)
    chain = F
    for error, status in STATUS_BY_ERROR.items():
        chain = chain.when(short == error, F.lit(status))
    return chain.otherwise(F.lit("EXCEPTION"))


def redirect_target(url: Column, location: Column) -> Column:
    """Location resolved against the url; a missing location is the url itself."""
    return U.resolve(U.base_parts(url), F.coalesce(location, F.lit("")))


def classify_fetches(log: DataFrame, code: str = "code") -> DataFrame:
    """Add the protocol status of each response, and the redirect target where the log has one."""
    out = log.withColumn("protocol_status", protocol_status(F.col(code)))
    if {"url", "location"} <= set(log.columns):
        moved = F.col(code).between(300, 399)
        out = out.withColumn("redirect_to", F.when(moved, redirect_target(F.col("url"), F.col("location"))))
    return out


def fetch_success(fetched: DataFrame, now: Column) -> DataFrame:
    """State of successfully fetched pages: counts, times, marks."""
    changes = {
        "status": F.lit("FETCHED"),
        "fetch_count": F.col("fetch_count") + 1,
        "prev_fetch_time": F.when(F.col("fetch_time") < now, F.col("fetch_time")).otherwise(_or_null(fetched, "prev_fetch_time", "timestamp_ntz")),
        "fetch_time": now,
        "mark_fetch": F.coalesce(F.col("mark_generate"), _or_null(fetched, "mark_fetch", "string")),
        "mark_inject": F.lit(None).cast("string"),
        "mark_generate": F.lit(None).cast("string"),
    }
    history = _or_null(fetched, "fetch_time_history", "array<timestamp_ntz>")
    changes["fetch_time_history"] = F.array_append(F.coalesce(history, F.array().cast("array<timestamp_ntz>")), now)
    return fetched.withColumns(changes)


def schedule_next(fetched: DataFrame, start: Column) -> DataFrame:
    """Next fetch time: seeds after their interval, other pages in ten years and inactive."""
    interval = F.timestamp_add("SECOND", F.col("fetch_interval_s"), start)
    far = F.timestamp_add("DAY", F.lit(RETIRED_DAYS), start)
    return fetched.withColumns(
        {
            "fetch_time": F.when(F.col("is_seed"), interval).otherwise(far),
            "mark_inactive": F.when(F.col("is_seed"), _or_null(fetched, "mark_inactive", "string")).otherwise(F.lit(YES)),
        }
    )


def fetch_backoff(failed: DataFrame, code: str = "fetch_code", count_failures: bool = False) -> DataFrame:
    """Failed pages (negative code) wait fetch_count days; after more than five fetches they retire.

    ``count_failures`` also raises fetch_count, so that a page that never answers retires in the end.
    """
    bad = F.col(code) < 0
    later = F.timestamp_add("DAY", F.col("fetch_count"), F.col("fetch_time"))
    changes = {
        "fetch_time": F.when(bad, later).otherwise(F.col("fetch_time")),
        "mark_inactive": F.when(bad & (F.col("fetch_count") > MAX_FAILED_FETCHES), F.lit(YES)).otherwise(F.col("mark_inactive")),
    }
    if count_failures:
        changes["fetch_count"] = F.col("fetch_count") + F.when(bad, 1).otherwise(0)
    return failed.withColumns(changes)


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)
