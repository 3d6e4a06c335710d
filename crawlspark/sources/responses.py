"""Fetched content from an archive of pages and a fetch log, in place of an HTTP client."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlspark.operators.lookup import fits_broadcast
from crawlspark.operators.state import protocol_status


def latest_responses(log: DataFrame, key: str = "page_id", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The latest log row per page; combines map-side, so a page with very many rows is cheap."""
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(ts, tie)).alias("r")).select(key, "r.*")


def fetch_content(
    batch: DataFrame, log: DataFrame, archive: DataFrame, key: str = "page_id", html: str = "html", as_of: Column | None = None, captured: str | None = None
) -> DataFrame:
    """Batch pages with their latest response code, protocol status and, on success, content.

    Pages are matched to responses before content is read, and only successes' content goes further than the scan (broadcast keys, if
    the batch is small enough). With ``as_of`` later responses
    (and captures, if the archive has their time in ``captured``) don't count. Of several captures of a page the latest is
    its content, ties by hash, so a page stays one row.
    """
    seen = log.select(key, "code", "ts", "event_id").join(batch.select(key).distinct(), key, "left_semi")
    if as_of is not None:
        seen = seen.where(F.col("ts") <= as_of)
    known = batch.join(latest_responses(seen, key).select(key, F.col("code")), key, "left").withColumn(
        "protocol_status",
        F.when(F.col("code").isNull(), F.lit("EXCEPTION")).otherwise(protocol_status(F.col("code"))),
    )
    copies = archive.select(key, html, *([captured] if captured else []))
    if captured and as_of is not None:
        copies = copies.where(F.col(captured) <= as_of)
    # of the archive only the successes' captures are hashed, sorted or moved
    wanted = known.where(F.col("protocol_status") == "SUCCESS").select(key).distinct()
    copies = copies.join(F.broadcast(wanted) if fits_broadcast(batch.select(key)) else wanted, key, "left_semi")
    order = F.struct(*([F.col(captured)] if captured else []), F.xxhash64(html))
    content = copies.groupBy(key).agg(F.max_by(html, order).alias(html))
    wanted = known.withColumn("_key", F.when(F.col("protocol_status") == "SUCCESS", F.col(key)))
    # pages without success have no key to look up
    return wanted.join(content.withColumnRenamed(key, "_k"), F.col("_key") == F.col("_k"), "left").drop("_key", "_k")
