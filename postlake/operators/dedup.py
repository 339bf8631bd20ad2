"""Duplicates, caps and orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.dates import is_iso
from ..functions.identity import merge_key, seen_id
from ..functions.text import text


def merge_duplicates(jobs: DataFrame) -> DataFrame:
    """One row per opening (`mkey`), in one shuffle: the best posting's columns, all seen ids and all platforms, sorted.

    Best is a posting with an ISO date, then one with a url, then the earliest. Only the best row and the sets travel,
    combined before the shuffle.
    """
    columns = [c for c in jobs.columns if c != "_ord"]
    rank = F.struct((~is_iso("posted_date")).alias("a"), (text("url") == "").alias("b"), F.col("_ord").alias("c"))
    merged = jobs.groupBy(merge_key().alias("mkey")).agg(
        F.min_by(F.struct(*columns), rank).alias("best"),
        F.array_sort(F.collect_set(seen_id())).alias("seen_ids"),
        F.array_sort(F.collect_set("ats_platform")).alias("sources"),
        F.min("_ord").alias("_ord"),
    )
    return merged.select("mkey", "best.*", "seen_ids", "sources", "_ord")


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """The first row of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def cap_per(df: DataFrame, keys: list[Column | str], order: list[Column], n: int) -> DataFrame:
    """At most n rows of each key; the limit is pushed below the shuffle by the window's group limit."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def freshest(df: DataFrame, n: int) -> DataFrame:
    """At most n postings per company, newest first by posted date, else by the day first seen; blanks last."""
    return cap_per(df, ["company"], [F.desc(F.coalesce(F.nullif("posted_date", F.lit("")), "first_seen", F.lit(""))), F.col("mkey")], n)


def most_common(df: DataFrame, groups: list[str], item: str, k: int, order: str | None = None) -> DataFrame:
    """The k most frequent items per group: count descending, ties to the least `order`, then to the least item."""
    counted = df.groupBy(*groups, item).agg(F.count(F.lit(1)).alias("n"), F.min(order or item).alias("_first"))
    return cap_per(counted, groups or [F.lit(1)], [F.desc("n"), F.col("_first"), F.col(item)], k).drop("_first")


def search(df: DataFrame, blob: Column, query: str) -> DataFrame:
    """Rows whose text holds every word of the query."""
    return df.where(F.forall(F.split(F.lit(query.strip().lower()), r"\s+"), lambda w: F.lower(blob).contains(w)))
