"""The state transforms on streams: the same rules, micro-batch by micro-batch."""

from __future__ import annotations

import calendar
from collections.abc import Callable, Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.dedup import merge_duplicates
from ..operators.state import upsert_matched
from ..sources.tables import latest, load_state, publish, save_state


def matched_sink(root: str, run_date: Callable[[DataFrame], str] | str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch of accepted postings (with `_ord`) becomes a new version of the matched table.

    A batch that is replayed after a failure is known by its number and not written again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        day = run_date if isinstance(run_date, str) else run_date(batch)
        save_state(upsert_matched(load_state(batch.sparkSession, root, "matched"), merge_duplicates(batch), day), root, "matched", batch_id)

    return write


def unseen(stream: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """The first row of each key within the watermark; state for older keys is dropped."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, ts: str, by: list[str], width: str, slide: str | None = None, late: str = "1 day") -> DataFrame:
    """Counts and sums of `value` per window and key; rows later than `late` are ignored on streams."""
    window = F.window(ts, width, slide) if slide else F.window(ts, width)
    return stream.withWatermark(ts, late).groupBy(window.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")


def sessions(stream: DataFrame, ts: str, key: str, gap: str, late: str = "1 day") -> DataFrame:
    """Sessions of a key: activity with no pause of `gap` or longer."""
    return stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def first_seen_stream(stream: DataFrame, key: str, day: str, days: int = 3, late: str = "1 day") -> DataFrame:
    """first_seen and last_seen of each key under the gap rule, updated with every batch of sightings (day: date column).

    Sightings of a batch are sorted by day; one earlier than the last known day changes nothing, and one later than `late`
    after the latest of all isn't read. A key's state goes when the watermark is past the gap: its next sighting is new anyway.
    """
    out = f"{key} string, first_seen date, last_seen date"

    def update(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        first, last = state.get if state.exists else (None, None)
        for d in sorted(set(pd.concat(list(frames))[day].dropna())):
            if last is None or (d - last).days > days:
                first, last = d, d
            elif d > last:
                last = d
        if first is not None:
            state.update((first, last))
            over = calendar.timegm((last + timedelta(days=days + 1)).timetuple()) * 1000
            state.setTimeoutTimestamp(max(over, state.getCurrentWatermarkMs() + 1))
            yield pd.DataFrame({key: [keys[0]], "first_seen": [first], "last_seen": [last]})

    rows = stream.select(F.col(key).cast("string").alias(key), F.col(day).cast("date").alias(day), F.col(day).cast("date").cast("timestamp").alias("_at")).withWatermark("_at", late)
    return rows.groupBy(key).applyInPandasWithState(update, out, "first_seen date, last_seen date", "update", GroupStateTimeout.EventTimeTimeout)


def with_late(sink: Callable[[DataFrame, int], None], late_sink: Callable[[DataFrame, int], None], root: str, ts: str, late: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: rows older than `late` before the latest time of all earlier batches go to `late_sink`, the others to `sink`.

    The latest time of each batch is published under `root`, so that a replayed batch is divided as it was before. Rows
    without a time are never late.
    """
    schema = "batch bigint, top timestamp"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        known = latest(spark, f"{root}/times", schema).where(F.col("batch") < batch_id)
        before = known.agg(F.max("top").alias("top")).first()["top"]
        old = F.coalesce(F.col(ts) < F.lit(before) - F.expr(f"INTERVAL {late}"), F.lit(False)) if before is not None else F.lit(False)
        sink(rows.where(~old), batch_id)
        late_sink(rows.where(old), batch_id)
        here = rows.agg(F.lit(batch_id).cast("bigint").alias("batch"), F.max(ts).cast("timestamp").alias("top"))
        # one row stands for all batches before the one that may be replayed
        publish(known.groupBy().agg(F.lit(batch_id - 1).cast("bigint").alias("batch"), F.max("top").alias("top")).union(here), f"{root}/times", batch=batch_id)
        rows.unpersist()

    return write


def start(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Runs a sink over a stream: all that is there now, or with `every` (say `1 minute`) for ever, batch by batch."""
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_folder(spark: SparkSession, path: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """A stream over the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
