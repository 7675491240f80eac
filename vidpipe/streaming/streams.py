"""Incremental jobs as streams that take in what has arrived and stop."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge
from ..plans import jobs
from ..sources.state import Tables, read_text


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int, str], None]) -> StreamingQuery:
    """Every batch that has arrived, then an end.

    ``each`` gets a batch, its number and the stream's id, which stays with the checkpoint: after a failure a batch
    comes again under the same number, so what was stored under both is not stored twice.
    """

    def one(batch: DataFrame, number: int) -> None:
        each(batch, number, json.loads(read_text(batch.sparkSession, f"{checkpoint}/metadata"))["id"])

    query = stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def normalize_stream(raw: DataFrame, tables: Tables, checkpoint: str, now: Column, order_col: str) -> None:
    """Arriving raw rows into ``videos_normalized``; keys that it has are ignored, and not parsed either."""

    def change(old: DataFrame, rows: DataFrame) -> DataFrame:
        new = merge.first_wins(rows, ["video_id"], order_col).join(old.select("video_id"), "video_id", "left_anti")
        return old.unionByName(jobs.normalize_rows(new, now).select(*old.columns))

    def each(batch: DataFrame, number: int, stream: str) -> None:
        tables.merge("videos_normalized", batch, change, stream, number)
        tables.forget("videos_normalized")

    run_available(raw, checkpoint, each)


def ingest_stream(hits: DataFrame, tables: Tables, checkpoint: str, query: str, now: Column, order_col: str) -> None:
    """Arriving hits, each batch a run of its own; replays change nothing."""

    def each(batch: DataFrame, number: int, stream: str) -> None:
        jobs.ingest_run(tables, batch, query, now, order_col, stream, number)

    run_available(hits, checkpoint, each)


def enrich_stream(dumps: DataFrame, tables: Tables, checkpoint: str, now: Column, most: int = 40, order_col: str | None = None) -> None:
    """Arriving dumps into the channel tables; each batch is parsed once.  Of a channel given several times the first dump that settles it counts."""

    def each(batch: DataFrame, number: int, stream: str) -> None:
        new = jobs.enrich(batch, tables.read("channels_processed"), now, most, order_col, store=True)
        videos = merge.first_wins(new["videos"], ["channel_url", "video_id"], "pos").drop("pos")
        # the mark that a channel is done comes last, as a batch that broke off before it is parsed again
        for name, rows, mode in (("channels_raw", new["channels"], "coalesce"), ("channel_videos_raw", videos, "coalesce"), ("channels_processed", new["processed"], "overwrite")):
            keys = ["channel_url", "video_id"] if name == "channel_videos_raw" else ["channel_url"]
            always = ("extracted_at",) if name == "channels_raw" else ()
            tables.merge(name, rows, lambda old, rows, k=keys, m=mode, a=always: merge.upsert(old, rows, k, mode=m, always=a), stream, number)
            tables.forget(name)

    run_available(dumps, checkpoint, each)


def dedupe_stream(rows: DataFrame, keys: list[str], time_col: str, delay: str, out: str, checkpoint: str) -> StreamingQuery:
    """Arriving rows appended to ``out``, each key once within ``delay`` of its first event time; rows that come later than that are dropped.

    The state holds a key until the latest event time seen is ``delay`` past the key's own, so it is bounded by the
    keys of that span however long the stream runs; a key that comes back after it is a new one.
    """
    fresh = rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)
    query = fresh.writeStream.format("parquet").outputMode("append").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
