"""Whole jobs: ingestion, normalisation, claims, enrichment, work plans, channel ranking."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text, urls
from ..functions.values import let, or_false, unless_empty
from ..operators import merge, nested, order, relate, validate
from ..scratch import written
from ..sources.lists import with_dump
from ..sources.state import Tables

# Characters of a message that are kept, and parts that make a failure permanent.
MESSAGE = 5000
PERMANENT = ("Failed to resolve url", "HTTP Error 404", "does the playlist exist")

RAW_COLUMNS = ["video_id", "channel_url", "query", "duration_text", "views_text", "published_text"]


def ingest_hits(old: DataFrame, hits: DataFrame, order_col: str) -> DataFrame:
    """``old`` with the hits it lacks; urls default to those made from the id, or to the first channel's."""
    key = F.col("video_id")
    channels = F.col("channels") if "channels" in hits.columns else F.lit(None).cast("array<struct<name:string,url:string>>")
    new = hits.select(
        key, "search_run_id", "query", urls.video_url(F.col("video_url"), key).alias("video_url"), urls.channel_url(F.col("channel_url"), channels).alias("channel_url"),
        "duration_text", "views_text", "published_text", urls.thumbnail_url(F.col("thumbnail_url"), key).alias("thumbnail_url"),
        "video_type", or_false(F.col("is_multi_creator")).alias("is_multi_creator"), "discovered_at", order_col,
    )
    return merge.insert_ignore(old, new, ["video_id"], order_col)


def normalize_rows(raw: DataFrame, now: Column) -> DataFrame:
    """Raw rows with typed columns and verdict; rows without key go.  ``now`` is one clock for the run."""
    typed = raw.where(validate.has_key("video_id")).select(
        "video_id", text.normalize_text(F.col("channel_url")).alias("channel_url"), text.normalize_text(F.col("query")).alias("query"),
        text.parse_views(F.col("views_text")).alias("views_estimated"), text.parse_published(F.col("published_text"), now).alias("published_at_estimated"),
        text.parse_duration(F.col("duration_text")).alias("duration_seconds_estimated"),
    )
    passed, reason = validate.verdict(F.col("duration_seconds_estimated"), F.col("views_estimated"))
    return typed.select("*", passed.alias("validation_passed"), reason.alias("validation_reason"), now.alias("normalized_at"))


def normalize_job(raw: DataFrame, done: DataFrame, now: Column, order_col: str, limit: int | None = None) -> tuple[DataFrame, Observation]:
    """The new rows of a run, and its statistics: once the rows were written, their ``get`` has fetched, prepared, inserted and ignored.

    The statistics are counted where the rows come out, in the same pass, after the last shuffle; so a task that
    runs again counts once, and ``raw`` is read once.
    """
    todo = relate.unprocessed(raw, done, "video_id", [*RAW_COLUMNS, order_col])
    if limit:
        todo = relate.oldest_first(todo, [order_col, "video_id"], limit)
    by_key = todo.groupBy("video_id").agg(F.min_by(F.struct(*todo.columns), F.col(order_col)).alias("_row"), F.count("*").alias("_n"))
    has, total, seen = validate.has_key("video_id"), lambda c: F.coalesce(F.sum(c), F.lit(0)), Observation()
    prepared, inserted = total(F.when(has, F.col("_n"))), F.count(F.when(has, F.lit(1)))
    counted = by_key.observe(seen, total("_n").alias("fetched"), prepared.alias("prepared"), inserted.alias("inserted"), (prepared - inserted).alias("ignored"))
    return normalize_rows(counted.select("_row.*"), now), seen


def triage(dumps: DataFrame) -> DataFrame:
    """``dumps(channel_url, returncode, stdout, stderr)`` with dump, status, permanent and reason; with ``dump`` and ``error`` in place of ``stdout`` if they are stored parsed.

    A failed dump is permanent if its message, of up to MESSAGE characters, says so anywhere; only success and
    permanent failures mark a channel done.  ``reason`` shows the message's first 100 characters.
    """
    stored = "dump" in dumps.columns
    rest = [c for c in dumps.columns if c not in ("dump", "error")]
    if not stored:  # of a failure only the message is read
        dumps = with_dump(dumps, F.when(~or_false(F.col("returncode") != 0), F.col("stdout")), "_parsed")
    dump, error = (F.col("dump"), F.col("error")) if stored else (F.col("_parsed.dump"), F.col("_parsed.error"))
    said = F.substring(F.coalesce(*(unless_empty(F.trim(c)) for c in (["stderr"] if stored else ["stderr", "stdout"])), F.lit("")), 1, MESSAGE)
    reason = (
        F.when(F.coalesce(F.col("channel_url"), F.lit("")) == "", F.lit("channel_url is required"))
        .when(F.col("returncode") != 0, F.substring(said, 1, 100))
        .otherwise(error)
    )
    permanent = F.lit(False)
    for words in PERMANENT:
        permanent = permanent | F.contains(said, F.lit(words))
    permanent = permanent & (F.col("returncode") != 0) & (F.coalesce(F.col("channel_url"), F.lit("")) != "")
    own = dump if stored else F.when(F.col("returncode") == 0, dump)  # stored dumps stay a bare column, of which only the fields asked for are read
    out = dumps.select(*rest, own.alias("dump"), reason.alias("reason"), permanent.alias("permanent"))
    return out.withColumn("status", F.when(F.col("reason").isNull(), F.lit("success")).otherwise(F.lit("failed"))).withColumn("permanent", F.coalesce(permanent, F.lit(False)))


def enrich(dumps: DataFrame, processed: DataFrame, now: Column, most: int = 40, order_col: str | None = None, store: bool = False) -> dict[str, DataFrame]:
    """New rows for the channel tables, and totals; dumps of processed channels are never parsed.

    All dumps are parsed once, into a narrow table that the four results read; a verified flag that a dump does
    not give is false.  Of several dumps for a channel, by ``order_col`` or else as they are read, the first that
    succeeds or fails for good counts alone: those before it failed and were not marked, those after it are skipped.
    With ``store`` those that count are written too, for callers that read the results several times.
    """
    parsed = written(parse_dumps(dumps, processed, most, order_col), "parsed")
    settles = parsed.where("status = 'success' OR permanent").groupBy("channel_url").agg(F.min("arrival").alias("first"))
    judged = parsed.join(settles, "channel_url", "left").withColumn("status", F.when(F.col("arrival") > F.col("first"), F.lit("skipped")).otherwise(F.col("status")))
    kept = judged.where(F.col("arrival") == F.col("first")).select("channel_url", "status", "meta", "videos")
    kept = written(kept, "kept") if store else kept
    return {
        "channels": kept.where("meta IS NOT NULL").select("channel_url", "meta.*", now.alias("extracted_at")),
        "videos": kept.select("channel_url", F.inline("videos")),
        "processed": kept.select("channel_url", now.alias("processed_at"), "status"),
        "totals": judged.groupBy("status").count(),
    }


def parse_dumps(dumps: DataFrame, processed: DataFrame, most: int, order_col: str | None = None) -> DataFrame:
    """``(channel_url, arrival, status, permanent, meta, videos)`` of each dump; ``skipped`` for processed channels.  ``arrival`` is unique once it is written."""
    arrival = F.struct((F.lit(0) if order_col is None else F.col(order_col)).alias("given"), F.monotonically_increasing_id().alias("read"))
    marked = relate.with_flag(dumps.withColumn("arrival", arrival), processed, "channel_url")
    given = "dump" if "dump" in dumps.columns else "stdout"
    judged = triage(marked.withColumn(given, F.when(~F.col("processed"), F.col(given))))
    good = (F.col("status") == "success") & ~F.col("processed")
    flat = nested.flatten_entries(judged, "dump")

    def meta_of(dump: Column) -> Column:
        found = nested.meta_of(dump)
        return F.struct(*(c.alias(n) for n, c in (found | {"is_verified": or_false(found["is_verified"])}).items()))

    meta = let(F.col("dump"), meta_of)  # generated code stays of a size that the JVM compiles
    status, permanent = F.when(F.col("processed"), F.lit("skipped")).otherwise(F.col("status")), F.col("permanent") & ~F.col("processed")
    return flat.select(
        "channel_url", "arrival", status.alias("status"), permanent.alias("permanent"), F.when(good, meta).alias("meta"), F.when(good, nested.videos_of(F.col("leaves"), most)).alias("videos")
    )


def ingest_run(tables: Tables, hits: DataFrame, query: str, now: Column, order_col: str, source: str | None = None, batch: int | None = None) -> DataFrame:
    """One search: a run row is opened, the run's hits are stored where the table lacks them, and the run is closed, also if storing fails.

    ``hits`` are those of ``ingest_hits`` without ``search_run_id``.  With a ``source`` and the number of its
    ``batch`` the run's id follows from them, and a batch that is replayed changes neither the run, nor the rows,
    nor the totals ``tables.applied("videos_raw", source)``.  Returns the run's row as stored.
    """
    spark = tables.spark
    run = str(uuid.uuid4() if source is None else uuid.uuid5(uuid.NAMESPACE_URL, f"{source}#{batch}"))
    opened = spark.createDataFrame([(run, query, "exploration")], "id string, query string, mode string").select("*", now.alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"))
    tables.merge("search_runs", opened, lambda old, new: merge.insert_ignore(old, new, ["id"], "started_at"))

    def close(old: DataFrame, new: DataFrame) -> DataFrame:
        return merge.keyed_update(old, new.join(old.where("finished_at IS NOT NULL").select("id"), "id", "left_anti"), "id", "finished_at")

    try:
        tables.merge("videos_raw", hits.withColumn("search_run_id", F.lit(run)), lambda old, new: ingest_hits(old, new, order_col), source, batch)
    finally:
        tables.merge("search_runs", spark.createDataFrame([(run,)], "id string").select("id", now.alias("finished_at")), close)
    for name in ("search_runs", "videos_raw"):
        tables.forget(name)
    return tables.read("search_runs").where(F.col("id") == run)


def claim_job(tables: Tables, now: Column, limit: int | None, ttl: int | None = None) -> DataFrame:
    """The channels claimed by this run, ``(channel_url, claimed_at)``, once they are stored; the next run does not hand them out.

    With ``ttl``, in seconds, claims of that age or older do not count any more; the table is then a log, in which
    a channel claimed again has a row for each time.
    """
    key = "channel_url"
    old = tables.read("channels_discovery_claims")
    new = relate.claim(tables.read("videos_normalized"), tables.read("channels_processed"), old, limit, now=now, ttl=ttl)
    # settled, as the claims that it is drawn against are about to change
    new = written(new.withColumn("claimed_at", now), "claims")
    keys = [key] if ttl is None else [key, "claimed_at"]
    tables.merge("channels_discovery_claims", new, lambda had, more: had.unionByName(more.select(*had.columns).join(had.select(*keys), keys, "left_anti")))
    tables.forget("channels_discovery_claims")
    return new.select(key, "claimed_at")


def analyse_channels(
    videos: DataFrame, min_duration: int = 20, min_views: int = 1000, least: int = 2, median: float = 20000.0, accuracy: int | None = None
) -> DataFrame:
    """Per channel its long videos: how many, views on average and in the middle, share with enough views, and whether that qualifies.

    The exact median keeps a channel's distinct view counts together; with ``accuracy`` it is approximate, at a
    relative rank error of 1 / accuracy and bounded memory.  This step is known by name only; the definition is ours.
    """
    middle = F.percentile("view_count", F.lit(0.5)) if accuracy is None else F.percentile_approx("view_count", 0.5, accuracy).cast("double")
    long_ones = videos.where(F.col("duration_seconds") >= min_duration)
    out = long_ones.groupBy("channel_url").agg(
        F.count("*").alias("n_videos"), F.avg("view_count").alias("avg_views"), middle.alias("median_views"),
        F.avg((F.col("view_count") >= min_views).cast("double")).alias("share_seen"),
    )
    return out.withColumn("qualifies", (F.col("n_videos") >= least) & (F.col("median_views") >= median))


def score_channels(analysis: DataFrame) -> DataFrame:
    """A deterministic weighted score of the analysis; ours too."""
    score = F.round(F.lit(0.5) * F.log10(F.col("median_views") + 1) + F.lit(0.3) * F.log10(F.col("avg_views") + 1) + F.lit(0.2) * F.col("share_seen") + F.lit(0.01) * F.col("n_videos"), 6)
    return analysis.select("channel_url", score.alias("score"))


def rank_channels(analysis: DataFrame, n: int) -> DataFrame:
    """The ``n`` best qualifying channels."""
    best = score_channels(analysis).join(analysis.where("qualifies"), "channel_url")
    return best.select("channel_url", "score", "n_videos", "median_views").orderBy(F.desc("score"), "channel_url").limit(n)


def rank_all(analysis: DataFrame) -> DataFrame:
    """``(channel_url, score, rank)`` of every channel: 1 for the highest score, equal scores share the least rank of theirs."""
    return order.with_rank(score_channels(analysis), "score", ["channel_url"])


#: Items of a view sketch; the rank of a quantile read from it is off by 1.7 % of all values at most, with 99 % confidence.
SKETCH_ITEMS = 200


def sketch_channels(videos: DataFrame, min_duration: int = 20, min_views: int = 1000) -> DataFrame:
    """A row for each channel: counts and sums over its long videos, and a mergeable sketch of their views.

    Rows of the same channel, of other batches, add up by ``merge_sketches``, so no video is read twice; each
    has bounded size, however many videos the channel has.
    """
    long_ones = videos.where(F.col("duration_seconds") >= min_duration).where("view_count IS NOT NULL")
    seen = F.count(F.when(F.col("view_count") >= min_views, F.lit(1)))
    return long_ones.groupBy("channel_url").agg(
        F.count("*").alias("n_videos"), F.sum("view_count").alias("sum_views"), seen.alias("n_seen"), F.kll_sketch_agg_bigint("view_count", SKETCH_ITEMS).alias("sketch")
    )


def merge_sketches(old: DataFrame, new: DataFrame) -> DataFrame:
    """Sketches of more videos added to those that are there; one row for each channel."""
    cols = ["channel_url", "n_videos", "sum_views", "n_seen", "sketch"]
    both = old.select(cols).unionByName(new.select(cols))
    return both.groupBy("channel_url").agg(*(F.sum(c).alias(c) for c in cols[1:4]), F.kll_merge_agg_bigint("sketch").alias("sketch"))


def analyse_sketches(sketches: DataFrame, least: int = 2, median: float = 20000.0) -> DataFrame:
    """The columns of ``analyse_channels``, with medians read from sketches."""
    middle = F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5)).cast("double")
    out = sketches.select("channel_url", "n_videos", (F.col("sum_views") / F.col("n_videos")).alias("avg_views"), middle.alias("median_views"), (F.col("n_seen") / F.col("n_videos")).alias("share_seen"))
    return out.withColumn("qualifies", (F.col("n_videos") >= least) & (F.col("median_views") >= median))


def add_videos(tables: Tables, videos: DataFrame, source: str, batch: int) -> bool:
    """A batch of new videos into the stored sketches, once however often it is replayed."""
    done = tables.merge("channel_sketches", sketch_channels(videos), merge_sketches, source, batch)
    tables.forget("channel_sketches")
    return done
