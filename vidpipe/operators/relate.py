"""Anti-joins, membership, integrity checks and small reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .validate import candidates, has_key


def unprocessed(raw: DataFrame, done: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of ``raw`` whose key ``done`` lacks."""
    return raw.join(done.select(key), key, "left_anti").select(*columns)


def oldest_first(rows: DataFrame, order: list[str], limit: int | None = None) -> DataFrame:
    """Sorted, and cut to ``limit`` rows if that is positive."""
    out = rows.orderBy(*order)
    return out.limit(limit) if limit else out


def claim(normalized: DataFrame, processed: DataFrame, claims: DataFrame, limit: int | None, key: str = "channel_url", now: Column | None = None, ttl: int | None = None) -> DataFrame:
    """``(key, first_normalized_at)`` of the ``limit`` oldest candidates, neither processed nor claimed; of all, unsorted, if it is None.

    With ``ttl``, in seconds, only claims of less than that age at ``now`` count; ``claims`` may hold several of a key.
    """
    live = claims.select(key) if ttl is None else claims.where(F.col("claimed_at") > now - F.make_dt_interval(secs=F.lit(ttl))).select(key)
    open_ = candidates(normalized).join(processed.select(key), key, "left_anti").join(live, key, "left_anti")
    all_ = open_.groupBy(key).agg(F.min("normalized_at").alias("first_normalized_at"))
    return all_ if limit is None else all_.orderBy("first_normalized_at", key).limit(max(0, limit))


def executed(runs: DataFrame) -> DataFrame:
    """The distinct queries of a history, without null and empty ones."""
    return runs.where(has_key("query")).select("query").distinct()


def pending(queries: DataFrame, history: DataFrame | None) -> DataFrame:
    """Queries not in the history, order column and duplicates kept; all of them without a history."""
    return queries if history is None else queries.join(executed(history), "query", "left_anti").select(*queries.columns)


def with_flag(rows: DataFrame, done: DataFrame, key: str, flag: str = "processed") -> DataFrame:
    mark = done.select(key, F.lit(True).alias(flag)).dropDuplicates([key])
    return rows.join(mark, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def load_totals(marked: DataFrame, instances: int, size: int) -> DataFrame:
    """One row of a run's load: ``marked(processed)`` queries loaded, pending and filtered out (skipped, by its other name), and target and actual work."""
    waits, done = F.count(F.when(~F.col("processed"), 1)), F.count(F.when(F.col("processed"), 1))
    target = F.lit(instances * size).cast("bigint")
    return marked.agg(F.count("*").alias("loaded"), waits.alias("pending"), done.alias("filtered"), done.alias("skipped"), target.alias("target"), F.least(target, waits).alias("actual"))


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    return child.where(F.col(fk).isNotNull()).join(parent.select(F.col(key).alias(fk)), fk, "left_anti")


def key_violations(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def shared_keys(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return one.select(key).intersect(other.select(key))
