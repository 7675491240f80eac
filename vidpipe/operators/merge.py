"""Table states: insert-ignore, upserts and keyed updates as pure functions from old rows and new rows to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .validate import has_key


def first_wins(rows: DataFrame, keys: list[str], order_col: str | None) -> DataFrame:
    """One row per key, the first by ``order_col`` or, without it, by all columns; rows without a full key go.  Combines before the shuffle."""
    cols, full = rows.columns, rows.where(has_key(*keys))
    rest = [c for c in cols if c not in keys]
    if not rest:
        return full.distinct()
    row = F.struct(*rest)
    best = full.groupBy(*keys).agg((F.min(row) if order_col is None else F.min_by(row, F.col(order_col))).alias("_row"))
    # the keys are those of the grouping, so what follows by the same keys needs no further shuffle
    return best.select(*(c if c in keys else F.col("_row")[c].alias(c) for c in cols))


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """``old`` and the new rows whose keys it lacks, the first of each key."""
    cols = old.columns
    fresh = first_wins(new, keys, order_col).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh.select(*cols))


def insert_stats(old: DataFrame, new: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row: rows sent, sent after in-batch rejects, rejected, and stored in truth."""
    sent = new.agg(F.count("*").alias("rows"), F.count_distinct(F.when(has_key(key), F.col(key))).alias("inserted"))
    stored = new.where(has_key(key)).select(key).distinct().join(old.select(key), key, "left_anti").agg(F.count("*").alias("stored"))
    return sent.crossJoin(stored).select("rows", "inserted", (F.col("rows") - F.col("inserted")).alias("ignored"), "stored")  # one row each


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order_col: str | None = None, mode: str = "coalesce", always: tuple[str, ...] = ()) -> DataFrame:
    """Old rows brought up to date by new ones, and new keys added.

    ``coalesce``: a new value wins unless it is null, except in the columns ``always`` replaced.  ``overwrite``:
    all columns of a new row win.  Of several new rows for a key the first by ``order_col`` counts, or without it
    the least by all columns, so that a key never has two rows.
    """
    cols = old.columns
    fresh = first_wins(new.select(*cols), keys, None) if order_col is None else first_wins(new, keys, order_col)
    fresh = fresh.select(*keys, F.lit(True).alias("_new"), *(F.col(c).alias(f"_{c}") for c in cols if c not in keys))
    both = old.join(fresh, keys, "full_outer")

    def value(c: str):
        if c in keys:
            return F.col(c)
        if mode == "overwrite" or c in always:
            return F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
        return F.coalesce(f"_{c}", c).alias(c)

    return both.select(*(value(c) for c in cols))


def keyed_update(old: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """``column`` set where ``updates(key, column)`` has the key; other rows as they were."""
    new = updates.select(key, F.col(column).alias("_new"))
    return old.join(new, key, "left").select(*(F.coalesce("_new", c).alias(c) if c == column else F.col(c) for c in old.columns))


def append_runs(queries: DataFrame, now, mode: str = "exploration") -> DataFrame:
    """A run row for each query, with a fresh id."""
    return queries.select(F.expr("uuid()").alias("id"), "query", F.lit(mode).alias("mode"), now.alias("started_at"), F.lit(None).cast("timestamp").alias("finished_at"))
