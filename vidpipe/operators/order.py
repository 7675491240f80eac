"""Positions in an ordered list, and batches and worker shares cut from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import written


def with_index(rows: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """A dense position from 0 by ``order``, which must be unique.

    Ranges of the order are numbered apart, as they are written, and shifted by the counts of the ranges before:
    nothing but one count per range meets in one place.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ranged = written(ranged, "order")  # so that its partitions are settled for good
    # such an id is the number of the partition, and in its lower 33 bits the place of the row there
    ranged = ranged.select(*rows.columns, F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local"))
    counts = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # a row per partition
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return ranged.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_local")).cast("bigint")).drop("_part", "_local", "_before")


def with_rank(rows: DataFrame, score: str, ties: list[str], name: str = "rank") -> DataFrame:
    """The rank of each row from 1 by falling ``score``, nulls last; equal scores share the least rank of theirs.

    Rows are dealt into ranges by score and ``ties``, which together are unique, so a score that a third of all rows
    have is split like any other.  Each range is ranked by itself; where a score goes on over a border, the rank it
    began with is carried over.  A row for each range meets in one place.
    """
    place = F.struct(F.col(score).isNotNull().alias("known"), F.col(score).alias("score"))
    ranged = rows.withColumn("_place", place).repartitionByRange(F.desc("_place"), *ties).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "rank")  # so that its partitions are settled for good
    ranged = ranged.withColumn("_local", F.rank().over(Window.partitionBy("_part").orderBy(F.desc("_place"))) - 1)
    parts = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.max("_place").alias("_first"), F.min("_place").alias("_last"), F.max("_local").alias("_tail"))
    along = Window.orderBy("_part")  # a row for each range
    parts = parts.select("_part", "_first", "_last", "_tail", (F.sum("_n").over(along) - F.col("_n")).alias("_before"), F.lag("_last").over(along).eqNullSafe(F.col("_first")).alias("_goes_on"))
    begun = F.when((F.col("_tail") > 0) | ~F.col("_goes_on"), F.col("_before") + F.col("_tail"))  # where a range's last score begins, if it begins there
    parts = parts.withColumn("_begun", F.last(begun, ignorenulls=True).over(along))
    parts = parts.select("_part", "_first", "_before", F.when(F.col("_goes_on"), F.lag("_begun").over(along)).alias("_carried"))
    at = F.when(F.col("_carried").isNotNull() & (F.col("_local") == 0), F.col("_carried")).otherwise(F.col("_before") + F.col("_local"))
    return ranged.join(F.broadcast(parts), "_part").withColumn(name, (at + 1).cast("bigint")).select(*rows.columns, name)


def ordinal(rows: DataFrame, keys: list[str], order: list[str], name: str = "ordinal") -> DataFrame:
    """How many rows of the same ``keys`` come before each by ``order``, from 0; keys and order are unique together.

    Rows are numbered over all keys at once, so a key with a third of all rows is split like any other range.
    """
    indexed = with_index(rows, [*keys, *order], "_idx")
    first = indexed.groupBy(*keys).agg(F.min("_idx").alias("_first"))
    return indexed.join(first, keys).withColumn(name, F.col("_idx") - F.col("_first")).drop("_idx", "_first")


def batch(indexed: DataFrame, number: int, size: int) -> DataFrame:
    """The rows of one batch of the list."""
    return indexed.where((F.col("idx") >= number * size) & (F.col("idx") < (number + 1) * size))


def worker_shares(indexed: DataFrame, workers: int | None, size: int) -> DataFrame:
    """Contiguous shares of ``size`` rows for each worker, or as many shares as there are if that is None; later ones may be short or missing."""
    return (indexed if workers is None else indexed.where(F.col("idx") < workers * size)).withColumn("worker", F.floor(F.col("idx") / size).cast("bigint"))


def pending_batches(indexed: DataFrame, waiting: DataFrame, size: int) -> DataFrame:
    """``(batch)``: batches that hold a query of ``waiting(query)``; a report of them as one list gathers their numbers, one for each ``size`` queries, in one row."""
    numbered = indexed.withColumn("batch", F.floor(F.col("idx") / size).cast("bigint"))
    return numbered.join(waiting.select("query").distinct(), "query", "left_semi").select("batch").distinct()


def top_per(rows: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")
