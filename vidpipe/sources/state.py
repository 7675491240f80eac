"""Tables without row updates: immutable snapshots of buckets, of which the last complete one is current."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns of each table, as DDL.
TABLES = {
    "search_runs": "id string, query string, mode string, started_at timestamp, finished_at timestamp",
    "videos_raw": "video_id string, search_run_id string, query string, video_url string, channel_url string, duration_text string, views_text string, "
    "published_text string, thumbnail_url string, video_type string, is_multi_creator boolean, discovered_at timestamp",
    "videos_normalized": "video_id string, channel_url string, query string, views_estimated bigint, published_at_estimated timestamp, "
    "duration_seconds_estimated bigint, validation_passed boolean, validation_reason string, normalized_at timestamp",
    "channels_raw": "channel_url string, channel_id string, channel_name string, subscriber_count bigint, is_verified boolean, extracted_at timestamp",
    "channel_videos_raw": "channel_url string, video_id string, upload_date string, duration_seconds bigint, view_count bigint",
    "channels_processed": "channel_url string, processed_at timestamp, status string",
    "channels_discovery_claims": "channel_url string, claimed_at timestamp",
}
#: Those and further ones, which are not made beforehand.
SCHEMAS = TABLES | {
    "channel_sketches": "channel_url string, n_videos bigint, sum_views bigint, n_seen bigint, sketch binary",
    "seen_blocks": "block bigint, w0 bigint, w1 bigint, w2 bigint, w3 bigint",
}


# What identifies a row of each table.
KEYS = {
    "search_runs": ("id",), "videos_raw": ("video_id",), "videos_normalized": ("video_id",), "channels_raw": ("channel_url",), "channel_videos_raw": ("channel_url", "video_id"),
    "channels_processed": ("channel_url",), "channels_discovery_claims": ("channel_url",), "channel_sketches": ("channel_url",), "seen_blocks": ("block",),
}

#: In a manifest, the bucket of rows that were written without regard to buckets.
WHOLE = -1


@dataclass(frozen=True)
class Manifest:
    """What a snapshot consists of: for each bucket the folder with its files and its rows, and for each source the last batch taken in with its totals so far."""

    version: int = -1
    buckets: int = 0
    parts: dict[int, tuple[str, int]] = field(default_factory=dict)
    applied: dict[str, dict] = field(default_factory=dict)


class Tables:
    """Named tables of one language below a root folder; one writer at a time.

    Rows lie in buckets by a hash of their key.  ``merge`` reads and writes only the buckets that its rows touch;
    a small manifest, a line for each bucket, says which files a snapshot consists of.  Snapshot ``n`` counts from
    when its manifest ``m=n.json`` is there, the last file a write makes.  A write that breaks off leaves a folder that
    no manifest names; readers do not see it, and ``forget`` deletes it.  The manifest also says which
    batch of which source came in last, so a batch that is replayed changes neither rows nor totals.  ``buckets``
    is settled by a table's first merge.
    """

    def __init__(self, spark: SparkSession, root: str, lang: str, buckets: int = 64) -> None:
        self.spark, self.root, self.lang, self.buckets = spark, root, lang, buckets

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}/lang={self.lang}"

    def _fs(self, path: str):
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _names(self, path: str) -> list[str]:
        fs, where = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []

    def versions(self, name: str) -> list[int]:
        """All complete snapshots, in order."""
        return sorted(int(n[2:-5]) for n in self._names(self._path(name)) if n.startswith("m=") and n.endswith(".json"))

    def version(self, name: str) -> int:
        """The current snapshot, -1 if there is none."""
        return max(self.versions(name), default=-1)

    def manifest(self, name: str, version: int | None = None) -> Manifest:
        """That of a snapshot, the current one by default; an empty one if there is none."""
        v = self.version(name) if version is None else version
        if v < 0:
            return Manifest()
        found = json.loads(read_text(self.spark, f"{self._path(name)}/m={v}.json"))
        return Manifest(v, found["buckets"], {int(b): tuple(p) for b, p in found["parts"].items()}, found["applied"])

    def _commit(self, name: str, new: Manifest) -> None:
        fs, done = self._fs(f"{self._path(name)}/m={new.version}.json")
        _, half = self._fs(f"{self._path(name)}/.m={new.version}-{uuid.uuid4().hex}")
        out = fs.create(half, True)
        out.write(bytearray(json.dumps({"buckets": new.buckets, "parts": new.parts, "applied": new.applied}).encode()))
        out.close()
        if fs.exists(done) or not fs.rename(half, done):
            fs.delete(half, False)
            raise RuntimeError(f"snapshot {new.version} of {name} was written by another writer")

    def create(self) -> None:
        """Every table that does not exist yet, empty."""
        for name, ddl in TABLES.items():
            if self.version(name) < 0:
                self.write(name, self.spark.createDataFrame([], ddl))

    def _folder(self, version: int) -> str:
        return f"v={version}-{uuid.uuid4().hex[:8]}"  # no two writes share one

    def _of(self, name: str, parts: dict[int, tuple[str, int]]) -> DataFrame:
        paths = [f"{self._path(name)}/{v}" + ("" if b == WHOLE else f"/bucket={b}") for b, (v, _) in parts.items()]
        if not paths:
            return empty(self.spark, SCHEMAS[name])
        reader = self.spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else self.spark.read
        return reader.parquet(*paths)

    def read(self, name: str) -> DataFrame:
        """The current snapshot; a known table that was never written is empty."""
        return self._of(name, self.manifest(name).parts)

    def write(self, name: str, rows: DataFrame) -> None:
        """A new snapshot of these rows alone; readers of the old one are not disturbed."""
        old = self.manifest(name)
        folder = self._folder(old.version + 1)
        rows.write.parquet(f"{self._path(name)}/{folder}")
        self._commit(name, Manifest(old.version + 1, old.buckets, {WHOLE: (folder, -1)}, old.applied))

    def applied(self, name: str, source: str) -> dict:
        """The last ``batch`` that a source brought, and the totals over all its batches: rows ``sent``, and rows the table grew by, ``stored``."""
        return self.manifest(name).applied.get(source, {"batch": -1, "sent": 0, "stored": 0})

    def merge(self, name: str, rows: DataFrame, change: Callable[[DataFrame, DataFrame], DataFrame], source: str | None = None, batch: int | None = None) -> bool:
        """``change(old, rows)`` over the buckets that the keys of ``rows`` touch; False if the source brought this batch before.

        ``old`` has the table's rows of those buckets, and what ``change`` returns replaces them, keys and all; it
        must not make rows of other keys.  ``rows`` is read twice, once for its keys alone.  Two numbers for each
        bucket reach the driver.
        """
        old = self.manifest(name)
        mark = self.applied(name, source) if source is not None else None
        if mark is not None and batch <= mark["batch"]:
            return False
        keys, many = KEYS[name], old.buckets or self.buckets
        of = F.pmod(F.xxhash64(*keys), F.lit(many)).cast("int")
        sent = {r["bucket"]: r["n"] for r in rows.groupBy(of.alias("bucket")).agg(F.count("*").alias("n")).collect()}
        # rows that stand in no bucket yet are dealt into theirs now
        touched = {b: p for b, p in old.parts.items() if b in sent or b == WHOLE}
        version, parts = old.version + 1, {b: p for b, p in old.parts.items() if b not in touched}
        grown = 0
        if sent:
            folder = self._folder(version)
            path = f"{self._path(name)}/{folder}"
            out = change(self._of(name, touched), rows)
            out.select(*self._of(name, {}).columns, of.alias("bucket")).repartition("bucket").write.partitionBy("bucket").parquet(path)
            there = sorted(int(n[7:]) for n in self._names(path) if n.startswith("bucket="))
            counts = {r["bucket"]: r["n"] for r in self.spark.read.schema(f"{SCHEMAS[name]}, bucket int").parquet(path).groupBy("bucket").agg(F.count("*").alias("n")).collect()} if there else {}
            before = sum(n for _, n in touched.values()) if WHOLE not in touched else self._of(name, touched).count()
            grown = sum(counts.values()) - before
            parts |= {b: (folder, counts.get(b, 0)) for b in there}
        else:
            parts = old.parts
        applied = old.applied if mark is None else old.applied | {source: {"batch": batch, "sent": mark["sent"] + sum(sent.values()), "stored": mark["stored"] + grown}}
        self._commit(name, Manifest(version, many, parts, applied))
        return True

    def forget(self, name: str, keep: int = 2) -> None:
        """Delete all but the last ``keep`` snapshots (one at least) and the files that only they have; nothing may read them any more."""
        have = self.versions(name)
        kept = have[-max(1, keep) :]
        if not kept:
            return
        parts = {(b, v) for k in kept for b, (v, _) in self.manifest(name, k).parts.items()}
        fs, _ = self._fs(self.root)
        for v in have[: -len(kept)]:
            fs.delete(self._fs(f"{self._path(name)}/m={v}.json")[1], False)
        for n in self._names(self._path(name)):
            number = n[2:].split("-")[0]
            if not n.startswith("v=") or not number.isdigit() or int(number) > kept[-1]:
                continue  # of a write that goes on, perhaps
            path = f"{self._path(name)}/{n}"
            if not any(of == n for _, of in parts):
                fs.delete(self._fs(path)[1], True)
            elif (WHOLE, n) not in parts:
                for b in self._names(path):
                    if b.startswith("bucket=") and (int(b[7:]), n) not in parts:
                        fs.delete(self._fs(f"{path}/{b}")[1], True)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """No rows, known to be none when a query is planned: what is joined with them is neither shuffled nor sorted."""
    return spark.range(1).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ddl))).where(F.lit(False))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of any store that Spark reads, as text."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = where.getFileSystem(spark._jsc.hadoopConfiguration()).open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def results_json(rows: DataFrame, path: str | None = None) -> DataFrame:
    """Each row as JSON text, written as JSON lines if there is a path."""
    if path:
        rows.write.mode("overwrite").json(path)
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("json"))
