"""Tables by bucket, batches that come again, runs that fail, streams with bounded state, ranks, sketches, rows of entries, and the filter of done keys."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from vidpipe.operators import merge, nested, order, seen
from vidpipe.plans import jobs
from vidpipe.sources import lists
from vidpipe.sources.state import Tables
from vidpipe.streaming import streams

CLOCK = "timestamp '2024-02-01 00:00:00'"
DUMPS = "channel_url string, returncode int, stdout string, stderr string, n int"


def tables_in(spark, path, buckets=16):
    return Tables(spark, f"file://{path}/tables", "es", buckets)


def claims(spark, sql):
    return spark.sql(f"SELECT concat('c', id) channel_url, {CLOCK} claimed_at FROM {sql}")


def ignore(old, new):
    return merge.insert_ignore(old, new, ["channel_url"], "claimed_at")


def stored(tables, name="channels_discovery_claims"):
    return sorted(r[0] for r in tables.read(name).collect())


# tables ---------------------------------------------------------------------------------------------------------------


def test_merge_writes_only_the_buckets_it_touches(spark, tmp_path):
    t, name = tables_in(spark, tmp_path), "channels_discovery_claims"
    assert t.merge(name, claims(spark, "range(2000)"), ignore)
    first = t.manifest(name)
    assert len(first.parts) == 16 and len({v for v, _ in first.parts.values()}) == 1 and sum(n for _, n in first.parts.values()) == 2000
    assert t.merge(name, claims(spark, "range(1999, 2002)"), ignore)
    second = t.manifest(name)
    changed = {b for b in second.parts if second.parts[b] != first.parts[b]}
    assert 1 <= len(changed) <= 3
    root = f"{tmp_path}/tables/{name}/lang=es"
    (one,), (two,) = ([d for d in os.listdir(root) if d.startswith(f"v={k}-")] for k in (0, 1))
    assert {d for d in os.listdir(f"{root}/{two}") if d.startswith("bucket=")} == {f"bucket={b}" for b in changed}
    assert stored(t) == sorted(f"c{k}" for k in range(2002))
    assert set(t.manifest(name, 0).parts) == set(range(16)) and t.versions(name) == [0, 1]
    t.forget(name, keep=1)
    assert t.versions(name) == [1] and stored(t) == sorted(f"c{k}" for k in range(2002))
    assert {d for d in os.listdir(f"{root}/{one}") if d.startswith("bucket=")} == {f"bucket={b}" for b in range(16) if b not in changed}


def test_batch_that_comes_again_changes_nothing(spark, tmp_path):
    t, name = tables_in(spark, tmp_path), "channels_discovery_claims"
    for batch, sql in ((0, "range(50)"), (1, "range(40, 60)"), (1, "range(40, 60)"), (0, "range(50)")):
        t.merge(name, claims(spark, sql), ignore, "s", batch)
    assert t.applied(name, "s") == {"batch": 1, "sent": 70, "stored": 60} and len(stored(t)) == 60 and t.version(name) == 1
    assert not t.merge(name, claims(spark, "range(90)"), ignore, "s", 1)
    assert t.merge(name, claims(spark, "range(90)"), ignore, "other", 0) and t.applied(name, "other") == {"batch": 0, "sent": 90, "stored": 30}
    assert t.merge(name, claims(spark, "range(0)"), ignore, "s", 2) and t.applied(name, "s")["batch"] == 2 and len(stored(t)) == 90


def test_merge_that_breaks_off_leaves_the_table(spark, tmp_path):
    t, name = tables_in(spark, tmp_path), "channels_discovery_claims"
    t.merge(name, claims(spark, "range(9)"), ignore)

    def breaks(old, new):
        return ignore(old, new).withColumn("channel_url", F.raise_error(F.lit("lost")).cast("string"))

    with pytest.raises(Exception, match="lost"):
        t.merge(name, claims(spark, "range(20)"), breaks, "s", 0)
    assert t.versions(name) == [0] and len(stored(t)) == 9 and t.applied(name, "s")["batch"] == -1
    assert t.merge(name, claims(spark, "range(20)"), ignore, "s", 0) and len(stored(t)) == 20

    def meanwhile(old, new):
        t.merge(name, claims(spark, "range(30)"), ignore)
        return ignore(old, new)

    with pytest.raises(RuntimeError, match="another writer"):
        t.merge(name, claims(spark, "range(40)"), meanwhile)
    assert len(stored(t)) == 30


def test_rows_written_without_buckets_are_dealt_at_the_first_merge(spark, tmp_path):
    t, name = tables_in(spark, tmp_path), "channels_discovery_claims"
    t.write(name, claims(spark, "range(100)"))
    t.merge(name, claims(spark, "range(99, 101)"), lambda old, new: ignore(old, new), "s", 0)
    assert len(stored(t)) == 101 and t.applied(name, "s") == {"batch": 0, "sent": 2, "stored": 1} and -1 not in t.manifest(name).parts
    t.write(name, claims(spark, "range(3)"))
    assert len(stored(t)) == 3 and t.applied(name, "s")["batch"] == 0


# runs and batches -------------------------------------------------------------------------------------------------------

HITS = "video_id string, video_url string, channel_url string, duration_text string, views_text string, published_text string, thumbnail_url string, video_type string, is_multi_creator boolean, discovered_at timestamp, query string, n int"


def hits(spark, ids):
    return spark.createDataFrame([(i, None, "u", None, None, None, None, "video", None, None, "q", k) for k, i in enumerate(ids)], HITS)


def test_run_that_fails_is_closed(spark, tmp_path):
    t = tables_in(spark, tmp_path)
    bad = hits(spark, ["a", "b"]).withColumn("query", F.raise_error(F.lit("no page")).cast("string"))
    with pytest.raises(Exception, match="no page"):
        jobs.ingest_run(t, bad, "q", F.expr(CLOCK), "n", "s", 0)
    (run,) = t.read("search_runs").collect()
    assert run.finished_at is not None and t.read("videos_raw").count() == 0
    jobs.ingest_run(t, hits(spark, ["a", "b", "a", None]), "q", F.expr("timestamp '2024-03-01 00:00:00'"), "n", "s", 0)
    (again,) = t.read("search_runs").collect()
    assert again == run and t.read("videos_raw").count() == 2 and t.applied("videos_raw", "s") == {"batch": 0, "sent": 4, "stored": 2}


def test_stream_that_breaks_off_between_tables_goes_on(spark, tmp_path, monkeypatch):
    dump = lambda n: json.dumps({"entries": [{"id": f"v{n}"}], "channel": f"c{n}"})
    spark.createDataFrame([("u", 0, dump(1), "", 0), ("w", 1, "", "HTTP Error 404", 1)], DUMPS).write.parquet(f"{tmp_path}/in")
    t, real, left = tables_in(spark, tmp_path), Tables.merge, [1]

    def breaks(self, name, *rest, **more):
        if name == "channel_videos_raw" and left:
            left.pop()
            raise OSError("machine lost")
        return real(self, name, *rest, **more)

    monkeypatch.setattr(Tables, "merge", breaks)
    run = lambda: streams.enrich_stream(spark.readStream.schema(DUMPS).parquet(f"{tmp_path}/in"), t, f"{tmp_path}/checkpoint", F.expr(CLOCK), 3, "n")
    with pytest.raises(Exception, match="machine lost"):
        run()
    assert t.read("channels_raw").count() == 1 and t.read("channels_processed").count() == 0
    run()
    assert t.version("channels_raw") == 0 and [r.video_id for r in t.read("channel_videos_raw").collect()] == ["v1"]
    assert sorted((r.channel_url, r.status) for r in t.read("channels_processed").collect()) == [("u", "success"), ("w", "failed")]


def test_stream_of_hits_is_a_run_for_each_batch(spark, tmp_path):
    t = tables_in(spark, tmp_path)
    for ids in (["a", "b"], ["b", "c", "c"]):
        hits(spark, ids).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for _ in range(2):  # the second time nothing has arrived
        stream = spark.readStream.schema(HITS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        streams.ingest_stream(stream, t, f"{tmp_path}/checkpoint", "q", F.expr(CLOCK), "n")
    runs = t.read("search_runs").collect()
    assert len(runs) == 2 and all(r.finished_at for r in runs) and t.read("videos_raw").count() == 3
    (totals,) = t.manifest("videos_raw").applied.values()
    assert totals == {"batch": 1, "sent": 5, "stored": 3}


def test_only_the_dump_that_settles_a_channel_counts(spark):
    good = lambda *ids: json.dumps({"entries": [{"id": i} for i in ids], "channel": ids[0]})
    rows = [
        ("a", 0, good("a2"), "", 2), ("a", 1, "", "HTTP Error 404", 3), ("a", 1, "", "HTTP Error 429", 1), ("b", 1, "", "HTTP Error 404", 1), ("b", 0, good("b2"), "", 2),
        ("c", 0, good("c1", "c1b"), "", 1), ("c", 0, good("c2"), "", 2), ("d", 0, "{", "", 1), ("d", 0, "", "", 2), ("", 0, good("x"), "", 1), (None, 0, good("x"), "", 1), ("p", 0, good("p"), "", 1),
    ]
    done = spark.createDataFrame([("p",)], "channel_url string")
    for _ in range(2):
        random.Random(3).shuffle(rows)
        new = jobs.enrich(spark.createDataFrame(rows, DUMPS).repartition(3), done, F.expr(CLOCK), 40, "n")
        assert sorted((r.channel_url, r.status) for r in new["processed"].collect()) == [("a", "success"), ("b", "failed"), ("c", "success")]
        assert sorted((r.channel_url, r.video_id) for r in new["videos"].collect()) == [("a", "a2"), ("c", "c1"), ("c", "c1b")]
        assert sorted((r.channel_url, r.channel_name) for r in new["channels"].collect()) == [("a", "a2"), ("c", "c1")]
        assert {r.status: r["count"] for r in new["totals"].collect()} == {"success": 2, "failed": 6, "skipped": 4}


def test_counts_come_from_the_pass_that_writes_the_rows(spark):
    raw = spark.createDataFrame([(i, "u", "q", "1:00", "5 views", None, k) for k, i in enumerate(["a", "b", "a", "c", None, ""])], "video_id string, channel_url string, query string, duration_text string, views_text string, published_text string, n int")
    done = spark.createDataFrame([("c",)], "video_id string")
    fresh, counts = jobs.normalize_job(raw, done, F.expr(CLOCK), "n")
    assert sorted(r.video_id for r in fresh.collect()) == ["a", "b"]
    assert counts.get == {"fetched": 5, "prepared": 3, "inserted": 2, "ignored": 1}
    plan = fresh._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and plan.count("CollectMetrics") == 1
    assert plan.index("CollectMetrics") < plan.index("Aggregate")  # where the rows come out, after the last shuffle
    fresh, counts = jobs.normalize_job(raw.limit(0), done, F.expr(CLOCK), "n")
    assert fresh.count() == 0 and counts.get == {"fetched": 0, "prepared": 0, "inserted": 0, "ignored": 0}


def test_claims_expire(spark, tmp_path):
    t = tables_in(spark, tmp_path)
    t.write("videos_normalized", spark.sql("SELECT concat('c', id) channel_url, true validation_passed, timestamp_seconds(id) normalized_at FROM range(4)"))
    at = lambda day: F.expr(f"timestamp '2024-02-{day:02} 00:00:00'")
    runs = [sorted(r.channel_url for r in jobs.claim_job(t, at(day), limit, ttl=3 * 86400).collect()) for day, limit in ((1, 2), (2, 9), (3, 9), (4, 9), (5, 1))]
    assert runs == [["c0", "c1"], ["c2", "c3"], [], ["c0", "c1"], ["c2"]]
    log = sorted((r.channel_url, r.claimed_at.day) for r in t.read("channels_discovery_claims").collect())
    assert log == [("c0", 1), ("c0", 4), ("c1", 1), ("c1", 4), ("c2", 2), ("c2", 5), ("c3", 2)]


# streams ------------------------------------------------------------------------------------------------------------------


def test_state_of_a_deduplicated_stream_is_bounded(spark, tmp_path):
    schema = "k string, at timestamp"
    rows = lambda lo, hi: spark.sql(f"SELECT concat('k', id) k, timestamp_seconds(1000000800 + id * 3600) at FROM range({lo}, {hi})")
    for lo, hi in ((0, 100), (90, 200), (190, 300), (290, 400)):
        rows(lo, hi).unionByName(rows(lo, hi)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rows(0, 20).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")  # far too late
    spark.sql("SELECT 'k5' k, timestamp_seconds(1000000800 + 401 * 3600) at").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")  # a key whose time is over
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    query = streams.dedupe_stream(stream, ["k"], "at", "48 hours", f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    got = sorted((r.k, (int(r.at.timestamp()) - 1000000800) // 3600) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted([(f"k{k}", k) for k in range(400)] + [("k5", 401)])
    held = [p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: json.loads(p.json), query.recentProgress) if p["stateOperators"]]
    assert max(held) <= 260 and held[-1] < 160


# ranks and sketches -----------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("scores", [1, 3, 50])
def test_rank_over_borders(spark, scores):
    r = random.Random(scores)
    rows = [(k, None if r.random() < 0.1 else float(r.randrange(scores)) if r.random() < 0.7 else 0.0) for k in range(700)]
    got = order.with_rank(spark.createDataFrame(rows, "id int, score double").repartition(7), "score", ["id"]).collect()
    falling = sorted((s for _, s in rows if s is not None), reverse=True)
    first = {s: falling.index(s) + 1 for s in set(falling)} | {None: len(falling) + 1}
    assert {x.id: x["rank"] for x in got} == {k: first[s] for k, s in rows} and len(got) == 700
    assert order.with_rank(spark.createDataFrame([], "id int, score double"), "score", ["id"]).count() == 0


def test_sketched_median_keeps_its_error(spark, tmp_path):
    t, r = tables_in(spark, tmp_path, 4), random.Random(2)
    views = [int(r.paretovariate(0.8) * 100) for _ in range(30000)]
    rows = spark.createDataFrame([("hot", 100, v, k % 5) for k, v in enumerate(views)] + [("cold", 100, 7, 0), ("cold", 100, 9, 4), ("cold", 1, 1, 2), ("none", 100, None, 1)], "channel_url string, duration_seconds int, view_count long, b int")
    for b in (0, 1, 2, 2, 3, 4, 1):
        jobs.add_videos(t, rows.where(F.col("b") == b).drop("b"), "s", b)
    got = {x.channel_url: x for x in jobs.analyse_sketches(t.read("channel_sketches")).collect()}
    assert set(got) == {"hot", "cold"} and (got["hot"].n_videos, got["cold"].n_videos) == (30000, 2)
    assert got["hot"].avg_views == sum(views) / 30000 and got["cold"].avg_views == 8.0 and got["cold"].median_views in (7.0, 9.0)
    share = sum(v <= got["hot"].median_views for v in views) / 30000
    assert abs(share - 0.5) <= 0.0267
    assert t.read("channel_sketches").select(F.max(F.length("sketch"))).first()[0] < 8192


# entries and dumps --------------------------------------------------------------------------------------------------------------


def test_entries_as_rows(spark):
    deep = [{"id": "leaf"}]
    for k in range(12):
        deep = [{"id": f"a{k}"}, {"title": "t", "entries": deep}, 7, {"id": ""}]
    wide = [{"title": f"p{k}" if k % 7 else "Olive", "entries": [{"id": f"{k}-{j}"} for j in range(3)]} for k in range(200)]
    odd = [{"entries": None}, {"entries": 5}, {"title": None, "entries": [{"id": "n"}]}, {"title": "SHORTS", "entries": [{"id": "s"}]}]
    rows = [("deep", json.dumps({"entries": deep})), ("wide", json.dumps({"entries": wide})), ("odd", json.dumps({"entries": odd})), ("none", "{}"), ("null", None)]
    dumps = spark.createDataFrame(rows, "c string, t string").select("c", F.parse_json("t").alias("dump"))
    leaves = nested.flatten_rows(dumps, ["c"], "dump")
    plan = leaves._jdf.queryExecution().optimizedPlan().toString()
    assert "flatten(" not in plan and "aggregate(" not in plan.lower()
    want = [tuple(r) for r in nested.channel_videos(nested.flatten_entries(dumps, "dump"), "c", 500).collect()]
    assert sorted(tuple(r) for r in nested.video_rows(leaves, ["c"], 500).collect()) == sorted(want) and len(want) > 500
    assert nested.video_rows(leaves, ["c"], 0).count() == 3  # one at least
    assert nested.flatten_rows(dumps.limit(0), ["c"], "dump").count() == 0


def test_stored_dumps_are_not_parsed_again(spark, tmp_path):
    rows = [("a", 0, '{"channel_id": "x", "entries": [{"id": "v", "duration": 3}]}', ""), ("b", 1, "HTTP Error 404", " "), ("c", 0, "{", ""), ("d", 0, None, None), ("e", 0, "[1]", "")]
    dumps = spark.createDataFrame(rows, "channel_url string, returncode int, stdout string, stderr string")
    lists.store_parsed(dumps, f"{tmp_path}/dumps")
    again = lists.parsed(spark, f"{tmp_path}/dumps")
    cols = ["channel_url", "status", "permanent", "reason"]
    assert sorted(map(str, jobs.triage(again).select(cols).collect())) == sorted(map(str, jobs.triage(dumps).select(cols).collect()))
    ids = again.select("channel_url", nested.meta_of(F.col("dump"))["channel_id"].alias("id"))
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "stdout" not in plan
    assert {r.channel_url: r.id for r in ids.collect()} == {"a": "x", "b": None, "c": None, "d": None, "e": None}


# the filter of done keys ----------------------------------------------------------------------------------------------------------


def test_filter_keeps_the_history_from_being_shuffled(spark, tmp_path, monkeypatch):
    t = tables_in(spark, tmp_path)
    done = spark.range(20000).selectExpr("concat('k', id) key", "id")
    done.write.parquet(f"{tmp_path}/done")
    done = spark.read.parquet(f"{tmp_path}/done")
    blocks = seen.blocks_for(20000)
    for k in range(3):
        seen.add_done(t, done.where(F.col("id") % 3 == k).select("key"), "key", blocks, "s", k)
    raw = spark.range(19990, 23000).selectExpr("concat('k', id) key", "id x").unionByName(spark.sql("SELECT CAST(NULL AS STRING) key, 1L x"))
    kept, real = {}, seen.written
    monkeypatch.setattr(seen, "written", lambda df, what: kept.setdefault(what, df) and real(df, what))
    got = seen.unprocessed(raw, done, t.read("seen_blocks"), blocks, "key").collect()
    assert sorted(map(str, got)) == sorted(map(str, raw.where("x >= 20000 OR key IS NULL").collect()))
    passed = kept["asked"].count()
    assert 10 <= passed <= 10 + 3000 * 0.03  # few new keys pass for old ones
    plan = kept["found"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("hashpartitioning") <= 1  # that of the few found
    assert seen.unprocessed(raw, done.limit(0), t.read("seen_blocks").limit(0), blocks, "key").count() == raw.count()
