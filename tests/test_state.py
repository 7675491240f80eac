"""Snapshots that survive crashes, streams that keep keys unique, and dumps of any depth and message of any length."""

import json

from pyspark.sql import functions as F

from vidpipe.functions import text
from vidpipe.operators import merge, nested, order
from vidpipe.plans import jobs
from vidpipe.sources import lists
from vidpipe.sources.state import Tables
from vidpipe.streaming import streams

CLOCK = "timestamp '2024-02-01 00:00:00'"


def _tables(spark, tmp_path):
    return Tables(spark, f"file://{tmp_path}/tables", "es")


def test_broken_write_leaves_the_table_as_it_was(spark, tmp_path):
    tables = _tables(spark, tmp_path)
    tables.write("channels_processed", spark.sql(f"SELECT 'a' channel_url, {CLOCK} processed_at, 'success' status"))
    half = tmp_path / "tables/channels_processed/lang=es/v=1"
    half.mkdir()
    (half / "part-00000.parquet").write_bytes(b"not a table")
    assert tables.version("channels_processed") == 0 and tables.read("channels_processed").count() == 1
    tables.write("channels_processed", tables.read("channels_processed").union(spark.sql(f"SELECT 'b', {CLOCK}, 'failed'")))
    assert tables.version("channels_processed") == 1
    assert sorted(r.channel_url for r in lists.table(spark, tables.root, "channels_processed", "es").collect()) == ["a", "b"]
    assert lists.table(spark, tables.root, "channels_processed", "en").count() == 0
    tables.forget("channels_processed", keep=1)
    assert tables.versions("channels_processed") == [1]


def _dump(n, **fields):
    return json.dumps({"entries": [{"id": f"v{n}"}], "channel": f"c{n}", **fields})


def test_channel_given_twice_in_a_batch_counts_once(spark, tmp_path):
    rows = [("u", 0, _dump(1, verified=True), ""), ("u", 0, _dump(2), ""), ("w", 0, _dump(3), ""), ("w", 0, _dump(3), "")]
    schema = "channel_url string, returncode int, stdout string, stderr string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    tables = _tables(spark, tmp_path)
    streams.enrich_stream(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), tables, f"{tmp_path}/checkpoint", F.expr(CLOCK), 3)
    for name in ("channels_raw", "channels_processed"):
        assert sorted(r.channel_url for r in tables.read(name).collect()) == ["u", "w"], name
    keys = [(r.channel_url, r.video_id) for r in tables.read("channel_videos_raw").collect()]
    assert len(keys) == len(set(keys))


def test_missing_verified_flag_is_false(spark):
    schema = "channel_url string, returncode int, stdout string, stderr string"
    new = jobs.enrich(spark.createDataFrame([("u", 0, _dump(1), "")], schema), spark.createDataFrame([], "channel_url string"), F.expr(CLOCK))["channels"]
    old = spark.sql(f"SELECT 'u' channel_url, 'x' channel_id, 'n' channel_name, 1L subscriber_count, true is_verified, {CLOCK} extracted_at")
    assert [r.is_verified for r in merge.upsert(old, new, ["channel_url"], always=("extracted_at",)).collect()] == [False]


def test_entries_of_any_depth(spark):
    deep = [{"id": "leaf"}]
    for k in range(60):
        deep = [{"id": f"a{k}"}, {"title": "t", "entries": deep}]
    rows = spark.createDataFrame([(json.dumps({"entries": deep}),)], "t string").select(F.lit("c").alias("c"), F.parse_json("t").alias("dump"))
    got = nested.channel_videos(nested.flatten_entries(rows, "dump"), "c", 1000).orderBy("pos").collect()
    assert [r.video_id for r in got] == [f"a{k}" for k in reversed(range(60))] + ["leaf"]
    wide = {"entries": [{"title": f"p{k}", "entries": [{"id": f"{k}-{j}"} for j in range(3)]} for k in range(300)]}
    rows = spark.createDataFrame([(json.dumps(wide),)], "t string").select(F.lit("c").alias("c"), F.parse_json("t").alias("dump"))
    assert nested.channel_videos(nested.flatten_entries(rows, "dump"), "c", 10000).count() == 900


def test_triage_reads_the_whole_message(spark):
    schema = "channel_url string, returncode int, stdout string, stderr string"
    rows = [("a", 1, "", "WARNING: " + "x" * 3000 + " HTTP Error 404: Not Found"), ("b", 1, "", "y" * 6000 + " HTTP Error 404"), ("c", 0, '{"x": "HTTP Error 404"}', "HTTP Error 404")]
    got = {r.channel_url: r for r in jobs.triage(spark.createDataFrame(rows, schema)).collect()}
    assert got["a"].permanent and len(got["a"].reason) == 100
    assert not got["b"].permanent and not got["c"].permanent and got["c"].status == "success"


def test_anchors_keep_first_place_and_last_text(spark):
    html = "".join(f'<a href="/{k % 7}">t{k}</a>' for k in range(200)) + '<a href="/3"> </a>'
    got = spark.createDataFrame([(html,)], "h string").select(nested.dedupe_anchors(nested.anchors(F.col("h"))).alias("a")).first().a
    last = {f"/{k % 7}": f"t{k}" for k in range(200)} | {"/3": None}
    assert [(x.href, x.text) for x in got] == list(last.items())
    assert spark.sql("SELECT cast(array() AS array<struct<href: string, text: string>>) a").select(nested.dedupe_anchors(F.col("a"))).first()[0] == []


def test_ordinals_of_a_hot_key(spark):
    rows = spark.range(900).selectExpr("CASE WHEN id % 3 < 2 THEN 'hot' ELSE concat('k', id % 50) END k", "id o")
    got = order.ordinal(rows, ["k"], ["o"]).collect()
    of = {}
    for r in sorted(got, key=lambda r: r.o):
        assert r.ordinal == of.get(r.k, 0)
        of[r.k] = r.ordinal + 1


def test_seed_files_keep_their_order(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f" q{k} \n\n" for k in range(500)))
    (tmp_path / "b.txt").write_text("last\n")
    rows = lists.read_seed_file(spark, f"{tmp_path}").orderBy("pos").collect()
    assert [r["query"] for r in rows] == [f"q{k}" for k in range(500)] + ["last"] and [r.pos for r in rows] == [*range(0, 1000, 2), 1000]


def test_units_by_list_order(spark):
    cases = {"2 hours 3 h": 10800, "3 h 2 hours": 10800, "1 min 2 minutes 9 s": 69, "5 sec 4 s": 4}
    rows = spark.createDataFrame([(k,) for k in cases], "x string").select("x", text.parse_duration(F.col("x")).alias("y"))
    assert {r.x: r.y for r in rows.collect()} == cases


def test_normalize_job_is_compiled(spark):
    from vidpipe import registry

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that the plan is final at once
    try:
        plan = registry.QUERIES["normalize_job"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
        whole = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenStringSeq(plan)
        sizes = [whole.apply(k)._3().maxMethodCodeSize() for k in range(whole.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and 0 < max(sizes) < 8000  # what the JVM still compiles
