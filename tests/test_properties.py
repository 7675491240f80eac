"""Properties of merges, batches and claims, and of plans."""

from pyspark.sql import functions as F

from vidpipe.operators import merge, nested, order, relate
from vidpipe.plans import jobs


def test_insert_ignore_is_idempotent(spark):
    old = spark.createDataFrame([("a", 1, 0)], "k string, v int, o int")
    new = spark.createDataFrame([("a", 2, 1), ("b", 3, 2), ("b", 4, 1), (None, 5, 3), ("", 6, 4)], "k string, v int, o int")
    once = merge.insert_ignore(old, new, ["k"], "o")
    assert sorted(map(tuple, once.collect())) == [("a", 1, 0), ("b", 4, 1)]
    assert sorted(map(tuple, merge.insert_ignore(once, new, ["k"], "o").collect())) == sorted(map(tuple, once.collect()))


def test_upserts(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("a", None, "z"), ("c", 3, None)], "k string, v int, w string")
    coalesced = merge.upsert(old, new, ["k"])
    assert sorted(map(tuple, coalesced.collect())) == [("a", 1, "z"), ("b", 2, "y"), ("c", 3, None)]
    assert sorted(map(tuple, merge.upsert(coalesced, new, ["k"]).collect())) == sorted(map(tuple, coalesced.collect()))
    over = merge.upsert(old, new, ["k"], mode="overwrite")
    assert sorted(map(tuple, over.collect()), key=str) == sorted([("a", None, "z"), ("b", 2, "y"), ("c", 3, None)], key=str)


def test_index_and_batches_partition_the_list(spark):
    rows = spark.range(1000).select((F.col("id") * 7 % 1000).alias("pos"), F.col("id").cast("string").alias("query"))
    indexed = order.with_index(rows, ["pos"])
    assert [r.idx for r in indexed.orderBy("pos").collect()] == list(range(1000))
    parts = [set(r.pos for r in order.batch(indexed, b, 300).collect()) for b in range(4)]
    assert [len(p) for p in parts] == [300, 300, 300, 100] and len(set().union(*parts)) == 1000


def test_claims_of_rounds_are_disjoint(spark):
    normal = spark.sql("SELECT concat('c', id % 30) channel_url, id % 2 = 0 validation_passed, timestamp_seconds(id) normalized_at FROM range(200)")
    none = spark.createDataFrame([], "channel_url string")
    first = relate.claim(normal, none, none, 5)
    second = relate.claim(normal, none, first.select("channel_url"), 5)
    a, b = ({r.channel_url for r in x.collect()} for x in (first, second))
    assert len(a) == len(b) == 5 and not a & b
    assert relate.claim(normal, none, none, -1).count() == 0


def test_claims_without_limit_number_every_candidate(spark):
    normal = spark.sql("SELECT concat('c', id) channel_url, true validation_passed, timestamp_seconds(id) normalized_at FROM range(1000025)")
    none = spark.createDataFrame([], "channel_url string")
    every = relate.claim(normal, none, none, None)
    assert "Limit" not in every._jdf.queryExecution().toString()
    rounds = order.worker_shares(order.with_index(every, ["first_normalized_at", "channel_url"]), None, 10)
    assert tuple(rounds.agg(F.count("*"), F.max("worker"), F.count_distinct("worker")).first()) == (1000025, 100002, 100003)


def test_claim_rounds_has_no_limit(spark, monkeypatch):
    from vidpipe import registry

    plans, real = [], order.with_index
    monkeypatch.setattr(order, "with_index", lambda rows, by: plans.append(rows._jdf.queryExecution().toString()) or real(rows, by))
    registry.QUERIES["claim_rounds"](spark, "/root/testdata/sf0.001")
    assert len(plans) == 1 and "Limit" not in plans[0]


def test_second_claim_job_hands_out_other_channels(spark, tmp_path):
    from vidpipe.sources.state import Tables

    tables = Tables(spark, f"file://{tmp_path}", "es")
    tables.write("videos_normalized", spark.sql("SELECT concat('c', id) channel_url, true validation_passed, timestamp_seconds(id) normalized_at FROM range(8)"))
    runs = [sorted(r.channel_url for r in jobs.claim_job(tables, F.current_timestamp(), 5).collect()) for _ in range(3)]
    assert runs == [["c0", "c1", "c2", "c3", "c4"], ["c5", "c6", "c7"], []]
    assert tables.read("channels_discovery_claims").where("claimed_at IS NOT NULL").count() == 8


def test_nested_entries(spark):
    text = '{"entries":[{"title":"Videos","entries":[{"id":"1"},{"title":"Live now","entries":[{"id":"2"}]},{"title":null,"entries":[{"id":"3"}]}]},5,{"id":"4"},{"id":"","entries":null},{"id":""}]}'
    rows = spark.createDataFrame([(text,)], "t string").select(F.lit("c").alias("c"), F.parse_json("t").alias("dump"))
    flat = nested.flatten_entries(rows, "dump")
    assert [r.video_id for r in nested.channel_videos(flat, "c").collect()] == ["1", "3", "4"]
    assert flat.select("deeper").first()[0] == 0
    assert nested.flatten_entries(rows, "dump", depth=1).select("deeper").first()[0] == 2


def test_triage(spark):
    rows = [("a", 0, '{"x":1}', ""), ("b", 1, "", "HTTP Error 404: gone"), ("c", 1, "", "HTTP Error 429"), ("d", 0, " ", ""), ("e", 0, "{", ""), ("f", 0, "[]", ""), ("", 0, "{}", "")]
    got = jobs.triage(spark.createDataFrame(rows, "channel_url string, returncode int, stdout string, stderr string"))
    assert [(r.status, r.permanent) for r in got.collect()] == [("success", False), ("failed", True)] + [("failed", False)] * 5


def test_no_python_in_plans(spark):
    from vidpipe import registry

    plan = registry.QUERIES["normalize_job"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "LeftAnti" in plan
