"""What shows on larger tables only: nothing left to do, rows per stage, how often dumps are parsed."""

import glob

import duckdb
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from vidpipe import fixtures, registry, scratch
from vidpipe.operators import merge, nested, order
from vidpipe.plans import jobs
from vidpipe.sources import lists
from vidpipe.sources.state import Tables

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_open_batch_is_an_empty_list(spark, tmp_path):
    rows = [(0, "a", 1), (4, "a", 1)]  # the second part is a run of the query of both
    spark.createDataFrame(rows, "p_partkey bigint, p_name string, p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet/*.parquet'")
    got = [tuple(r) for r in registry.QUERIES["pending_batches"](spark, str(tmp_path)).collect()]
    assert got == [("[]", 1)] == con.execute(registry.ORACLE_SQL["pending_batches"]).fetchall()


def test_dumps_are_made_with_one_shuffle(spark):
    plan = fixtures._dumps(spark, SF)._jdf.queryExecution().sparkPlan().toString()
    whole = fixtures._dumps(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert whole.count("Exchange") == 1 and "collect_list" in plan


def test_dumps_are_parsed_once(spark):
    good = jobs.triage(fixtures.dumps(spark, SF)).where("status = 'success'").select("channel_url", "dump", "reason")
    assert _plan(good).lower().replace("_", "").count("parsejson") == 1, _plan(good)[:1500]


def test_dumps_are_not_moved_for_a_table_without_rows(spark, tmp_path):
    none = Tables(spark, f"file://{tmp_path}/tables", "es").read("channels_processed")
    assert none.count() == 0 and none.columns == ["channel_url", "processed_at", "status"]
    rows = jobs.parse_dumps(fixtures.dumps(spark, SF), none, 3)
    assert "Join" not in _plan(rows) and "Union" not in _plan(rows)


def test_dumps_of_processed_channels_are_read_once(spark):
    d = fixtures.dumps(spark, SF)
    rows = jobs.parse_dumps(d, d.where("k % 7 = 0").select("channel_url"), 3)
    assert "Union" not in _plan(rows)
    assert rows.where("status = 'skipped' AND meta IS NULL AND videos IS NULL AND NOT permanent").count() == d.where("k % 7 = 0").count()


def test_first_of_a_key_twice_needs_one_shuffle(spark):
    rows = spark.range(50).selectExpr("concat('k', id % 5) k", "concat('j', id % 3) j", "id o", "cast(id AS string) t")
    once = merge.first_wins(rows, ["k", "j"], "o")
    whole = merge.first_wins(once, ["k", "j"], None)
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(tuple(r) for r in whole.collect()) == sorted((f"k{n % 5}", f"j{n % 3}", n, str(n)) for n in range(15))
    assert merge.first_wins(rows.select("k", "j"), ["k", "j"], None).count() == 15


def test_positions_need_no_second_shuffle(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 o")
    indexed = order.with_index(rows, ["o"])
    assert "Window [row_number" not in _plan(indexed)
    assert all(r.o == r.idx for r in indexed.collect()) and indexed.count() == 1000


def _columns(folder):
    return {c.path for file in glob.glob(f"{folder}/*.parquet") for c in map(pq.ParquetFile(file).schema.column, range(len(pq.ParquetFile(file).schema)))}


def test_stored_dumps_give_only_the_fields_asked_for(spark, tmp_path):
    lists.store_parsed(fixtures.dumps(spark, SF), f"{tmp_path}/dumps")
    columns = _columns(f"{tmp_path}/dumps")
    assert "dump.typed_value.channel_id.typed_value" in columns
    assert [c for c in columns if ".entries." in c] == ["dump.typed_value.entries.value"]  # what is in the entries is not taken apart
    plan = registry.QUERIES["stored_dumps"](spark, SF)._jdf.queryExecution().executedPlan()
    schema = plan.collectLeaves().head().requiredSchema().sql()
    assert schema.count("VARIANT") == 4, schema  # two fields, each with another to fall back on
    before = spark.conf.get("spark.sql.variant.shredding.maxSchemaDepth"), spark.conf.get("spark.sql.variant.inferShreddingSchema")
    assert before == ("50", "true")


def test_entries_of_two_levels_are_written_once_and_whole(spark):
    good = jobs.triage(fixtures.dumps(spark, SF)).where("status = 'success'").select("channel_url", "dump")
    since = scratch.made(spark)
    leaves = nested.flatten_rows(good, ["channel_url"], "dump")
    made = scratch._MADE[spark.sparkContext.applicationId][since:]
    assert len(made) == 1
    columns = _columns(made[0].removeprefix("file://"))
    assert {c for c in columns if c.startswith("entry")} == {"entry.value", "entry.metadata"}
    flat = nested.flatten_entries(good, "dump").select(F.sum(F.size("leaves"))).first()[0]
    assert leaves.count() == flat == spark.read.parquet(made[0]).count()
