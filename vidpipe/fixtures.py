"""Views that give the driver's tables the shape of search hits, seed lists and dumps: SQL that Spark and DuckDB both read.

Table names stand in braces.  The clock of all relative ages is NOW.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.values import let, or_false
from .scratch import written

NOW = "2024-02-01 00:00:00"

VIEWS = {
    "fx_hits": """
SELECT event_id,
  'v' || CAST(CASE WHEN event_id % 5 = 4 THEN event_id - 4 ELSE event_id END AS STRING) AS video_id,
  'r' || CAST(event_id % 7 AS STRING) AS search_run_id,
  event_type AS query,
  CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN ''
       ELSE ' https://v.example/@u' || CAST(user_id AS STRING) || ' ' END AS channel_url,
  CASE event_id % 10
    WHEN 0 THEN CAST(n AS STRING) || ' views'
    WHEN 1 THEN NULL
    WHEN 2 THEN 'No views'
    WHEN 3 THEN CAST(1 + n % 9 AS STRING) || ',' || lpad(CAST(n % 1000 AS STRING), 3, '0') || ' views'
    WHEN 4 THEN CAST(n % 90 AS STRING) || '.' || CAST(n % 10 AS STRING) || 'K views'
    WHEN 5 THEN CAST(n % 90 AS STRING) || ',' || CAST(n % 10 AS STRING) || ' mil vistas'
    WHEN 6 THEN '1.' || lpad(CAST(n % 1000 AS STRING), 3, '0') || ' visualizaciones'
    WHEN 7 THEN CAST(1 + n % 9 AS STRING) || '.' || CAST(n % 10 AS STRING) || 'M de visualizaciones'
    WHEN 8 THEN '1.234.' || lpad(CAST(n % 1000 AS STRING), 3, '0') || ' vistas'
    ELSE '   ' END AS views_text,
  CASE event_id % 8
    WHEN 0 THEN CAST(n % 60 AS STRING) || ':' || lpad(CAST(n % 60 AS STRING), 2, '0')
    WHEN 1 THEN '1:' || lpad(CAST(n % 60 AS STRING), 2, '0') || ':07'
    WHEN 2 THEN NULL
    WHEN 3 THEN CAST(1 + n % 3 AS STRING) || ' hours ' || CAST(n % 60 AS STRING) || ' minutes'
    WHEN 4 THEN '1 hora, ' || CAST(n % 60 AS STRING) || ' minutos'
    WHEN 5 THEN 'SHORTS'
    WHEN 6 THEN CAST(n % 200 AS STRING) || ' s'
    ELSE '1:2:3:4' END AS duration_text,
  CASE event_id % 9
    WHEN 0 THEN CAST(1 + n % 20 AS STRING) || ' days ago'
    WHEN 1 THEN 'hace ' || CAST(1 + n % 20 AS STRING) || ' horas'
    WHEN 2 THEN 'Streamed ' || CAST(1 + n % 4 AS STRING) || ' weeks ago'
    WHEN 3 THEN 'hace ' || CAST(2 + n % 9 AS STRING) || ' meses'
    WHEN 4 THEN 'yesterday'
    WHEN 5 THEN 'Jan ' || CAST(1 + n % 28 AS STRING) || ', 2024'
    WHEN 6 THEN '2024-01-' || lpad(CAST(1 + n % 28 AS STRING), 2, '0')
    WHEN 7 THEN NULL
    ELSE 'hace ' || CAST(1 + n % 5 AS STRING) || ' años' END AS published_text,
  ts AS discovered_at
FROM (SELECT *, CAST(floor(value * 100) AS BIGINT) AS n FROM {events}) e""",
    "fx_normalized": """
SELECT 'v' || CAST(event_id AS STRING) AS video_id,
  CASE WHEN user_id % 10 = 0 THEN NULL WHEN user_id % 10 = 1 THEN ''
       ELSE 'https://v.example/@u' || CAST(user_id AS STRING) END AS channel_url,
  value > 20 AS validation_passed, ts AS normalized_at
FROM {events} WHERE event_id % 3 <> 0""",
    "fx_processed": """
SELECT DISTINCT 'https://v.example/@u' || CAST(user_id AS STRING) AS channel_url,
  TIMESTAMP '2024-01-15 00:00:00' AS processed_at,
  CASE WHEN user_id % 8 = 0 THEN 'failed' ELSE 'success' END AS status
FROM {events} WHERE user_id % 4 = 0""",
    "fx_claims": """
SELECT DISTINCT 'https://v.example/@u' || CAST(user_id AS STRING) AS channel_url,
  TIMESTAMP '2024-01-16 00:00:00' AS claimed_at
FROM {events} WHERE user_id % 6 = 5""",
    "fx_channels": """
SELECT DISTINCT 'https://v.example/@u' || CAST(user_id AS STRING) AS channel_url FROM {events}""",
    "fx_seed": """
SELECT p_partkey AS pos,
  CASE WHEN p_partkey % 50 = 7 THEN '   '
       ELSE '  ' || p_name || ' ' || CAST(p_size AS STRING) || ' ' END AS line
FROM {part}""",
    "fx_runs": """
SELECT 'r' || CAST(p_partkey AS STRING) AS id,
  CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN ''
       ELSE p_name || ' ' || CAST(p_size AS STRING) END AS query,
  'exploration' AS mode
FROM {part} WHERE p_partkey % 9 = 4""",
    "fx_dump_entries": """
SELECT 'https://v.example/@c' || CAST(l_orderkey AS STRING) AS channel_url, pos, pos % 3 AS grp_ord,
  CASE pos % 3 WHEN 0 THEN 'Videos' WHEN 1 THEN 'Olive shorts' ELSE NULL END AS grp_title,
  CASE WHEN l_partkey % 17 = 0 THEN '' ELSE 'p' || CAST(l_partkey AS STRING) END AS id,
  CASE WHEN l_linenumber = 2 THEN NULL ELSE l_quantity END AS duration,
  CAST(floor(l_extendedprice) AS BIGINT) AS view_count,
  CASE WHEN l_linenumber % 2 = 0 THEN '20240131' ELSE NULL END AS upload_date,
  CASE WHEN l_linenumber = 1 THEN 0 WHEN l_linenumber = 3 THEN NULL ELSE 1706659200 END AS epoch,
  1700000000 + pos * 86400 AS release_epoch
FROM (SELECT l.*, row_number() OVER (PARTITION BY l_orderkey
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS pos FROM {lineitem} l) x""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    table = next(t for t in ("events", "part", "lineitem") if "{" + t + "}" in sql)
    return spark.sql(sql, **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


def duck(*names: str) -> str:
    """A WITH clause of some views, for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n].format(events='events', part='part', lineitem='lineitem')})" for n in names)


_DUMPS: dict[tuple[str, str], DataFrame] = {}


def dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(channel_url, k, returncode, stdout, stderr)``: a JSON dump of each channel's entries, some of them broken; written once for a folder of tables."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _DUMPS:
        _DUMPS[key] = written(_dumps(spark, sf_dir), "dumps")
    return _DUMPS[key]


def _dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the entries of fx_dump_entries, made from a channel's lines; of lineitem only what they need is moved, and once
    lines = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    d = F.col("k") % 10
    broken = or_false(d.isin(1, 2, 3, 4, 5))  # none of these outputs shows an entry
    by_key = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.col("l_orderkey").alias("k"), *lines).repartition("k").groupBy("k")
    by = by_key.agg(F.sort_array(F.collect_list(F.when(~broken, F.struct(*lines)))).alias("lines"))

    def entry(x, i):
        pos, number = (i + 1).cast("bigint"), x["l_linenumber"]
        e = F.struct(
            F.when(x["l_partkey"] % 17 == 0, F.lit("")).otherwise(F.concat(F.lit("p"), x["l_partkey"].cast("string"))).alias("id"),
            F.when(number == 2, F.lit(None)).otherwise(x["l_quantity"]).alias("duration"), F.floor(x["l_extendedprice"]).cast("bigint").alias("view_count"),
            F.when(number % 2 == 0, F.lit("20240131")).alias("upload_date"), F.when(number == 1, F.lit(0)).when(number == 3, F.lit(None)).otherwise(F.lit(1706659200)).alias("timestamp"),
            (F.lit(1700000000) + pos * 86400).alias("release_timestamp"),
        )
        return F.struct((pos % 3).alias("g"), e.alias("e"))

    def listed(placed):
        of = lambda g: F.to_json(F.transform(F.filter(placed, lambda x: x["g"] == g), lambda x: x["e"]))
        nested = lambda title, g: F.concat(F.lit('{"title":"' + title + '","entries":'), of(g), F.lit("}"))
        return let(of(2), lambda own: F.concat(F.lit("["), nested("Videos", 0), F.lit(","), nested("Olive shorts", 1), F.when(own != "[]", F.lit(",")).otherwise(F.lit("")), F.substring(own, 2, 2**31 - 1)))

    own = F.when(F.col("k") % 3 == 0, F.concat(F.lit('"uploader_id":"u'), "k", F.lit('","uploader":"n'), "k", F.lit('","channel_follower_count":"'), "k", F.lit('"'))).otherwise(
        F.concat(F.lit('"channel_id":"c'), "k", F.lit('","channel":"m'), "k", F.lit('","subscriber_count":'), "k", F.lit('.7,"verified":true'))
    )
    good = F.concat(F.lit("{"), own, F.lit(',"entries":'), let(F.transform("lines", entry), listed), F.lit("}"))
    return by.select(
        F.concat(F.lit("https://v.example/@c"), F.col("k").cast("string")).alias("channel_url"), "k", F.when(d.isin(1, 2), 1).otherwise(0).alias("returncode"),
        F.when(d == 3, F.lit("")).when(d == 4, F.lit("{bad")).when(d == 5, F.lit("[1]")).when(d.isin(1, 2), F.lit("")).otherwise(good).alias("stdout"),
        F.when(d == 1, F.lit("HTTP Error 404")).when(d == 2, F.lit("HTTP Error 429")).otherwise(F.lit("")).alias("stderr"),
    )
