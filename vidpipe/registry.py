"""Registered queries of the library's own operators, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fixtures import NOW, duck, dumps, view
from .functions import labels, text, urls, values
from .operators import merge, nested, order, relate, seen, validate
from .plans import jobs
from .scratch import new_path, written
from .sources import lists, state
from .streaming import streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

def _now():
    return F.lit(NOW).cast("timestamp")


_DUCK_NOW = f"TIMESTAMPTZ '{NOW}+00'"


def _query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# SQL of the parsers, written apart from the column functions -----------------------------------------------

_norm = lambda x: f"nullif(trim(regexp_replace({x}, '\\s+', ' ', 'g')), '')"


# words and units as the parsers must know them, written out here so that a wrong one there shows
_VIEW_WORDS = ("views", "view", "vistas", "visualizaciones", "reproducciones", "de", "•")
_AGE_PREFIXES = ("premiered", "streamed", "hace", "emitido", "estrenado", "transmitido", "se emitió")
_AGE_EN, _AGE_ES = "minute|min|hour|day|week|month|year", "minuto|hora|d[ií]a|dia|semana|mes|a[nñ]o"
_UNIT_SECONDS = {"minute": 60, "min": 60, "minuto": 60, "hour": 3600, "hora": 3600, "day": 86400, "dia": 86400, "week": 604800, "semana": 604800, "month": 2592000, "mes": 2592000, "year": 31536000, "ano": 31536000}
_HOURS = ("h", "hr", "hrs", "hour", "hours", "hora", "horas")
_MINUTES = ("m", "min", "mins", "minute", "minutes", "minuto", "minutos")
_SECONDS = ("s", "sec", "secs", "second", "seconds", "segundo", "segundos")


def _replace_all(x: str, words: tuple[str, ...]) -> str:
    for w in words:
        x = f"replace({x}, '{w}', ' ')"
    return x


_VIEWS = f"""
v0 AS (SELECT *, lower({_norm('views_text')}) AS low FROM fx_hits),
v1 AS (SELECT *, coalesce({_norm(_replace_all('low', _VIEW_WORDS))}, '') AS cleaned FROM v0),
v2 AS (SELECT *, regexp_extract(cleaned, '((?:[0-9]{{1,3}}(?:[.,][0-9]{{3}})+|[0-9]+)(?:[.,][0-9]+)?)\\s*([kmb])?', 1) AS num,
  regexp_extract(cleaned, '((?:[0-9]{{1,3}}(?:[.,][0-9]{{3}})+|[0-9]+)(?:[.,][0-9]+)?)\\s*([kmb])?', 2) AS suf FROM v1),
v3 AS (SELECT *, TRY_CAST(CASE
  WHEN contains(num, ',') AND contains(num, '.') THEN
    CASE WHEN strpos(reverse(num), ',') < strpos(reverse(num), '.') THEN replace(replace(num, '.', ''), ',', '.') ELSE replace(num, ',', '') END
  WHEN contains(num, ',') THEN CASE WHEN suf <> '' THEN replace(num, ',', '.') ELSE replace(num, ',', '') END
  WHEN contains(num, '.') AND suf = '' AND regexp_matches(num, '^[0-9]+\\.[0-9]{{3}}$') THEN replace(num, '.', '')
  ELSE num END AS DOUBLE) AS val FROM v2),
views AS (SELECT *, CASE WHEN low IS NULL THEN NULL WHEN contains(low, 'no views') OR contains(low, 'sin vistas') THEN 0 WHEN num = '' THEN NULL
  ELSE CAST(trunc(val * CASE suf WHEN 'k' THEN 1e3 WHEN 'm' THEN 1e6 WHEN 'b' THEN 1e9 ELSE 1 END) AS BIGINT) END AS views_estimated FROM v3)"""


def _unit_sql(names: tuple[str, ...]) -> str:
    found = ", ".join(f"nullif(regexp_extract(w, '([0-9]+)\\s*{n}\\b', 1), '')" for n in names)
    return f"coalesce(CAST(coalesce({found}) AS BIGINT), 0)"


_DURATION = f"""
d0 AS (SELECT *, {_norm('duration_text')} AS dt FROM views),
d1 AS (SELECT *, {_norm("replace(replace(lower(dt), ',', ' '), '·', ' ')")} AS w, string_split(dt, ':') AS p FROM d0),
durations AS (SELECT *, CASE WHEN regexp_matches(dt, '^[0-9]+:[0-9]+$') THEN CAST(p[1] AS BIGINT) * 60 + CAST(p[2] AS BIGINT)
  WHEN regexp_matches(dt, '^[0-9]+:[0-9]+:[0-9]+$') THEN CAST(p[1] AS BIGINT) * 3600 + CAST(p[2] AS BIGINT) * 60 + CAST(p[3] AS BIGINT)
  ELSE nullif({_unit_sql(_HOURS)} * 3600 + {_unit_sql(_MINUTES)} * 60 + {_unit_sql(_SECONDS)}, 0) END AS duration_seconds_estimated FROM d1)"""

_UNITS = "CASE strip_accents(unit) " + " ".join(f"WHEN '{u}' THEN {s}" for u, s in _UNIT_SECONDS.items()) + " END"
_PUBLISHED = f"""
p0 AS (SELECT *, {_norm('published_text')} AS pt FROM durations),
p1 AS (SELECT *, coalesce({_norm(_replace_all('lower(pt)', _AGE_PREFIXES))}, '') AS pl FROM p0),
p2 AS (SELECT *, coalesce(nullif(regexp_extract(pl, '([0-9]+)\\s*({_AGE_EN})s?\\b', 1), ''), nullif(regexp_extract(pl, '([0-9]+)\\s*({_AGE_ES})s?\\b', 1), '')) AS qty,
  coalesce(nullif(regexp_extract(pl, '([0-9]+)\\s*({_AGE_EN})s?\\b', 2), ''), nullif(regexp_extract(pl, '([0-9]+)\\s*({_AGE_ES})s?\\b', 2), '')) AS unit FROM p1),
published AS (SELECT *, CASE WHEN pt IS NULL THEN NULL WHEN contains(pl, 'yesterday') OR contains(pl, 'ayer') THEN {_DUCK_NOW} - INTERVAL 1 DAY
  WHEN qty IS NOT NULL THEN {_DUCK_NOW} - to_seconds(CAST(qty AS BIGINT) * ({_UNITS}))
  ELSE CAST(coalesce(CASE WHEN regexp_matches(pt, '^[0-9]{{4}}-') THEN try_strptime(pt, '%Y-%m-%d') END, try_strptime(pt, '%b %d, %Y'), try_strptime(pt, '%d %b %Y')) AS TIMESTAMP) AT TIME ZONE 'UTC' END
  AS published_at_estimated FROM p2)"""

_PARSED = f"{duck('fx_hits')}, {_VIEWS.strip()}, {_DURATION.strip()}, {_PUBLISHED.strip()}"
_REASON = "CASE WHEN duration_seconds_estimated < 180 THEN 'duration_too_low' WHEN views_estimated < 1000 THEN 'views_too_low' END"


# parsers -----------------------------------------------------------------------------------------------------


@_query(f"{duck('fx_hits')} SELECT event_id, {_norm('channel_url')} AS channel_url FROM fx_hits")
def normalize_text(spark, sf_dir):
    return view(spark, sf_dir, "fx_hits").select("event_id", text.normalize_text(F.col("channel_url")).alias("channel_url"))


@_query(f"{_PARSED} SELECT event_id, views_text, views_estimated FROM published")
def parse_views(spark, sf_dir):
    return view(spark, sf_dir, "fx_hits").select("event_id", "views_text", text.parse_views(F.col("views_text")).alias("views_estimated"))


@_query(f"{_PARSED} SELECT event_id, duration_text, duration_seconds_estimated FROM published")
def parse_duration(spark, sf_dir):
    return view(spark, sf_dir, "fx_hits").select("event_id", "duration_text", text.parse_duration(F.col("duration_text")).alias("duration_seconds_estimated"))


@_query(f"{_PARSED} SELECT event_id, published_text, epoch_us(published_at_estimated) AS published_us FROM published")
def parse_published(spark, sf_dir):
    return view(spark, sf_dir, "fx_hits").select("event_id", "published_text", F.unix_micros(text.parse_published(F.col("published_text"), _now())).alias("published_us"))


@_query(
    """SELECT l_orderkey, l_linenumber, CAST(trunc(l_extendedprice) AS BIGINT) AS from_double, CAST(l_quantity AS BIGINT) AS from_text,
    CAST(NULL AS BIGINT) AS from_bool, l_returnflag = 'A' AS flag, CAST(NULL AS BOOLEAN) AS flag_of_number FROM lineitem"""
)
def coerce_values(spark, sf_dir):
    v = lambda sql: F.parse_json(F.expr(sql))
    return _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", values.coerce_int(v("cast(l_extendedprice as string)")).alias("from_double"),
        values.coerce_int(v("concat('\" ', cast(cast(l_quantity as bigint) as string), ' \"')")).alias("from_text"), values.coerce_int(v("'true'")).alias("from_bool"),
        values.strict_bool(v("case when l_returnflag = 'A' then 'true' else 'false' end")).alias("flag"), values.strict_bool(v("'1'")).alias("flag_of_number"),
    )


@_query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE epoch_us(ts) END AS us FROM events")
def ensure_timestamp(spark, sf_dir):
    shown = F.when(F.col("event_id") % 3 == 0, F.lit("not a time")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return _t(spark, sf_dir, "events").select("event_id", F.unix_micros(values.ensure_timestamp(shown)).alias("us"))


# hits -----------------------------------------------------------------------------------------------------------

_CHANNELS = "CASE WHEN event_id % 3 = 0 THEN array(named_struct('name', 'a', 'url', 'https://v.example/a'), named_struct('name', 'b', 'url', concat('https://v.example/', event_id))) WHEN event_id % 3 = 1 THEN array(named_struct('name', 'c', 'url', 'https://v.example/c')) END"


@_query(
    f"""{duck('fx_hits')} SELECT event_id, 'https://www.youtube.com/watch?v=' || video_id AS video_url, 'https://i.ytimg.com/vi/' || video_id || '/hqdefault.jpg' AS thumbnail_url,
    coalesce(nullif(channel_url, ''), CASE event_id % 3 WHEN 0 THEN 'https://v.example/a' WHEN 1 THEN 'https://v.example/c' END) AS channel_url,
    coalesce(event_id % 3 = 0, false) AS is_multi_creator FROM fx_hits"""
)
def hit_defaults(spark, sf_dir):
    hits = view(spark, sf_dir, "fx_hits").withColumn("channels", F.expr(_CHANNELS))
    none = F.lit(None).cast("string")
    return hits.select(
        "event_id", urls.video_url(none, F.col("video_id")).alias("video_url"), urls.thumbnail_url(none, F.col("video_id")).alias("thumbnail_url"),
        urls.channel_url(F.col("channel_url"), F.col("channels")).alias("channel_url"), values.or_false(urls.multi_creator(F.col("channels"))).alias("is_multi_creator"),
    )


@_query(f"{duck('fx_hits')} SELECT event_id, CASE WHEN contains(duration_text, ':') THEN 'video' ELSE 'short' END AS video_type FROM fx_hits")
def video_type(spark, sf_dir):
    return view(spark, sf_dir, "fx_hits").select("event_id", urls.video_type(F.col("duration_text")).alias("video_type"))


@_query("SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM pages")
def video_id_from_url(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", urls.query_parameter(F.col("url"), "page").alias("page"))


_ANCHORS = """WITH h AS (SELECT page_id, regexp_extract_all(html, '<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS hrefs,
  regexp_extract_all(html, '<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS texts FROM pages),
 a AS (SELECT page_id, unnest(hrefs) AS href, nullif(trim(unnest(texts)), '') AS text, generate_subscripts(hrefs, 1) - 1 AS pos FROM h)"""


@_query(f"{_ANCHORS} SELECT page_id, pos, 'https://site.example' || href AS url, text FROM a WHERE href LIKE '/%'")
def link_extract(spark, sf_dir):
    rows = _t(spark, sf_dir, "pages").select("page_id", F.posexplode(nested.anchors(F.col("html"))).alias("pos", "a")).where(F.startswith("a.href", F.lit("/")))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), urls.absolute("https://site.example", F.col("a.href")).alias("url"), F.col("a.text").alias("text"))


@_query(
    f"""{_ANCHORS}, d AS (SELECT page_id, href, min(pos) AS first, arg_max(struct_pack(t := text), pos) AS last FROM a GROUP BY page_id, href)
    SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY first) - 1 AS pos, href, last.t AS text FROM d"""
)
def anchor_dedupe(spark, sf_dir):
    rows = _t(spark, sf_dir, "pages").select("page_id", F.posexplode(nested.dedupe_anchors(nested.anchors(F.col("html")))).alias("pos", "a"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), F.col("a.href").alias("href"), F.col("a.text").alias("text"))


# the pages' links given the five shapes, by the first letter of their href
_SHAPES = (("a-f", '<a href="/@'), ("g-m", '<a href="/c/'), ("n-r", '<a href="/channel/'), ("s-t", '<ytd-channel-name><a href="/'), ("u-z", '<a id="channel-thumbnail" href="/'))
_SHAPED = "html"
for _letters, _link in _SHAPES:
    _SHAPED = f"""regexp_replace({_SHAPED}, '<a href="/([{_letters}])', '{_link}\\1', 'g')"""


@_query(f"""WITH h AS (SELECT page_id, {_SHAPED} AS html FROM pages),
  f AS (SELECT page_id, regexp_extract_all(html, '(?:<ytd-channel-name[^>]*>\\s*)?<a[^>]*href="[^"]*"[^>]*>[^<]*</a>') AS found FROM h),
  e AS (SELECT page_id, unnest(found) AS a, generate_subscripts(found, 1) AS i FROM f),
  s AS (SELECT page_id, i, regexp_extract(a, 'href="([^"]*)"', 1) AS href, nullif(trim(regexp_extract(a, '>([^<]*)</a>', 1)), '') AS text,
   CASE WHEN starts_with(a, '<ytd-channel-name') THEN 'name' WHEN contains(a, ' id="channel-thumbnail"') THEN 'thumbnail' WHEN starts_with(regexp_extract(a, 'href="([^"]*)"', 1), '/@') THEN '/@'
    WHEN starts_with(regexp_extract(a, 'href="([^"]*)"', 1), '/channel/') THEN '/channel/' WHEN starts_with(regexp_extract(a, 'href="([^"]*)"', 1), '/c/') THEN '/c/' END AS shape FROM e)
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, shape, href, text FROM s WHERE shape IS NOT NULL""")
def channel_links(spark, sf_dir):
    html = F.col("html")
    for letters, link in _SHAPES:
        html = F.regexp_replace(html, f'<a href="/([{letters}])', link + "$1")
    rows = _t(spark, sf_dir, "pages").select("page_id", F.posexplode(nested.channel_links(html)).alias("pos", "a"))
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), "a.*")


@_query(f"""{duck('fx_hits')}, c AS (SELECT event_id, unnest(CASE event_id % 3 WHEN 0 THEN [0, 1] WHEN 1 THEN [0] ELSE [NULL] END) AS pos FROM fx_hits)
    SELECT event_id, pos, CASE WHEN event_id % 3 = 1 THEN 'c' WHEN pos = 0 THEN 'a' WHEN pos = 1 THEN 'b' END AS name FROM c""")
def hit_channels(spark, sf_dir):
    hits = view(spark, sf_dir, "fx_hits").withColumn("channels", F.expr(_CHANNELS))
    return hits.select("event_id", F.posexplode_outer("channels").alias("pos", "c")).select("event_id", "pos", F.col("c.name").alias("name"))


@_query(f"""{duck('fx_hits')} SELECT search_run_id, query, event_id FROM fx_hits
    QUALIFY row_number() OVER (PARTITION BY search_run_id, query ORDER BY event_id) <= 5""")
def search_limit(spark, sf_dir):
    return order.top_per(view(spark, sf_dir, "fx_hits"), ["search_run_id", "query"], ["event_id"], 5).select("search_run_id", "query", "event_id")


@_query(f"{duck('fx_hits')} SELECT event_id, to_json(struct_pack(event_id := event_id, video_id := video_id, query := query)) :: VARCHAR AS json FROM fx_hits")
def results_json(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_hits").select("event_id", "video_id", "query")
    return rows.select("event_id", F.to_json(F.struct("event_id", "video_id", "query")).alias("json"))


# validation and facets ----------------------------------------------------------------------------------------


@_query(f"""{_PARSED} SELECT event_id, coalesce({_REASON}, '') = '' AS passed, {_REASON} AS reason FROM published""")
def validate_rows(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_hits").where(validate.has_key("video_id"))
    passed, reason = validate.verdict(text.parse_duration(F.col("duration_text")), text.parse_views(F.col("views_text")))
    return rows.select("event_id", passed.alias("passed"), reason.alias("reason"))


@_query(
    f"""{_PARSED}, r AS (SELECT event_id, CASE WHEN duration_seconds_estimated < 1200 THEN 'duration_too_low'
    WHEN published_at_estimated < {_DUCK_NOW} - INTERVAL 60 DAY THEN 'too_old' WHEN views_estimated < 1000 THEN 'views_too_low' END AS reason FROM published)
    SELECT event_id, reason IS NULL AS passed, reason FROM r"""
)
def validate_documented(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_hits")
    passed, reason = validate.verdict(
        text.parse_duration(F.col("duration_text")), text.parse_views(F.col("views_text")), text.parse_published(F.col("published_text"), _now()), _now(), min_duration=1200, max_age_days=60
    )
    return rows.select("event_id", passed.alias("passed"), reason.alias("reason"))


@_query("SELECT o, event_id FROM (VALUES ('last_hour', TIMESTAMP '2024-01-20 11:00:00'), ('today', TIMESTAMP '2024-01-20'), ('this_week', TIMESTAMP '2024-01-15'), ('this_month', TIMESTAMP '2024-01-01'), ('this_year', TIMESTAMP '2024-01-01')) f(o, since), events WHERE ts >= since")
def facet_upload_date(spark, sf_dir):
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    of = {o: validate.uploaded_within(F.col("ts").cast("timestamp"), o, now) for o in labels.options("upload_date")}
    return _t(spark, sf_dir, "events").select(F.explode(validate.matching(of)).alias("o"), "event_id")


@_query(f"""{_PARSED} SELECT o, event_id FROM published, (VALUES ('under_4', 0, 179), ('4_20', 180, 1200), ('over_20', 1201, 99999999)) f(o, a, b)
    WHERE duration_seconds_estimated BETWEEN a AND b""")
def facet_duration(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_hits").select("event_id", text.parse_duration(F.col("duration_text")).alias("s"))
    of = {o: validate.duration_within(F.col("s"), o) for o in labels.options("duration")}
    return rows.select(F.explode(validate.matching(of)).alias("o"), "event_id")


@_query("SELECT event_id FROM events WHERE event_type = 'view'")
def facet_unknown(spark, sf_dir):
    """Options that no facet knows leave the rows as they are; of several features the known ones count."""
    rows, now = _t(spark, sf_dir, "events"), F.lit("2024-01-20 12:00:00").cast("timestamp")
    rows = validate.facet(rows, validate.uploaded_within(F.col("ts").cast("timestamp"), "next_week", now))
    rows = validate.facet(rows, validate.duration_within(F.col("value"), "over_90"))
    rows = validate.facet(rows, validate.has_features(F.array("event_type"), ["16k"], labels.options("features")))
    return validate.facet(rows, validate.has_features(F.array("event_type"), ["view", "16k"], ["view", "hd"])).select("event_id")


@_query("SELECT p_partkey FROM part WHERE p_type = 'PROMO' AND p_size % 2 = 0")
def facet_features(spark, sf_dir):
    tags = F.array("p_type", F.when(F.col("p_size") % 2 == 0, F.lit("even")))
    return validate.facet(_t(spark, sf_dir, "part"), validate.has_features(tags, ["PROMO", "even"])).select("p_partkey")


@_query("SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 100")
def facet_sort(spark, sf_dir):
    rows = _t(spark, sf_dir, "part")
    return rows.orderBy(*validate.facet_order(rows, "view_count", {"view_count": "p_retailprice"}, "p_partkey", "p_partkey")).limit(100).select("p_partkey", "p_retailprice")


@_query("SELECT doc_id, CASE WHEN lang = 'en' THEN 'en' ELSE 'es' END AS code FROM documents")
def locale_code(spark, sf_dir):
    locale = F.when(F.col("lang") == "en", F.lit("en-US")).otherwise(F.col("lang"))
    return _t(spark, sf_dir, "documents").select("doc_id", values.locale_code(locale).alias("code"))


@_query("SELECT doc_id, CASE lang WHEN 'en' THEN 'View count' WHEN 'es' THEN 'Recuento de visualizaciones' END AS label FROM documents")
def facet_labels(spark, sf_dir):
    one = labels.label_table(spark).where("facet = 'sort_by' AND option = 'view_count'").select("lang", "label")
    return _t(spark, sf_dir, "documents").join(F.broadcast(one), "lang", "left").select("doc_id", "label")  # a row for each language


_OPTIONS = (
    "('upload_date', 'last_hour', 'Last hour', 'Última hora'), ('upload_date', 'today', 'Today', 'Hoy'), ('upload_date', 'this_week', 'This week', 'Esta semana'),"
    " ('upload_date', 'this_month', 'This month', 'Este mes'), ('upload_date', 'this_year', 'This year', 'Este año'), ('duration', 'under_4', 'Under 3 minutes', 'Menos de 3 minutos'),"
    " ('duration', '4_20', '3 - 20 minutes', 'De 3 a 20 minutos'), ('duration', 'over_20', 'Over 20 minutes', 'Más de 20 minutos'), ('features', 'live', 'Live', 'En directo'),"
    " ('features', '4k', '4K', '4K'), ('features', 'hd', 'HD', 'HD'), ('features', 'subtitles', 'Subtitles/CC', 'Subtítulos'), ('features', 'creative_commons', 'Creative Commons', 'Creative Commons'),"
    " ('features', '360', '360°', '360°'), ('features', 'vr180', 'VR180', 'VR180'), ('features', '3d', '3D', '3D'), ('features', 'hdr', 'HDR', 'HDR'), ('features', 'location', 'Location', 'Ubicación'),"
    " ('features', 'purchased', 'Purchased', 'Comprado'), ('sort_by', 'relevance', 'Relevance', 'Relevancia'), ('sort_by', 'upload_date', 'Upload date', 'Fecha de subida'),"
    " ('sort_by', 'view_count', 'View count', 'Recuento de visualizaciones'), ('sort_by', 'rating', 'Rating', 'Calificación')"
)


@_query(f"""SELECT doc_id, facet, option, CASE lang WHEN 'en' THEN en ELSE es END AS label, CASE lang WHEN 'en' THEN 'America/New_York' ELSE 'America/Mexico_City' END AS timezone
    FROM documents, (VALUES {_OPTIONS}) o(facet, option, en, es) WHERE lang IN ('en', 'es')""")
def label_catalogue(spark, sf_dir):
    """Every document with all labels of its language."""
    known = labels.label_table(spark).join(labels.locale_table(spark), "lang")
    return _t(spark, sf_dir, "documents").join(F.broadcast(known), "lang").select("doc_id", "facet", "option", "label", "timezone")  # 46 rows


# tables -------------------------------------------------------------------------------------------------------------


@_query(f"{duck('fx_hits')} SELECT video_id, event_id, query FROM fx_hits QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY event_id) = 1")
def dedupe_first_wins(spark, sf_dir):
    return merge.first_wins(view(spark, sf_dir, "fx_hits"), ["video_id"], "event_id").select("video_id", "event_id", "query")


def _split(spark, sf_dir):
    hits = view(spark, sf_dir, "fx_hits").select("video_id", "query", "event_id")
    return merge.first_wins(hits.where("event_id % 3 = 0"), ["video_id"], "event_id"), hits.where("event_id % 3 <> 0")


_OLD_NEW = """, o AS (SELECT video_id, query, event_id FROM fx_hits WHERE event_id % 3 = 0 QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY event_id) = 1),
 n AS (SELECT video_id, query, event_id FROM fx_hits WHERE event_id % 3 <> 0)"""


@_query(f"""{duck('fx_hits')}{_OLD_NEW} SELECT * FROM o UNION ALL SELECT * FROM n WHERE video_id NOT IN (SELECT video_id FROM o)
    QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY event_id) = 1""")
def insert_ignore(spark, sf_dir):
    return merge.insert_ignore(*_split(spark, sf_dir), ["video_id"], "event_id")


@_query(f"""{duck('fx_hits')}{_OLD_NEW} SELECT count(*) AS rows, count(DISTINCT video_id) AS inserted, count(*) - count(DISTINCT video_id) AS ignored,
    count(DISTINCT CASE WHEN video_id NOT IN (SELECT video_id FROM o) THEN video_id END) AS stored FROM n""")
def insert_stats(spark, sf_dir):
    return merge.insert_stats(*_split(spark, sf_dir), "video_id", "event_id")


_UPSERT = """WITH o AS (SELECT CAST(c_custkey AS VARCHAR) AS k, c_acctbal AS b, c_mktsegment AS s FROM customer WHERE c_custkey % 3 <> 0),
 n AS (SELECT CAST(c_custkey AS VARCHAR) AS k, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal + 1 END AS b, c_mktsegment || '!' AS s FROM customer WHERE c_custkey % 2 = 0)"""


def _customers(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 <> 0").selectExpr("string(c_custkey) k", "c_acctbal b", "c_mktsegment s")
    return old, c.where("c_custkey % 2 = 0").selectExpr("string(c_custkey) k", "CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal + 1 END b", "concat(c_mktsegment, '!') s")


@_query(f"{_UPSERT} SELECT coalesce(n.k, o.k) AS k, coalesce(n.b, o.b) AS b, coalesce(n.s, o.s) AS s FROM o FULL JOIN n ON o.k = n.k")
def upsert_coalesce(spark, sf_dir):
    return merge.upsert(*_customers(spark, sf_dir), ["k"])


@_query(f"{_UPSERT} SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NULL THEN o.b ELSE n.b END AS b, CASE WHEN n.k IS NULL THEN o.s ELSE n.s END AS s FROM o FULL JOIN n ON o.k = n.k")
def upsert_overwrite(spark, sf_dir):
    return merge.upsert(*_customers(spark, sf_dir), ["k"], mode="overwrite")


@_query(
    """WITH l AS (SELECT CAST(l_orderkey AS VARCHAR) AS o, CAST(l_linenumber AS VARCHAR) AS n, min(l_quantity) AS q, min(l_partkey) AS p FROM lineitem GROUP BY ALL)
    SELECT o, n, CASE WHEN p % 3 <> 0 OR (p % 2 = 0 AND p % 4 <> 0) THEN CASE WHEN p % 2 = 0 AND p % 4 <> 0 THEN q + 1 ELSE q END END AS q FROM l WHERE p % 3 <> 0 OR p % 2 = 0"""
)
def upsert_coalesce_composite(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("o"), F.col("l_linenumber").cast("string").alias("n")).agg(F.min("l_quantity").alias("q"), F.min("l_partkey").alias("p"))
    new = rows.where("p % 2 = 0").selectExpr("o", "n", "CASE WHEN p % 4 <> 0 THEN q + 1 END q")
    return merge.upsert(rows.where("p % 3 <> 0").select("o", "n", "q"), new, ["o", "n"])


@_query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def keyed_update(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return merge.keyed_update(rows, rows.where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus")), "o_orderkey", "o_orderstatus")


@_query("SELECT CAST(p_partkey AS VARCHAR) AS id, p_name, 'es' AS lang FROM part")
def legacy_append(spark, sf_dir):
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_name").withColumn("lang", F.lit("es"))
    return merge.insert_ignore(part.where("id % 2 = 0"), part, ["id"], "id")


@_query(f"{duck('fx_hits', 'fx_normalized')} SELECT event_id, video_id, query FROM fx_hits WHERE video_id NOT IN (SELECT video_id FROM fx_normalized)")
def unprocessed(spark, sf_dir):
    return relate.unprocessed(view(spark, sf_dir, "fx_hits"), view(spark, sf_dir, "fx_normalized"), "video_id", ["event_id", "video_id", "query"])


@_query(f"{duck('fx_hits', 'fx_normalized')} SELECT event_id, video_id FROM fx_hits WHERE video_id NOT IN (SELECT video_id FROM fx_normalized) ORDER BY discovered_at, event_id LIMIT 50")
def unprocessed_limit(spark, sf_dir):
    rows = relate.unprocessed(view(spark, sf_dir, "fx_hits"), view(spark, sf_dir, "fx_normalized"), "video_id", ["event_id", "video_id", "discovered_at"])
    return relate.oldest_first(rows, ["discovered_at", "event_id"], 50).select("event_id", "video_id")


_CLAIM = """ SELECT channel_url, min(normalized_at) AS m FROM fx_normalized WHERE validation_passed AND channel_url <> ''
  AND channel_url NOT IN (SELECT channel_url FROM fx_processed) AND channel_url NOT IN (SELECT channel_url FROM fx_claims) GROUP BY channel_url"""
_CLAIM_VIEWS = ("fx_normalized", "fx_processed", "fx_claims")


def _claims(spark, sf_dir, n):
    return relate.claim(*(view(spark, sf_dir, v) for v in _CLAIM_VIEWS), n)


@_query(f"{duck(*_CLAIM_VIEWS)} SELECT channel_url, epoch_us(m) AS first_us FROM ({_CLAIM} ORDER BY m, channel_url LIMIT 20)")
def claim_candidates(spark, sf_dir):
    return _claims(spark, sf_dir, 20).select("channel_url", F.unix_micros(F.col("first_normalized_at").cast("timestamp")).alias("first_us"))


@_query(f"{duck(*_CLAIM_VIEWS)}, c AS ({_CLAIM}) SELECT channel_url, CAST((row_number() OVER (ORDER BY m, channel_url) - 1) // 10 AS BIGINT) AS round FROM c")
def claim_rounds(spark, sf_dir):
    return order.worker_shares(order.with_index(_claims(spark, sf_dir, None), ["first_normalized_at", "channel_url"]), None, 10).select("channel_url", F.col("worker").alias("round"))


# work plans -------------------------------------------------------------------------------------------------------


@_query(f"{duck('fx_runs')} SELECT DISTINCT query FROM fx_runs WHERE query <> ''")
def executed_queries(spark, sf_dir):
    return relate.executed(view(spark, sf_dir, "fx_runs"))


def _seed(spark, sf_dir):
    return lists.seed_list(view(spark, sf_dir, "fx_seed"), "line", "pos")


_SEED = f"{duck('fx_seed', 'fx_runs')}, s AS (SELECT pos, trim(line) AS query FROM fx_seed WHERE trim(line) <> ''), x AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS idx FROM s), p AS (SELECT * FROM s WHERE query NOT IN (SELECT query FROM fx_runs WHERE query <> ''))"


@_query(f"{_SEED} SELECT pos, query FROM p")
def pending_queries(spark, sf_dir):
    return relate.pending(_seed(spark, sf_dir), view(spark, sf_dir, "fx_runs"))


@_query(f"{_SEED} SELECT pos, query FROM x WHERE idx >= 150 AND idx < 200 AND query NOT IN (SELECT query FROM fx_runs WHERE query <> '')")
def batch_slice(spark, sf_dir):
    cut = order.batch(order.with_index(_seed(spark, sf_dir), ["pos"]), 3, 50).select("pos", "query")
    return relate.pending(cut, view(spark, sf_dir, "fx_runs"))


@_query(f"{_SEED}, b AS (SELECT DISTINCT idx // 10 AS batch FROM x WHERE query IN (SELECT query FROM p)) SELECT coalesce(to_json(list(batch ORDER BY batch)) :: VARCHAR, '[]') AS batches, (SELECT CAST(ceil(count(*) / 10.0) AS BIGINT) FROM s) AS n FROM b")
def pending_batches(spark, sf_dir):
    """The numbers of open batches as a JSON list, an empty one if every query was run, and how many batches there are."""
    seed = order.with_index(_seed(spark, sf_dir), ["pos"])
    open_ = order.pending_batches(seed, relate.pending(_seed(spark, sf_dir), view(spark, sf_dir, "fx_runs")), 10)
    total = seed.agg(F.ceil(F.count("*") / 10).cast("bigint").alias("n"))
    return open_.agg(F.to_json(F.sort_array(F.collect_list("batch"))).alias("batches")).crossJoin(total)  # one row each


@_query(f"{_SEED}, i AS (SELECT *, row_number() OVER (ORDER BY pos) - 1 AS idx FROM p) SELECT pos, query, CAST(idx // 25 AS BIGINT) AS worker FROM i WHERE idx < 100")
def worker_plan(spark, sf_dir):
    waiting = relate.pending(_seed(spark, sf_dir), view(spark, sf_dir, "fx_runs"))
    return order.worker_shares(order.with_index(waiting, ["pos"]), 4, 25).select("pos", "query", "worker")


@_query(f"""{_SEED} SELECT (SELECT count(*) FROM s) AS loaded, count(*) AS pending, (SELECT count(*) FROM s) - count(*) AS filtered, (SELECT count(*) FROM s WHERE query IN (SELECT query FROM fx_runs)) AS skipped,
    100 AS target, least(100, count(*)) AS actual FROM p""")
def load_totals(spark, sf_dir):
    marked = relate.with_flag(_seed(spark, sf_dir), relate.executed(view(spark, sf_dir, "fx_runs")), "query")
    return relate.load_totals(marked, instances=4, size=25)


@_query(f"{duck('fx_channels', 'fx_processed')} SELECT channel_url, channel_url IN (SELECT channel_url FROM fx_processed) AS processed FROM fx_channels")
def already_processed(spark, sf_dir):
    return relate.with_flag(view(spark, sf_dir, "fx_channels"), view(spark, sf_dir, "fx_processed"), "channel_url")


@_query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0)")
def fk_violations(spark, sf_dir):
    return relate.fk_violations(_t(spark, sf_dir, "orders"), "o_custkey", _t(spark, sf_dir, "customer").where("c_custkey % 10 <> 0"), "c_custkey").select("o_orderkey", "o_custkey")


@_query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def key_violations(spark, sf_dir):
    return relate.key_violations(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query("SELECT DISTINCT source FROM documents WHERE lang = 'es' AND source IN (SELECT source FROM documents WHERE lang = 'en')")
def cross_language_keys(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    return relate.shared_keys(docs.where("lang = 'es'"), docs.where("lang = 'en'"), "source")


# dumps ---------------------------------------------------------------------------------------------------------------

_GOOD = "CAST(regexp_extract(channel_url, '[0-9]+$') AS BIGINT) % 10 NOT IN (1, 2, 3, 4, 5)"
_LEAVES = f"{duck('fx_dump_entries')}, f AS (SELECT *, row_number() OVER (PARTITION BY channel_url ORDER BY grp_ord, pos) - 1 AS ord FROM fx_dump_entries WHERE grp_ord <> 1 AND {_GOOD})"
_VIDEOS = f"{_LEAVES}, v AS (SELECT *, row_number() OVER (PARTITION BY channel_url ORDER BY grp_ord, pos) - 1 AS p FROM f WHERE id <> '')"
_DATE = "coalesce(nullif(upload_date, ''), strftime(to_timestamp(coalesce(nullif(epoch, 0), release_epoch)) AT TIME ZONE 'UTC', '%Y%m%d'))"


def _good(spark, sf_dir):
    return jobs.triage(dumps(spark, sf_dir)).where("status = 'success'")


@_query(f"{_LEAVES} SELECT channel_url, ord AS pos, id FROM f")
def flatten_entries(spark, sf_dir):
    flat = nested.flatten_entries(_good(spark, sf_dir).select("channel_url", "dump"), "dump")
    return flat.select("channel_url", F.posexplode("leaves").alias("pos", "e")).select("channel_url", F.col("pos").cast("bigint").alias("pos"), values.at(F.col("e"), "$.id", "string").alias("id"))


@_query(f"{_VIDEOS} SELECT channel_url, p AS pos, id AS video_id, {_DATE} AS upload_date, CAST(duration AS BIGINT) AS duration_seconds, view_count FROM v WHERE p < 3")
def channel_videos(spark, sf_dir):
    out = nested.channel_videos(nested.flatten_entries(_good(spark, sf_dir).select("channel_url", "dump"), "dump"), "channel_url", 3)
    return out.withColumn("pos", F.col("pos").cast("bigint"))


_KEYS = f"{duck('fx_dump_entries')}, c AS (SELECT DISTINCT channel_url, CAST(regexp_extract(channel_url, '[0-9]+$') AS BIGINT) AS k FROM fx_dump_entries)"


@_query(f"""{_KEYS} SELECT channel_url, CASE WHEN k % 3 = 0 THEN 'u' ELSE 'c' END || k AS channel_id, CASE WHEN k % 3 = 0 THEN 'n' ELSE 'm' END || k AS channel_name,
    k AS subscriber_count, CASE WHEN k % 3 <> 0 THEN true END AS is_verified FROM c WHERE {_GOOD}""")
def channel_meta(spark, sf_dir):
    return nested.channel_meta(_good(spark, sf_dir), "channel_url", "dump")


@_query(f"{duck('fx_dump_entries')} SELECT channel_url, pos, {_DATE} AS upload_date FROM fx_dump_entries")
def upload_date(spark, sf_dir):
    return view(spark, sf_dir, "fx_dump_entries").select("channel_url", "pos", values.upload_date(F.col("upload_date"), F.col("epoch"), F.col("release_epoch")).alias("upload_date"))


@_query(f"{duck('fx_channels')} SELECT channel_url || '/videos' AS url FROM fx_channels")
def listing_url(spark, sf_dir):
    return view(spark, sf_dir, "fx_channels").select(urls.listing_url(F.col("channel_url")).alias("url"))


@_query(f"{_SEED} SELECT pos, 'https://s.example/results?search_query=' || replace(url_encode(query), '%2F', '/') AS url FROM s")
def search_url(spark, sf_dir):
    return _seed(spark, sf_dir).select("pos", urls.search_url("https://s.example/results?search_query=", F.col("query")).alias("url"))


_FAILED = "CASE k % 10 WHEN 1 THEN 'HTTP Error 404' WHEN 2 THEN 'HTTP Error 429' WHEN 3 THEN 'empty output' WHEN 4 THEN 'not valid JSON' WHEN 5 THEN 'root was not an object' END"


@_query(f"{_KEYS} SELECT channel_url, CASE WHEN k % 10 = 1 THEN 'dump failed: HTTP Error 404' WHEN k % 10 = 2 THEN 'dump failed: HTTP Error 429' ELSE 'dump failed' END AS message FROM c WHERE k % 10 IN (1, 2, 3)")
def error_text(spark, sf_dir):
    return dumps(spark, sf_dir).where("k % 10 IN (1, 2, 3)").select("channel_url", values.error_text("dump failed", F.col("stderr"), F.col("stdout")).alias("message"))


@_query(f"{_KEYS} SELECT channel_url, {_FAILED} AS reason, CASE WHEN {_FAILED} IS NULL THEN 'success' ELSE 'failed' END AS status, k % 10 = 1 AS permanent FROM c")
def failure_triage(spark, sf_dir):
    return jobs.triage(dumps(spark, sf_dir)).select("channel_url", "reason", "status", "permanent")


_DONE = "k % 7 = 0"


def _enriched(spark, sf_dir):
    d = dumps(spark, sf_dir)
    return jobs.enrich(d, d.where("k % 7 = 0").select("channel_url"), _now(), 3)


@_query(f"{_KEYS} SELECT CASE WHEN {_DONE} THEN 'skipped' WHEN {_FAILED} IS NULL THEN 'success' ELSE 'failed' END AS status, count(*) AS count FROM c GROUP BY 1")
def job_totals(spark, sf_dir):
    return _enriched(spark, sf_dir)["totals"]


@_query(f"{_VIDEOS} SELECT channel_url, id AS video_id, min(p) AS pos FROM v WHERE p < 3 AND CAST(regexp_extract(channel_url, '[0-9]+$') AS BIGINT) % 7 <> 0 GROUP BY ALL")
def enrich_channels(spark, sf_dir):
    rows = merge.first_wins(_enriched(spark, sf_dir)["videos"], ["channel_url", "video_id"], "pos")
    return rows.select("channel_url", "video_id", F.col("pos").cast("bigint").alias("pos"))


# whole jobs -----------------------------------------------------------------------------------------------------------

_TODO = f"{_PARSED}, done AS (SELECT DISTINCT video_id FROM fx_hits WHERE event_id % 2 = 0), todo AS (SELECT * FROM published WHERE video_id NOT IN (SELECT video_id FROM done))"


def _normalized(spark, sf_dir):
    hits = view(spark, sf_dir, "fx_hits")
    return jobs.normalize_job(hits, hits.where("event_id % 2 = 0").select("video_id").distinct(), _now(), "event_id")


@_query(f"""{_TODO} SELECT video_id, {_norm('channel_url')} AS channel_url, {_norm('query')} AS query, views_estimated, epoch_us(published_at_estimated) AS published_us,
    duration_seconds_estimated, {_REASON} IS NULL AS validation_passed, {_REASON} AS validation_reason FROM todo QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY event_id) = 1""")
def normalize_job(spark, sf_dir):
    rows, _ = _normalized(spark, sf_dir)
    return rows.select("video_id", "channel_url", "query", "views_estimated", F.unix_micros("published_at_estimated").alias("published_us"), "duration_seconds_estimated", "validation_passed", "validation_reason")


@_query(f"{_TODO} SELECT count(*) AS fetched, count(*) AS prepared, count(DISTINCT video_id) AS inserted, count(*) - count(DISTINCT video_id) AS ignored FROM todo")
def normalize_stats(spark, sf_dir):
    """What was counted while the rows were written."""
    rows, seen_ = _normalized(spark, sf_dir)
    written(rows, "normalized")
    return spark.createDataFrame([tuple(seen_.get[c] for c in ("fetched", "prepared", "inserted", "ignored"))], "fetched bigint, prepared bigint, inserted bigint, ignored bigint")


@_query(f"""{duck('fx_hits')} SELECT video_id, search_run_id, 'https://www.youtube.com/watch?v=' || video_id AS video_url, nullif(channel_url, '') AS channel_url, coalesce(event_id % 4 = 0, false) AS is_multi_creator
    FROM fx_hits QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY event_id) = 1""")
def ingest_hits(spark, sf_dir):
    none = F.lit(None).cast("string")
    hits = view(spark, sf_dir, "fx_hits").select("*", none.alias("video_url"), none.alias("thumbnail_url"), urls.video_type(F.col("duration_text")).alias("video_type"), (F.col("event_id") % 4 == 0).alias("is_multi_creator"))
    old = spark.createDataFrame([], state.TABLES["videos_raw"])
    return jobs.ingest_hits(old, hits, "event_id").select("video_id", "search_run_id", "video_url", "channel_url", "is_multi_creator")


_LONG = f"{duck('fx_dump_entries')}, v AS (SELECT channel_url, CAST(duration AS BIGINT) AS d, view_count AS n FROM fx_dump_entries WHERE duration >= 20)," \
    " a AS (SELECT channel_url, count(*) AS n_videos, avg(n) AS avg_views, quantile_cont(n, 0.5) AS median_views, avg(CASE WHEN n >= 1000 THEN 1.0 ELSE 0.0 END) AS share_seen FROM v GROUP BY channel_url)"
_SCORE = "round(0.5 * log10(median_views + 1) + 0.3 * log10(avg_views + 1) + 0.2 * share_seen + 0.01 * n_videos, 6)"


def _analysis(spark, sf_dir):
    rows = view(spark, sf_dir, "fx_dump_entries").select("channel_url", F.col("duration").cast("bigint").alias("duration_seconds"), "view_count")
    return jobs.analyse_channels(rows)


@_query(f"{_LONG} SELECT channel_url, n_videos, round(avg_views, 3) AS avg_views, median_views, round(share_seen, 6) AS share_seen, n_videos >= 2 AND median_views >= 20000 AS qualifies FROM a")
def channel_analysis(spark, sf_dir):
    return _analysis(spark, sf_dir).select("channel_url", "n_videos", F.round("avg_views", 3).alias("avg_views"), "median_views", F.round("share_seen", 6).alias("share_seen"), "qualifies")


@_query(f"{_LONG} SELECT channel_url, {_SCORE} AS score FROM a")
def channel_score(spark, sf_dir):
    return jobs.score_channels(_analysis(spark, sf_dir))


@_query(f"{_LONG} SELECT channel_url, {_SCORE} AS score, n_videos, median_views FROM a WHERE n_videos >= 2 AND median_views >= 20000 ORDER BY {_SCORE} DESC, channel_url LIMIT 50")
def channel_ranking(spark, sf_dir):
    return jobs.rank_channels(_analysis(spark, sf_dir), 50)


# snapshots and streams ---------------------------------------------------------------------------------------------------


def _scratch(spark) -> str:
    return new_path(spark, "state")


def _arrive(rows: DataFrame, batch, many: int, path: str) -> None:
    """Rows by ``batch``, 0 to ``many`` - 1, as files that come one after another."""
    for k in range(many):
        rows.where(batch == k).coalesce(1).write.mode("append").parquet(path)


@_query(f"{duck(*_CLAIM_VIEWS)} SELECT channel_url, epoch_us(claimed_at) AS claimed_us FROM fx_claims UNION ALL SELECT channel_url, epoch_us({_DUCK_NOW}) FROM ({_CLAIM})")
def claim_job(spark, sf_dir):
    """The stored claims after a run over all candidates."""
    tables = state.Tables(spark, _scratch(spark), "es")
    normal, processed, claims = (view(spark, sf_dir, v) for v in _CLAIM_VIEWS)
    tables.write("videos_normalized", normal.select("channel_url", "validation_passed", F.col("normalized_at").cast("timestamp")))
    tables.write("channels_processed", processed.select("channel_url"))
    tables.write("channels_discovery_claims", claims.select("channel_url", F.col("claimed_at").cast("timestamp")))
    jobs.claim_job(tables, _now(), None)
    return tables.read("channels_discovery_claims").select("channel_url", F.unix_micros("claimed_at").alias("claimed_us"))


@_query(f"{duck('fx_hits')} SELECT DISTINCT video_id FROM fx_hits")
def read_table(spark, sf_dir):
    """Two snapshots of a table, of which the second is read."""
    root = _scratch(spark)
    tables = state.Tables(spark, root, "es")
    hits = view(spark, sf_dir, "fx_hits").select("video_id", "event_id")
    tables.write("videos", hits.where("event_id % 3 = 0").select("video_id").distinct())
    tables.write("videos", merge.insert_ignore(lists.table(spark, root, "videos", "es"), hits, ["video_id"], "event_id"))
    return lists.table(spark, root, "videos", "es")


@_query(f"""{_PARSED} SELECT video_id, views_estimated, duration_seconds_estimated, {_REASON} IS NULL AS validation_passed FROM published
    QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY event_id) = 1""")
def stream_normalize(spark, sf_dir):
    """Hits that arrive in three batches, in their order."""
    root = _scratch(spark)
    raw = view(spark, sf_dir, "fx_hits").select("event_id", *jobs.RAW_COLUMNS)
    last = raw.agg(F.max("event_id")).first()[0] or 0
    _arrive(raw, F.floor(F.col("event_id") * 3 / (last + 1)), 3, f"{root}/arriving")
    tables = state.Tables(spark, f"{root}/tables", "es")
    arriving = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/arriving")
    streams.normalize_stream(arriving, tables, f"{root}/checkpoint", _now(), "event_id")
    return tables.read("videos_normalized").select("video_id", "views_estimated", "duration_seconds_estimated", "validation_passed")


@_query(f"{_KEYS} SELECT channel_url, CASE WHEN k % 10 = 1 THEN 'failed' ELSE 'success' END AS status FROM c WHERE k % 10 NOT IN (2, 3, 4, 5)")
def stream_enrich(spark, sf_dir):
    root = _scratch(spark)
    arriving = dumps(spark, sf_dir)
    arriving.write.parquet(f"{root}/arriving")
    tables = state.Tables(spark, f"{root}/tables", "es")
    streams.enrich_stream(spark.readStream.schema(arriving.schema).parquet(f"{root}/arriving"), tables, f"{root}/checkpoint", _now(), 3)
    return tables.read("channels_processed").select("channel_url", "status")


@_query("SELECT event_id, event_type AS query, user_id % 2 = 0 AS is_multi_creator FROM events")
def read_hits(spark, sf_dir):
    """Hits as JSON lines with nested channels, read with an explicit schema."""
    path = f"{_scratch(spark)}/hits"
    state.results_json(_t(spark, sf_dir, "events").selectExpr("event_id", "event_type query", "user_id % 2 = 0 is_multi_creator", "array(named_struct('name', 'n', 'url', event_type)) channels"), path)
    schema = "event_id bigint, query string, is_multi_creator boolean, channels array<struct<name: string, url: string>>"
    return spark.read.schema(schema).json(path).select("event_id", F.col("channels")[0]["url"].alias("query"), "is_multi_creator")


@_query("""SELECT name, CASE name WHEN 'search_runs' THEN 1 ELSE 0 END AS version, CASE name WHEN 'search_runs' THEN (SELECT count(*) FROM part) ELSE 0 END AS rows FROM (VALUES
    ('channel_videos_raw'), ('channels_discovery_claims'), ('channels_processed'), ('channels_raw'), ('search_runs'), ('videos_normalized'), ('videos_raw')) t(name)""")
def create_tables(spark, sf_dir):
    """All tables made twice, a run for each part stored in between: the second time changes nothing."""
    tables = state.Tables(spark, _scratch(spark), "en")
    tables.create()
    runs = merge.append_runs(_t(spark, sf_dir, "part").select(F.col("p_name").alias("query")), _now())
    tables.write("search_runs", tables.read("search_runs").unionByName(runs))
    tables.create()
    out = None
    for name in sorted(state.TABLES):
        one = tables.read(name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), F.lit(tables.version(name)).alias("version"), "rows")
        out = one if out is None else out.union(one)
    return out


@_query(f"""{duck('fx_hits')}, o AS (SELECT DISTINCT video_id FROM fx_hits WHERE event_id % 3 = 0)
    SELECT DISTINCT video_id, video_id NOT IN (SELECT video_id FROM o) AS of_run, 2 AS runs, true AS closed FROM fx_hits""")
def ingest_job(spark, sf_dir):
    """Two searches into one table: whose hits each video is, and how many runs were opened and closed."""
    tables = state.Tables(spark, _scratch(spark), "es")
    none = F.lit(None).cast("string")
    hits = view(spark, sf_dir, "fx_hits").drop("search_run_id").select(
        "*", none.alias("video_url"), none.alias("thumbnail_url"), urls.video_type(F.col("duration_text")).alias("video_type"), F.lit(None).cast("boolean").alias("is_multi_creator")
    )
    jobs.ingest_run(tables, hits.where("event_id % 3 = 0"), "first", _now(), "event_id")
    second = jobs.ingest_run(tables, hits, "second", _now(), "event_id").select("id", F.lit(True).alias("of_run"))
    runs = tables.read("search_runs").agg(F.count("*").cast("int").alias("runs"), F.bool_and(F.col("finished_at").isNotNull()).alias("closed"))
    rows = tables.read("videos_raw").join(F.broadcast(second), F.col("search_run_id") == F.col("id"), "left")  # one row
    return rows.select("video_id", F.coalesce("of_run", F.lit(False)).alias("of_run")).join(F.broadcast(runs), F.lit(True))  # one row


@_query(f"{_SEED} SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY pos) - 1 AS place, query FROM (SELECT *, CASE pos % 2 WHEN 0 THEN 'en' ELSE 'es' END AS lang FROM s)")
def source_by_language(spark, sf_dir):
    """Seed lists as text files, one for each language; each language's own is found and read in file order."""
    root, out = _scratch(spark), None
    for rest, lang in enumerate(("en", "es")):
        own = view(spark, sf_dir, "fx_seed").where(F.col("pos") % 2 == rest)
        own.orderBy("pos").select("line").write.text(f"{root}/{lang}")
    for lang in ("en", "es"):
        read = lists.read_seed_file(spark, lists.source_for(lang, {x: f"{root}/{x}" for x in ("en", "es")}))
        one = order.with_index(read, ["pos"], "place").select(F.lit(lang).alias("lang"), "place", "query")
        out = one if out is None else out.union(one)
    return out


@_query(f"{_SEED} SELECT pos, query, CAST((row_number() OVER (ORDER BY pos) - 1) // 25 AS BIGINT) AS worker FROM s QUALIFY worker < 4")
def reprocess_plan(spark, sf_dir):
    """The worker plan without a look at the history."""
    return order.worker_shares(order.with_index(relate.pending(_seed(spark, sf_dir), None), ["pos"]), 4, 25).select("pos", "query", "worker")


@_query(f"{duck('fx_hits')} SELECT event_id, video_id, row_number() OVER (PARTITION BY video_id ORDER BY event_id) - 1 AS ordinal FROM fx_hits")
def duplicate_ordinal(spark, sf_dir):
    return order.ordinal(view(spark, sf_dir, "fx_hits").select("event_id", "video_id"), ["video_id"], ["event_id"])


@_query(f"{_SEED} SELECT pos, query FROM s")
def history_fallback(spark, sf_dir):
    """A history that was never written is empty, so every query is pending."""
    return relate.pending(_seed(spark, sf_dir), state.Tables(spark, _scratch(spark), "es").read("search_runs"))


@_query("SELECT p_partkey AS pos, p_name AS query, 'exploration' AS mode, true AS has_id, true AS is_open FROM part")
def append_runs(spark, sf_dir):
    runs = merge.append_runs(_t(spark, sf_dir, "part").select(F.col("p_name").alias("query"), "p_partkey"), _now())
    part = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("pos"), F.col("p_name").alias("query"))
    each = runs.groupBy("query").agg(F.first("mode").alias("mode"), F.min(F.length("id") == 36).alias("has_id"), F.min(F.col("finished_at").isNull()).alias("is_open"))
    return part.join(each, "query").select("pos", "query", "mode", "has_id", "is_open")


# rows that come again, and long histories -----------------------------------------------------------------------------


@_query("SELECT event_id FROM events WHERE NOT (ts < TIMESTAMP '2024-01-05' AND event_id % 7 = 3)")
def stream_dedupe(spark, sf_dir):
    """Events of four spans of eight days, each sent again in the next batch; some of the first days come for the first time in the last batch, too late."""
    root = _scratch(spark)
    e = _t(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    span = F.floor(F.datediff(F.col("ts"), F.lit("2024-01-01").cast("date")) / 8).cast("int")
    late = (F.col("ts") < F.lit("2024-01-05").cast("timestamp")) & (F.col("event_id") % 7 == 3)
    sent = F.when(late, F.array(F.lit(3))).otherwise(F.array(span, F.least(span + 1, F.lit(3))))
    rows = e.select("event_id", "ts", F.explode(sent).alias("batch"))
    _arrive(rows, F.col("batch"), 4, f"{root}/arriving")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/arriving")
    streams.dedupe_stream(arriving.select("event_id", "ts"), ["event_id"], "ts", "10 days", f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema("event_id bigint, ts timestamp").parquet(f"{root}/out").select("event_id")


@_query(f"{duck('fx_hits')} SELECT 3 AS runs, true AS closed, count(*) AS sent, count(DISTINCT video_id) AS stored, count(DISTINCT video_id) AS videos FROM fx_hits")
def ingest_replayed(spark, sf_dir):
    """Three batches of hits, two of them twice: runs, rows and totals are those of three."""
    tables = state.Tables(spark, _scratch(spark), "es")
    none = F.lit(None).cast("string")
    hits = view(spark, sf_dir, "fx_hits").drop("search_run_id").select(
        "*", none.alias("video_url"), none.alias("thumbnail_url"), urls.video_type(F.col("duration_text")).alias("video_type"), F.lit(None).cast("boolean").alias("is_multi_creator")
    )
    for k in (0, 1, 1, 2, 0):
        jobs.ingest_run(tables, hits.where(F.col("event_id") % 3 == k), f"batch {k}", _now(), "event_id", "hits", k)
    totals = tables.applied("videos_raw", "hits")
    runs = tables.read("search_runs").agg(F.count("*").cast("int").alias("runs"), F.bool_and(F.col("finished_at").isNotNull()).alias("closed"))
    counted = tables.read("videos_raw").agg(F.count("*").alias("videos"))
    return runs.crossJoin(counted).select("runs", "closed", F.lit(totals["sent"]).cast("bigint").alias("sent"), F.lit(totals["stored"]).cast("bigint").alias("stored"), "videos")  # one row each


_ARRIVALS = """, a AS (SELECT channel_url, k, CASE WHEN k % 10 = 1 THEN 'failed' ELSE 'success' END AS status, k % 10 IN (2, 3, 4, 5) AS second FROM c)"""


def _repeated(spark, sf_dir):
    """Each channel's dump, then a good one with one video, then a failure for good."""
    d = dumps(spark, sf_dir).drop("k")
    good = d.select("channel_url", F.lit(0).alias("returncode"), F.lit('{"entries": [{"id": "second"}]}').alias("stdout"), F.lit("").alias("stderr"))
    gone = d.select("channel_url", F.lit(1).alias("returncode"), F.lit("").alias("stdout"), F.lit("HTTP Error 404").alias("stderr"))
    rows = [x.select("channel_url", "returncode", "stdout", "stderr", F.lit(k).alias("arrival_no")) for k, x in enumerate((d, good, gone))]
    return rows[2].unionByName(rows[0]).unionByName(rows[1])


@_query(f"""{_VIDEOS}, c AS (SELECT DISTINCT channel_url, CAST(regexp_extract(channel_url, '[0-9]+$') AS BIGINT) AS k FROM fx_dump_entries){_ARRIVALS},
    own AS (SELECT channel_url, count(DISTINCT id) AS n FROM v WHERE p < 3 GROUP BY channel_url)
    SELECT channel_url, status, CASE WHEN status = 'failed' THEN 0 WHEN second THEN 1 ELSE coalesce(n, 0) END AS videos FROM a LEFT JOIN own USING (channel_url)""")
def stream_repeated(spark, sf_dir):
    """Channels that come three times in a batch: the first dump that succeeds or fails for good counts, and its videos alone."""
    root = _scratch(spark)
    arriving = _repeated(spark, sf_dir)
    arriving.write.parquet(f"{root}/arriving")
    tables = state.Tables(spark, f"{root}/tables", "es")
    streams.enrich_stream(spark.readStream.schema(arriving.schema).parquet(f"{root}/arriving"), tables, f"{root}/checkpoint", _now(), 3, "arrival_no")
    videos = tables.read("channel_videos_raw").groupBy("channel_url").agg(F.count("*").alias("videos"))
    return tables.read("channels_processed").join(videos, "channel_url", "left").select("channel_url", "status", F.coalesce("videos", F.lit(0)).alias("videos"))


@_query(f"""{_KEYS}{_ARRIVALS} SELECT status, sum(n) :: BIGINT AS count FROM (SELECT status, 1 AS n FROM a UNION ALL SELECT 'failed', 1 FROM a WHERE second
    UNION ALL SELECT 'skipped', CASE WHEN second THEN 1 ELSE 2 END FROM a) GROUP BY status""")
def repeated_totals(spark, sf_dir):
    none = state.empty(spark, "channel_url string")
    return jobs.enrich(_repeated(spark, sf_dir), none, _now(), 3, "arrival_no")["totals"]


_CLAIM_LOG = "SELECT channel_url, claimed_at FROM fx_claims UNION ALL SELECT channel_url, claimed_at + INTERVAL 12 DAY FROM fx_claims WHERE CAST(regexp_extract(channel_url, '[0-9]+$') AS BIGINT) % 12 = 5"


@_query(f"""{duck(*_CLAIM_VIEWS)}, l AS ({_CLAIM_LOG}), live AS (SELECT channel_url FROM l WHERE claimed_at > TIMESTAMP '{NOW}' - INTERVAL 10 DAY),
    n AS (SELECT DISTINCT channel_url FROM fx_normalized WHERE validation_passed AND channel_url <> '' AND channel_url NOT IN (SELECT channel_url FROM fx_processed) AND channel_url NOT IN (SELECT channel_url FROM live))
    SELECT channel_url, epoch_us(claimed_at) AS claimed_us FROM l UNION ALL SELECT channel_url, epoch_us({_DUCK_NOW}) FROM n""")
def claim_expired(spark, sf_dir):
    """The claim log after a run for which claims of ten days or older do not count."""
    tables = state.Tables(spark, _scratch(spark), "es")
    normal, processed, claims = (view(spark, sf_dir, v) for v in _CLAIM_VIEWS)
    again = claims.where(F.regexp_extract("channel_url", "[0-9]+$", 0).cast("bigint") % 12 == 5).withColumn("claimed_at", F.col("claimed_at") + F.expr("INTERVAL 12 DAYS"))
    tables.write("videos_normalized", normal.select("channel_url", "validation_passed", F.col("normalized_at").cast("timestamp")))
    tables.write("channels_processed", processed.select("channel_url"))
    tables.write("channels_discovery_claims", claims.unionByName(again).select("channel_url", F.col("claimed_at").cast("timestamp")))
    jobs.claim_job(tables, _now(), None, ttl=10 * 86400)
    return tables.read("channels_discovery_claims").select("channel_url", F.unix_micros("claimed_at").alias("claimed_us"))


@_query(f"{_LONG} SELECT channel_url, {_SCORE} AS score, rank() OVER (ORDER BY {_SCORE} DESC) AS rank FROM a")
def channel_rank(spark, sf_dir):
    return jobs.rank_all(_analysis(spark, sf_dir))


@_query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, rank() OVER (ORDER BY l_quantity DESC) AS rank FROM lineitem")
def rank_with_ties(spark, sf_dir):
    """Few different scores, each of many rows."""
    rows = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return order.with_rank(rows, "l_quantity", ["l_orderkey", "l_linenumber", "l_partkey"])


@_query("""SELECT CAST(l_suppkey % 10 AS VARCHAR) AS channel_url, count(*) AS n_videos, avg(floor(l_extendedprice)) AS avg_views, true AS close FROM lineitem WHERE l_quantity >= 20 GROUP BY 1""")
def sketched_medians(spark, sf_dir):
    """Three batches, one of them twice, into stored sketches; ``close``: the median's rank is within the stated error of the middle."""
    tables = state.Tables(spark, _scratch(spark), "es")
    videos = _t(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 10).cast("string").alias("channel_url"), F.col("l_quantity").cast("bigint").alias("duration_seconds"), F.floor("l_extendedprice").cast("bigint").alias("view_count"), "l_partkey"
    )
    for k in (0, 1, 1, 2):
        jobs.add_videos(tables, videos.where(F.col("l_partkey") % 3 == k), "videos", k)
    analysis = jobs.analyse_sketches(tables.read("channel_sketches"))
    middle = analysis.select("channel_url", "median_views")
    ranks = videos.where("duration_seconds >= 20").join(F.broadcast(middle), "channel_url").groupBy("channel_url").agg(  # ten rows
        F.avg((F.col("view_count") < F.col("median_views")).cast("double")).alias("below"), F.avg((F.col("view_count") <= F.col("median_views")).cast("double")).alias("upto")
    )
    close = (F.col("below") <= 0.5 + 0.0267) & (F.col("upto") >= 0.5 - 0.0267)
    return analysis.join(ranks, "channel_url").select("channel_url", "n_videos", "avg_views", close.alias("close"))


@_query(f"{_LEAVES} SELECT channel_url, ord AS pos, id FROM f")
def flatten_rows(spark, sf_dir):
    """The leaf entries of each dump as rows from the first, numbered by document order."""
    leaves = nested.flatten_rows(_good(spark, sf_dir).select("channel_url", "dump"), ["channel_url"], "dump")
    named = leaves.select("channel_url", "path", values.at(F.col("entry"), "$.id", "string").alias("id"))
    return order.ordinal(named, ["channel_url"], ["path"], "pos").select("channel_url", "pos", "id")


@_query(f"{_VIDEOS} SELECT channel_url, p AS pos, id AS video_id, {_DATE} AS upload_date, CAST(duration AS BIGINT) AS duration_seconds, view_count FROM v WHERE p < 3")
def video_rows(spark, sf_dir):
    leaves = nested.flatten_rows(_good(spark, sf_dir).select("channel_url", "dump"), ["channel_url"], "dump")
    return nested.video_rows(leaves, ["channel_url"], 3).withColumn("pos", F.col("pos").cast("bigint"))


@_query(f"""{_KEYS} SELECT channel_url, {_FAILED} AS reason, k % 10 = 1 AS permanent, CASE WHEN {_FAILED} IS NULL THEN CASE WHEN k % 3 = 0 THEN 'u' ELSE 'c' END || k END AS channel_id,
    CASE WHEN {_FAILED} IS NULL THEN k END AS subscriber_count FROM c""")
def stored_dumps(spark, sf_dir):
    """Dumps stored parsed: what went wrong, and two fields, read without parsing again."""
    path = f"{_scratch(spark)}/dumps"
    lists.store_parsed(dumps(spark, sf_dir), path)
    judged = jobs.triage(lists.parsed(spark, path))
    meta = nested.meta_of(F.col("dump"))
    return judged.select("channel_url", "reason", "permanent", meta["channel_id"].alias("channel_id"), meta["subscriber_count"].alias("subscriber_count"))


@_query(f"{duck('fx_hits', 'fx_normalized')} SELECT event_id, video_id, query FROM fx_hits WHERE video_id NOT IN (SELECT video_id FROM fx_normalized)")
def unprocessed_filtered(spark, sf_dir):
    """Rows that a history lacks, by a stored filter of its keys first; the filter grew in two steps."""
    tables = state.Tables(spark, _scratch(spark), "es")
    done = view(spark, sf_dir, "fx_normalized").select("video_id")
    blocks = seen.blocks_for(done.count())
    for k in range(2):
        seen.add_done(tables, done.where(F.pmod(F.xxhash64("video_id"), F.lit(2)) == k), "video_id", blocks, "done", k)
    return seen.unprocessed(view(spark, sf_dir, "fx_hits").select("event_id", "video_id", "query"), done, tables.read("seen_blocks"), blocks, "video_id")


@_query("SELECT p_partkey, greatest(1, p_size - 25) AS most FROM part")
def video_minimum(spark, sf_dir):
    """How many videos to ask for: one at least."""
    return _t(spark, sf_dir, "part").select("p_partkey", urls.at_least_one(F.col("p_size") - 25).alias("most"))
