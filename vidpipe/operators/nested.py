"""Nested entries of channel dumps, anchors of pages, and arrays of channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.urls import at_least_one
from ..functions.values import at, coerce_int, full_string, is_object, let, strict_bool, upload_date
from ..scratch import shredding, written

# Words in a list's title that exclude it.
SKIPPED_TITLES = ("shorts", "live")


def _listed(entry: Column) -> Column:
    """The elements of an entry's ``entries``, null unless that is an array; asked for at once, as each variant taken out of another is written anew."""
    return F.try_variant_get(entry, "$.entries", "array<variant>")


def _array(entry: Column) -> Column:
    """The elements of an entry's ``entries``, none unless that is an array."""
    return F.coalesce(_listed(entry), F.array().cast("array<variant>"))


def _is_skipped(entry: Column) -> Column:
    """Whether a list's title excludes it; a missing one does not."""
    title = F.lower(F.coalesce(full_string(at(entry, "$.title")), F.lit("")))
    return F.contains(title, F.lit(SKIPPED_TITLES[0])) | F.contains(title, F.lit(SKIPPED_TITLES[1]))


def _open(entry: Column) -> Column:
    """What stands for an entry one level further down: itself unless it is a list, the elements of a list not skipped, or nothing."""
    none = F.array().cast("array<variant>")
    return F.when(at(entry, "$.entries").isNull(), F.array(entry)).when(_is_skipped(entry), none).otherwise(_array(entry))


#: JSON itself nests no deeper than this here: the parser refuses more than 1,000 arrays and objects in each other.
_STEPS, _ROUNDS = 8, 3


def flatten_entries(dumps: DataFrame, dump: str, depth: int | None = None) -> DataFrame:
    """``dumps`` with ``leaves``, the array of leaf entries in document order, and ``deeper``, how many lists lie below ``depth``.

    Lists are opened level by level until none is left, as deep as JSON can nest, or ``depth`` levels.  A null
    title counts as empty.  No shuffle.
    """
    more = lambda e: at(e, "$.entries").isNotNull()
    leaf = lambda e: ~more(e) & is_object(e)
    top = _array(F.col(dump))
    if depth is not None:
        out = dumps.withColumn("leaves", top)
        for _ in range(depth):
            out = out.withColumn("leaves", F.flatten(F.transform("leaves", _open)))
        return out.withColumn("deeper", F.size(F.filter("leaves", more))).withColumn("leaves", F.filter("leaves", leaf))

    def state(entries: Column) -> Column:
        return let(entries, lambda s: F.struct(s.alias("entries"), F.exists(s, more).alias("more")))

    # up to _STEPS ** _ROUNDS levels; whether a list is left is asked once for each level there is, the other steps only look at the answer
    def open_all(begun: Column, rounds: int) -> Column:
        inner = (lambda s: state(F.flatten(F.transform(s["entries"], _open)))) if rounds == 0 else (lambda s: open_all(s, rounds - 1))
        return F.aggregate(F.sequence(F.lit(1), F.lit(_STEPS)), begun, lambda s, _: F.when(s["more"], inner(s)).otherwise(s))

    out = dumps.withColumn("leaves", open_all(state(top), _ROUNDS - 1)["entries"])
    return out.withColumn("deeper", F.size(F.filter("leaves", more))).withColumn("leaves", F.filter("leaves", leaf))


def _video(e: Column) -> dict[str, Column]:
    return {
        "video_id": full_string(at(e, "$.id")),
        "upload_date": upload_date(full_string(at(e, "$.upload_date")), coerce_int(at(e, "$.timestamp")), coerce_int(at(e, "$.release_timestamp"))),
        "duration_seconds": coerce_int(at(e, "$.duration")),
        "view_count": coerce_int(at(e, "$.view_count")),
    }


#: Levels that are opened before rows are written: a channel's own lists, and what they hold.
_AT_ONCE = 2


def _one_level(level: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, path, entry)`` with the elements of a list in its place; leaves stay, all else goes."""
    entry, sub = F.col("entry"), F.col("_sub")
    leaf = at(entry, "$.entries").isNull() & is_object(entry)
    shown = F.when(sub.isNotNull(), F.when(~_is_skipped(entry), sub)).when(leaf, F.array(entry))
    rows = level.withColumn("_sub", _listed(entry)).select(*keys, "path", sub.isNotNull().alias("_list"), shown.alias("_shown"))
    rows = rows.select(*keys, "path", "_list", F.posexplode("_shown").alias("_at", "entry"))
    return rows.select(*keys, F.when(F.col("_list"), F.concat("path", F.array("_at"))).otherwise(F.col("path")).alias("path"), "entry")


def flatten_rows(dumps: DataFrame, keys: list[str], dump: str) -> DataFrame:
    """``(*keys, path, entry)``: a row for each leaf entry of each dump; ``path`` has its place on every level, so leaves sorted by it are in document order.

    Lists are opened level by level as rows, which are written after every second level, until no list is left: a
    channel with millions of entries is split like any other rows, and no array of its leaves is ever made.  What
    neither is a leaf nor can be opened is not written, and entries are written whole.
    """
    entry = F.col("entry")
    more = at(entry, "$.entries").isNotNull()
    level = dumps.select(*keys, F.posexplode(_listed(F.col(dump))).alias("_at", "entry")).select(*keys, F.array("_at").alias("path"), "entry")
    leaves, opened = None, 1
    while True:
        for _ in range(opened, _AT_ONCE):
            level = _one_level(level, keys)
        kept = level.where(F.when(more, ~_is_skipped(entry)).otherwise(is_object(entry))).withColumn("_more", more)
        with shredding(dumps.sparkSession, 0):
            level = written(kept, "entries")
        own = level.where("NOT _more").drop("_more")
        leaves = own if leaves is None else leaves.unionByName(own)
        lists = level.where("_more")
        if lists.isEmpty():
            return leaves
        level, opened = lists.drop("_more"), 0


def video_rows(leaves: DataFrame, keys: list[str], most: int = 40) -> DataFrame:
    """``(*keys, pos, video_id, upload_date, duration_seconds, view_count)`` of the first ``most`` (one at least) rows of ``leaves`` by path that have an id."""
    named = leaves.withColumn("_id", full_string(at(F.col("entry"), "$.id"))).where("_id IS NOT NULL")
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("path"))
    kept = named.withColumn("pos", first - 1).where(F.col("pos") < at_least_one(F.lit(most)))
    return kept.select(*keys, "pos", *(c.alias(n) for n, c in _video(F.col("entry")).items()))


def videos_of(leaves: Column, most: int = 40) -> Column:
    """``(pos, video_id, upload_date, duration_seconds, view_count)`` of the first ``most`` leaves (one at least) that have an id, as an array."""
    valid = F.slice(F.filter(leaves, lambda e: full_string(at(e, "$.id")).isNotNull()), F.lit(1), at_least_one(F.lit(most)))
    return F.transform(
        valid,
        lambda e, i: F.struct(
            i.alias("pos"), *(c.alias(n) for n, c in _video(e).items()),
        ),
    )


def channel_videos(flat: DataFrame, key: str, most: int = 40) -> DataFrame:
    """A row for each of the ``videos_of`` the leaves of ``flat``."""
    return flat.select(key, F.inline(videos_of(F.col("leaves"), most)))


def meta_of(dump: Column) -> dict[str, Column]:
    """Id, name, subscribers and verified flag of a dump, each with its fallback field."""
    v = lambda name: at(dump, f"$.{name}")
    return {
        "channel_id": F.coalesce(full_string(v("channel_id")), full_string(v("uploader_id"))),
        "channel_name": F.coalesce(full_string(v("channel")), full_string(v("uploader"))),
        "subscriber_count": F.coalesce(coerce_int(v("subscriber_count")), coerce_int(v("channel_follower_count"))),
        "is_verified": strict_bool(v("verified")),
    }


def channel_meta(dumps: DataFrame, key: str, dump: str) -> DataFrame:
    """The ``meta_of`` each dump."""
    return dumps.select(key, *(c.alias(n) for n, c in meta_of(F.col(dump)).items()))


def dedupe_anchors(anchors: Column) -> Column:
    """An array of (href, text) with each href at its first place and with its last text.

    Sorted by href and place, the first and the last of each href stand at the ends of a run: no anchor is
    compared with all others.
    """
    placed = F.array_sort(F.transform(anchors, lambda a, i: F.struct(a["href"].alias("href"), i.alias("i"), a["text"].alias("text"))))

    def pick(s: Column) -> Column:
        edge = lambda step: F.filter(s, lambda x, i: ~x["href"].eqNullSafe(F.get(s, i + step)["href"]) | F.get(s, i + step).isNull())
        runs = F.zip_with(edge(-1), edge(1), lambda a, z: F.struct(a["i"].alias("i"), a["href"].alias("href"), z["text"].alias("text")))
        return F.transform(F.array_sort(runs), lambda x: F.struct(x["href"].alias("href"), x["text"].alias("text")))

    return let(placed, pick)


_ANCHOR = r'<a[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


def anchors(html: Column) -> Column:
    """The (href, text) of all plain anchors of a page, in order."""
    found = F.regexp_extract_all(html, F.lit(_ANCHOR), F.lit(0))
    return F.transform(found, lambda a: F.struct(F.regexp_extract(a, _ANCHOR, 1).alias("href"), F.nullif(F.trim(F.regexp_extract(a, _ANCHOR, 2)), F.lit("")).alias("text")))


# The element around a name link, the id of a thumbnail link, and how the other links begin.
NAME_ELEMENT, THUMBNAIL_ID, LINK_STARTS = "ytd-channel-name", "channel-thumbnail", ("/@", "/channel/", "/c/")


def channel_links(html: Column) -> Column:
    """``(shape, href, text)`` of the anchors of a page that have one of the five shapes of a channel link, in order.

    ``name`` stands in a name element, ``thumbnail`` has that id; the others are called by how their href begins.
    Of several shapes the first of these counts.
    """
    pattern = rf"(?:<{NAME_ELEMENT}[^>]*>\s*)?{_ANCHOR}"

    def one(a: Column) -> Column:
        href = F.regexp_extract(a, pattern, 1)
        shape = F.when(F.startswith(a, F.lit(f"<{NAME_ELEMENT}")), F.lit("name")).when(a.rlike(rf'^<a[^>]*\sid="{THUMBNAIL_ID}"'), F.lit("thumbnail"))
        for start in LINK_STARTS:
            shape = shape.when(F.startswith(href, F.lit(start)), F.lit(start))
        return F.struct(shape.alias("shape"), href.alias("href"), F.nullif(F.trim(F.regexp_extract(a, pattern, 2)), F.lit("")).alias("text"))

    return F.filter(F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), one), lambda x: x["shape"].isNotNull())
