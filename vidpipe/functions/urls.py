"""Urls and the fields of a search hit that default to them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes of default urls.
WATCH = "https://www.youtube.com/watch?v="
THUMBNAIL = ("https://i.ytimg.com/vi/", "/hqdefault.jpg")


def video_url(url: Column, video_id: Column) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(WATCH), video_id))


def thumbnail_url(url: Column, video_id: Column) -> Column:
    return F.coalesce(F.nullif(url, F.lit("")), F.concat(F.lit(THUMBNAIL[0]), video_id, F.lit(THUMBNAIL[1])))


def channel_url(url: Column, channels: Column) -> Column:
    """The url, or else that of the first of an array of channels."""
    return F.coalesce(F.nullif(url, F.lit("")), F.try_element_at(channels, F.lit(1))["url"])


def video_type(duration: Column) -> Column:
    """``video`` for a duration with a colon; everything else, a missing one too, is a ``short``."""
    return F.when(F.contains(duration, F.lit(":")), F.lit("video")).otherwise(F.lit("short"))


def multi_creator(channels: Column) -> Column:
    return F.coalesce(F.size(channels) > 1, F.lit(False))


def query_parameter(url: Column, name: str) -> Column:
    """A url's query parameter, decoded; null for bad urls and missing parameters."""
    return F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)))


def absolute(origin: str, href: Column) -> Column:
    return F.concat(F.lit(origin), href)


def search_url(prefix: str, query: Column) -> Column:
    """A search url with the query percent-encoded: space as %20, slash as it is."""
    coded = F.url_encode(query)
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        coded = F.replace(coded, F.lit(a), F.lit(b))
    return F.concat(F.lit(prefix), coded)


def listing_url(channel: Column, suffix: str = "/videos") -> Column:
    return F.concat(channel, F.lit(suffix))


def at_least_one(n: Column) -> Column:
    """How many videos to ask for: one at least."""
    return F.greatest(F.lit(1), n)
