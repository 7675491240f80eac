"""Row rules and facet filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_key(*keys: str) -> Column:
    """All keys are present and not empty."""
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() & (F.col(k) != "") for k in keys))


def verdict(
    duration: Column, views: Column, published: Column | None = None, now: Column | None = None,
    min_duration: int = 180, min_views: int = 1000, max_age_days: int | None = None,
) -> tuple[Column, Column]:
    """Passed and reason: the first rule broken, unknown values passing.  Age counts only with ``max_age_days``."""
    rules = F.when(duration < min_duration, F.lit("duration_too_low"))
    if max_age_days is not None:
        rules = rules.when(published < now - F.make_dt_interval(F.lit(max_age_days)), F.lit("too_old"))
    reason = rules.when(views < min_views, F.lit("views_too_low"))
    return reason.isNull(), reason


def candidates(rows: DataFrame, passed: str = "validation_passed", key: str = "channel_url") -> DataFrame:
    return rows.where(F.col(passed) & has_key(key))


def uploaded_within(published: Column, option: str, now: Column) -> Column | None:
    """The facet's predicate, or None for an option it does not know."""
    if option == "last_hour":
        return published >= now - F.make_dt_interval(hours=F.lit(1))
    units = {"today": "day", "this_week": "week", "this_month": "month", "this_year": "year"}
    return published >= F.date_trunc(units[option], now) if option in units else None


def duration_within(seconds: Column, option: str, short: int = 180, long: int = 1200) -> Column | None:
    known = {"under_4": seconds < short, "4_20": seconds.between(short, long), "over_20": seconds > long}
    return known.get(option)


def has_features(features: Column, wanted: list[str], known: list[str] | None = None) -> Column | None:
    """All of ``wanted`` that are ``known`` (any, if that is None) are among the features; None if none is."""
    asked = [w for w in wanted if known is None or w in known]
    return F.size(F.array_except(F.array(*map(F.lit, asked)), features)) == 0 if asked else None


def matching(options: dict[str, Column | None]) -> Column:
    """The names of the options whose predicates hold, as an array: many facets of a row at once."""
    return F.array_compact(F.array(*(F.when(p, F.lit(o)) for o, p in options.items() if p is not None)))


def facet(rows: DataFrame, predicate: Column | None) -> DataFrame:
    """Filtered, or unchanged where the facet gave no predicate."""
    return rows if predicate is None else rows.where(predicate)


def facet_order(rows: DataFrame, option: str, columns: dict[str, str], position: str, key: str) -> list[Column]:
    """Sort columns of a facet: a column descending with nulls last, or input order; ties by key."""
    first = F.col(columns[option]).desc_nulls_last() if option in columns else F.col(position).asc()
    return [first, F.col(key)]
