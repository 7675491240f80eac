"""Tolerant readers of JSON values and other loosely typed columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it stands there; generated code stays small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kind(value: Column) -> Column:
    """The type of a variant: OBJECT<...>, ARRAY<...>, STRING, BIGINT, DOUBLE, DECIMAL(...), BOOLEAN, VOID."""
    return F.schema_of_variant(value)


def at(value: Column, path: str, as_type: str = "variant") -> Column:
    return F.try_variant_get(value, path, as_type)


def is_object(value: Column) -> Column:
    """Whether a variant is an object; none of its fields is looked at, as naming its whole type would do."""
    return F.try_variant_get(value, "$", "struct<>").isNotNull()


def coerce_int(value: Column) -> Column:
    """An integer of a variant: numbers truncated, digit strings read, all else (booleans too) null."""

    def read(v: Column) -> Column:
        number = kind(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
        text = F.when(kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
        whole = F.try_variant_get(v, "$", "double").try_cast("bigint")
        exact = F.when(kind(v) == "BIGINT", F.try_variant_get(v, "$", "bigint")).otherwise(whole)
        return F.when(number, exact).otherwise(F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint")))

    return let(value, read)


def unless_empty(value: Column) -> Column:
    """A text that has a character.  ``nullif`` would become a step of its own in the plan, and a variant's fields are read by themselves only if none lies between."""
    return F.when(value != "", value)


def strict_bool(value: Column) -> Column:
    """A boolean only of a boolean variant."""
    return F.when(kind(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def full_string(value: Column) -> Column:
    """The text of a variant that is a string with at least one character."""
    return unless_empty(F.when(kind(value) == "STRING", F.try_variant_get(value, "$", "string")))


def ensure_timestamp(value: Column) -> Column:
    """An instant of ISO text with a full date, zoneless text being UTC; all else is null."""
    return F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$"), F.try_to_timestamp(value))


def upload_date(given: Column, epoch: Column, release: Column) -> Column:
    """``YYYYMMDD``: the given text, or else the UTC day of one of two epoch seconds, of which 0 counts as missing."""
    seconds = F.coalesce(F.nullif(epoch, F.lit(0)), release)
    within = seconds.between(-62_135_596_800, 253_402_300_799)
    return F.coalesce(F.nullif(given, F.lit("")), F.date_format(F.timestamp_seconds(F.when(within, seconds)), "yyyyMMdd"))


def or_false(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def locale_code(locale: Column) -> Column:
    """``en`` for en-US, ``es`` for everything else."""
    return F.when(locale == "en-US", F.lit("en")).otherwise(F.lit("es"))


def error_text(prefix: str, stderr: Column, stdout: Column, most: int = 5000) -> Column:
    """The first of two outputs that says something, trimmed and cut, after a prefix."""
    said = F.coalesce(F.nullif(F.trim(stderr), F.lit("")), F.nullif(F.trim(stdout), F.lit("")), F.lit(""))
    return F.concat_ws(": ", F.lit(prefix), F.nullif(F.substring(said, 1, most), F.lit("")))
