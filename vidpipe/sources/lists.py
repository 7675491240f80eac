"""Seed lists, hits and dumps as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import is_object, unless_empty
from ..operators.order import with_index
from ..scratch import shredding
from .state import Tables


def seed_list(lines: DataFrame, line: str, order_col: str) -> DataFrame:
    """``(pos, query)``: trimmed lines, blank ones dropped, order and duplicates kept."""
    return lines.select(F.col(order_col).alias("pos"), F.trim(line).alias("query")).where("query <> ''")


def read_seed_file(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, query)`` of a text file, or of the files of a folder by name; ``pos`` is the line's place, from 0."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    # ids rise within a split, splits are told apart by where they begin
    return seed_list(with_index(lines.withColumn("i", F.monotonically_increasing_id()), ["f", "b", "i"], "pos"), "value", "pos")


def source_for(lang: str, sources: dict[str, str], path: str | None = None) -> str:
    """The given path, or that of the language; a language without one is an error."""
    if path:
        return path
    if lang not in sources:
        raise FileNotFoundError(f"no query list for {lang!r}")
    return sources[lang]


def table(spark: SparkSession, root: str, name: str, lang: str) -> DataFrame:
    """The current snapshot of a persisted table of one language; only its own files are listed and read."""
    return Tables(spark, root, lang).read(name)


def with_dump(dumps: DataFrame, stdout: Column, name: str) -> DataFrame:
    """``dumps`` with a struct: the ``dump`` as variant, and its ``error``: empty output, invalid JSON, or a root that is no object.

    The struct comes out of a generator, which no filter on it and no column made of it passes; so a text is parsed once.
    """
    empty = F.coalesce(F.trim(stdout), F.lit("")) == ""

    def judged(value: Column) -> Column:
        error = F.when(empty, F.lit("empty output")).when(value.isNull(), F.lit("not valid JSON")).when(~is_object(value), F.lit("root was not an object"))
        return F.struct(F.when(error.isNull(), value).alias("dump"), error.alias("error"))

    return dumps.select("*", F.explode(F.transform(F.array(F.try_parse_json(F.trim(stdout))), judged)).alias(name))


def store_parsed(dumps: DataFrame, path: str) -> None:
    """Dumps parsed once and for all: ``(*columns but stdout, dump, error)`` as Parquet, those fields of a dump itself that are common written as columns of their own.

    Later jobs read only the fields they ask for, and parse nothing.  The list of entries is one such field, with
    all that is in it as one value.  A run that failed has a message and no dump.
    """
    said = F.coalesce(unless_empty(F.trim("stderr")), F.when(F.col("returncode") != 0, unless_empty(F.trim("stdout"))))  # a failure may speak in either
    rest = [c for c in dumps.columns if c not in ("stdout", "stderr")]
    dump = F.when(F.col("returncode") == 0, F.col("_parsed.dump"))  # decided here: a reader that had to ask would need the whole dump for its answer
    rows = with_dump(dumps, F.col("stdout"), "_parsed").select(*rest, said.alias("stderr"), dump.alias("dump"), "_parsed.error")
    with shredding(dumps.sparkSession, 1):
        rows.write.mode("overwrite").parquet(path)


def parsed(spark: SparkSession, path: str) -> DataFrame:
    """What ``store_parsed`` wrote."""
    return spark.read.parquet(path)
