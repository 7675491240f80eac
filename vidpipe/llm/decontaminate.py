"""Benchmark decontamination: a hash set of the benchmark's n-grams, scanned by every document's windows.

Native throughout.  A benchmark item's windows are ``n`` consecutive words (all its words if it has fewer).  The
hashes of the windows' first words form a set, a bitmap of SPARE bits a member, that every task holds; the few
positions of a document whose next words are in it have their whole window hashed, joined to the benchmark's and
compared word by word.  The bitmap has MOST_BITS at most: with a benchmark of more words it lets more positions
through to the same join, and nothing else changes.  The benchmark's windows are a written table, so Spark knows
their size when it chooses how to join them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bit_set, bit_words, written

#: Bits of the set for each member, and at most (8 MB).
SPARE, MOST_BITS = 16, 1 << 26
#: Words of a window that the set looks at.
LEAD = 3

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normal_words(text: Column) -> Column:
    """A-Z lower-cased, then runs of ASCII letters, digits and everything beyond ASCII; none for null."""
    split = F.split(F.translate(text, _UPPER, _UPPER.lower()), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1)
    return F.coalesce(F.array_remove(split, ""), F.array().cast("array<string>"))


def _lead(hashes: Column, at: Column, lead: int) -> Column:
    return F.xxhash64(*(F.get(hashes, at + k) for k in range(lead)))


def item_windows(benchmark: DataFrame, n: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(hash, window, len, items)``: each distinct window of the benchmark and the items that have it."""
    words = benchmark.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string").alias("item"), normal_words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (n - 1)))
    each = words.where(F.size("w") > 0).select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i, n))).alias("w"))
    return (
        each.groupBy("w").agg(F.collect_set("item").alias("items"))
        .select(F.xxhash64("w").alias("hash"), F.array_join("w", " ").alias("window"), F.size("w").alias("len"), "items", "w")
    )


def _spots(documents: DataFrame, benchmark: DataFrame, n: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, spots, items)``: for each row where windows occur, ``(pos, len)``, and the items that have them."""
    windows = written(item_windows(benchmark, n), "windows")
    count, least = windows.agg(F.count("*"), F.min("len")).first()
    lead = min(LEAD, least or 1)
    lens = [r[0] for r in windows.select("len").distinct().collect()]  # at most n
    docs = documents.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), normal_words(F.col(text_col)).alias("w"))
    docs = docs.select("row", "doc_id", "w", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))

    def window_at(i: Column) -> Column:
        return F.array(*(F.struct(i.alias("pos"), F.xxhash64(F.slice("w", i + 1, k)).alias("hash"), F.array_join(F.slice("w", i + 1, k), " ").alias("window")) for k in lens))

    if not count:
        found = docs.select("row", "doc_id", F.size("w").alias("n_words"), F.lit(None).cast("array<struct<pos:int,hash:bigint,window:string>>").alias("at"))
    else:
        bits = min(MOST_BITS, 1 << (max(1024, SPARE * count) - 1).bit_length())
        place = lambda lead_hash: lead_hash.bitwiseAND(F.lit(bits - 1).cast("bigint"))
        # the hash of a word's hash sequence, as documents have it
        leads = windows.select(place(_lead(F.transform("w", lambda x: F.xxhash64(x)), F.lit(0), lead)).alias("at"))
        held = bit_words(leads, bits)
        marked = F.transform("h", lambda x, i: F.when(bit_set(held, place(_lead(F.col("h"), i, lead))), i))
        at = F.flatten(F.transform(F.filter(marked, lambda i: i.isNotNull()), window_at))
        found = docs.select("row", "doc_id", F.size("w").alias("n_words"), at.alias("at"))
    rows = found.select("row", "doc_id", "n_words", F.inline_outer("at"))
    known = windows.select("hash", "window", "len", "items")
    joined = rows.join(known, ["hash", "window"], "left")
    spot = F.when(F.col("len").isNotNull(), F.struct("pos", "len"))
    return joined.groupBy("row", "doc_id", "n_words").agg(F.collect_set(spot).alias("spots"), F.collect_set("items").alias("items")).drop("row")


def find_hits(documents: DataFrame, benchmark: DataFrame, n: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items, contaminated)``, one row per input row.

    ``n_hit`` counts words inside any occurrence of a window, ``items`` lists the benchmark items with occurring
    windows as strings in order.  Null, empty and wordless texts have no words; items without words or id have
    no windows; an empty benchmark hits nothing.  Whole texts of any length are scanned.  Repeated rows each
    give a row; other columns do not matter.
    """
    out = _spots(documents, benchmark, n, id_col, text_col)

    def cover(state: Column, s: Column) -> Column:
        end = s["pos"] + s["len"]
        return F.struct(
            F.greatest(state["end"], end).alias("end"),
            (state["total"] + F.greatest(F.lit(0), end - F.greatest(state["end"], s["pos"])).cast("bigint")).alias("total"),
        )

    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total"))
    items = F.array_sort(F.array_distinct(F.flatten("items")))
    hit = F.aggregate(F.array_sort("spots"), start, cover, lambda s: s["total"])
    return out.select(
        "doc_id", F.col("n_words").cast("bigint").alias("n_words"), hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        items.alias("items"), (hit > 0).alias("contaminated"),
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The rows of ``documents(doc_id, ...)`` with all their columns that hit no window.

    A row with null id stays.  Rows that repeat an id go together.  An empty benchmark leaves all rows; no rows
    give no rows.  The ids that go are a written table, so Spark broadcasts them if they are few by its measure.
    """
    bad = find_hits(documents, benchmark, n).where("contaminated AND doc_id IS NOT NULL").select("doc_id").distinct()
    return documents.join(written(bad, "contaminated"), "doc_id", "left_anti").select(*documents.columns)


def cut_spans(documents: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """``documents(doc_id, text, ...)`` with all their columns, each run of hit words and the other characters up to the next word gone from ``text``.

    Texts without hits stay as they are, null ones too; no row goes, and rows that repeat an id go by their own
    texts, however long.  No rows give no rows; an empty benchmark changes nothing.
    """
    names = documents.columns
    docs = documents.select(F.monotonically_increasing_id().alias("_at"), *(F.col(c).alias(f"c{i}") for i, c in enumerate(names)))
    docs = written(docs, "given")  # so that rows keep their numbers
    text = F.col(f"c{names.index('text')}")
    spots = _spots(docs.select(F.col("_at").alias("doc_id"), text.alias("text")), benchmark, n).select(F.col("doc_id").alias("_at"), "spots").where(F.size("spots") > 0)
    # each word with what follows it; what stands before the first word is kept
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # A-Z are not lower-cased here
    other = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
    parts = F.regexp_extract_all(text, F.lit(f"(?s)({word}{other})"), F.lit(1))
    hit = lambda i: F.exists("spots", lambda s: (s["pos"] <= i) & (i < s["pos"] + s["len"]))
    kept = F.concat(F.regexp_extract(text, f"(?s)^({other})", 1), F.array_join(F.filter(parts, lambda p, i: ~hit(i)), ""))
    joined = docs.join(spots, "_at", "left").withColumn("_cut", F.when(F.col("spots").isNotNull(), kept).otherwise(text))
    return joined.select(*(F.col("_cut").alias(c) if c == "text" else F.col(f"c{i}").alias(c) for i, c in enumerate(names)))
