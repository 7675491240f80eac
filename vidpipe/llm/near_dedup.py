"""Near-duplicate documents: MinHash signatures, an inverted join over signature coordinates, exact confirmation.

1. One pass over the texts gives each document its number of shingles, a 128-bit digest of its shingle set
   and a MinHash signature.  Documents with equal sets become one class, whose smallest id stands for it.
2. Classes are posted under each (coordinate, value) pair, a row each.  A pair of classes that shares fewer values
   than the match threshold cannot reach the similarity (chance below ``MISS``), so a class with too few shared
   values is skipped, and of the others only a prefix of their rarest values is merged: two classes that match
   often enough must meet there.
3. In each posting list classes meet the list's smallest one, its centre, not each other; collisions with each
   centre are counted, and the pair with the most is confirmed on full shingle sets.  So a list with a third of
   all rows costs its length, and a large group of near copies grows together.
4. Then classes of different components meet in the lists of the prefix.  Collisions there are counted; the long
   lists beyond the prefix are not merged but looked up, signature against signature, and pairs that match as
   often as the threshold asks are confirmed on full sets.
5. Lists of more than ``LONG`` classes are skipped in step 4, as all pairs of such a list would be too many: texts
   half of which is one common passage match in many coordinates and are still far from similar.  Their classes
   take an exact way instead: shingles are ordered by frequency, and two sets as similar as asked share one of
   their first ``n - need + 1``, so early in both that what follows suffices, and earliest in the smaller one.

Rows of every step are as many as its postings; counts and centres are combined before each shuffle, and joins
are on keys that adaptive execution splits where one is hot.  Shingles are compared by 64-bit hashes, within a pair
of documents at a time.  Signatures, sets of candidates and links are written to the shared folder between the
steps; nothing about single documents reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, mix, runs_of, slices, words, written
from .components import components, roots

#: The chance, for one pair at the threshold, that its signatures match too rarely to be looked at.
MISS = 1e-9
#: Classes of the longest posting list in which all of other components meet.
LONG = 64


def match_threshold(coordinates: int, percent: int) -> int:
    """The largest number of matches that a pair at ``percent`` similarity reaches with chance 1 - MISS at least."""
    p, total = percent / 100, 0.0
    for k in range(coordinates + 1):
        total += math.comb(coordinates, k) * p**k * (1 - p) ** (coordinates - k)
        if total > MISS:
            return max(1, k)
    return coordinates


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes; fewer words than ``width`` are one shingle, none give none."""
    hashes, first = words(column, lower=True)
    runs = runs_of(hashes, width)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(runs[a : b - width + 1]))
        elif b > a:
            out.append(mix(runs_of(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _coefficients(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        seeds = mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:coordinates] | np.uint64(1), seeds[coordinates:]


def _signatures(docs: DataFrame, width: int, coordinates: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _coefficients(coordinates)
        for batch in batches:
            for part in slices(batch, "text"):
                n, one, two, sig = [], [], [], []
                for s in shingle_sets(part["text"], width):
                    n.append(len(s))
                    one.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                    two.append(int(np.bitwise_xor.reduce(mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)), initial=np.uint64(0)).astype(np.int64)))
                    least = np.full(coordinates, ~np.uint64(0))
                    for at in range(0, len(s), 4096):
                        least = np.minimum(least, (s[at : at + 4096, None] * a + b).min(axis=0))
                    sig.append((least >> np.uint64(32)).astype(np.uint32).view(np.int32))
                flat = np.concatenate(sig) if sig else np.zeros(0, np.int32)
                offsets = np.arange(len(n) + 1, dtype=np.int32) * coordinates
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(n, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                    names=["doc_id", "n_shingles", "set1", "set2", "sig"],
                )
        give_back()

    return docs.mapInArrow(run, "doc_id bigint, n_shingles bigint, set1 bigint, set2 bigint, sig array<int>")


def _prefixes(reps: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """``(rep, prefix)``: each class that can match any other often enough, and of its shared values all but the ``matches`` - 1 most frequent.

    ``prefix`` is an array of ``(df, key, centre)``: how many classes share the value, the value with its
    coordinate, and the smallest class that has it.
    """
    key = F.col("value").cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.shiftleft(F.col("at").cast("bigint"), 32))
    postings = reps.select("rep", F.posexplode("sig").alias("at", "value")).select("rep", key.alias("key"))
    shared = postings.groupBy("key").agg(F.count("*").alias("df"), F.min("rep").alias("centre")).where("df > 1")
    lists = postings.join(shared, "key").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("df", "key", "centre"))).alias("own"))
    return lists.where(F.size("own") >= matches).select("rep", F.slice("own", F.lit(1), F.size("own") - (matches - 1)).alias("prefix"))


def _centres(live: DataFrame) -> DataFrame:
    """``(a, b)``: each class and the centre it meets most often in its prefix, if it meets any but itself."""
    met = live.select(F.col("rep").alias("a"), F.explode("prefix.centre").alias("b")).where("a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))
    return met.groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b"))


def _sets(docs: DataFrame, live: DataFrame, width: int) -> DataFrame:
    """(rep, n, shingles): the full shingle sets of the classes in ``live(rep)``, packed.

    ``live`` is a written table of ids alone: Spark broadcasts it if it is small by its measure, and else joins by shuffle.
    """
    chosen = docs.where("doc_id IS NOT NULL").join(live.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part["text"], width)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["rep", "n", "shingles"],
                )
        give_back()

    return chosen.mapInArrow(run, "rep bigint, n bigint, shingles binary").dropDuplicates(["rep"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked, with some more columns of bigints."""
    left = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch["sa"], batch["sb"], strict=True)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
                keep[i] = common and 100 * common >= percent * (len(x) + len(y) - common)
            yield batch.select(["a", "b", *carry]).filter(pa.array(keep))

    return both.select("a", "b", *carry, "sa", "sb").mapInArrow(run, ", ".join(f"{c} bigint" for c in ("a", "b", *carry)))


def _apart(rows: DataFrame, key: str, needed: Column | None = None) -> DataFrame:
    """``rows(key, root, ...)`` of keys that several components have, with ``minor``: not of the component that has most of the key's rows.

    With a condition ``needed``, keys of which no row meets it go as well.
    """
    sizes = rows.groupBy(key, "root").agg(F.count("*").alias("n"), F.max(F.lit(True) if needed is None else needed).alias("needed"))
    of_key = sizes.groupBy(key).agg(F.count("*").alias("parts"), F.max_by("root", F.struct("n", "root")).alias("major"), F.max("needed").alias("needed"))
    several = of_key.where("parts > 1 AND needed")
    return rows.join(several.select(key, "major"), key).withColumn("minor", F.col("root") != F.col("major")).drop("major")


def _colliding(apart: DataFrame, sigs: DataFrame, matches: int) -> DataFrame:
    """``(a, b, root_a, root_b)`` of ``apart(key, rep, root, minor)``: pairs of different components that match in ``matches`` coordinates or more."""
    x, y = (apart.select("key", *(F.col(c).alias(f"{c}_{side}") for c in ("rep", "root", "minor"))) for side in "ab")
    met = x.where("minor_a").join(y, "key").where("root_a <> root_b AND (rep_a > rep_b OR NOT minor_b)")
    pairs = met.select(F.greatest("rep_a", "rep_b").alias("a"), F.least("rep_a", "rep_b").alias("b"), *(
        F.when(F.col("rep_a") > F.col("rep_b"), F.col(f"root_{s}")).otherwise(F.col(f"root_{t}")).alias(f"root_{s}") for s, t in ("ab", "ba")
    )).groupBy("a", "b").agg(F.count("*").alias("met"), F.first("root_a").alias("root_a"), F.first("root_b").alias("root_b"))
    left, right = sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb"))
    count = F.size(F.filter(F.zip_with("sa", "sb", lambda p, q: p == q), lambda same: same))
    return pairs.join(left, "a").join(right, "b").where(count >= matches).select("a", "b", "root_a", "root_b")


def _overlapping(sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, root_a, root_b)`` of ``sets(rep, root, shingles)``: pairs of different components whose prefixes of rare shingles meet early enough.

    A set's prefix is its first ``n - need + 1`` shingles by rising frequency.  ``rest`` counts the set's shingles
    from one on in that order: an overlap that begins there has no more.  Of a pair the smaller set has to begin
    earlier still, so a shingle is looked up from the few rows that could be a smaller set's, and one that only
    larger sets could meet in falls away: texts that share a passage of less than that length make no pairs.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "shingles", 1 << 21):
                own = [np.frombuffer(x.as_buffer(), np.int64) for x in part["shingles"]]
                sizes = np.array([len(x) for x in own])
                reps, roots_ = (np.repeat(part[c].to_numpy(zero_copy_only=False), sizes) for c in ("rep", "root"))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own)), pa.array(reps), pa.array(roots_), pa.array(np.repeat(sizes, sizes))], names=["shingle", "rep", "root", "n"])
        give_back()

    rows = sets.select("rep", "root", "shingles").mapInArrow(unpack, "shingle bigint, rep bigint, root bigint, n bigint")
    known = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    own = rows.join(known, "shingle").groupBy("rep", "root", "n").agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("own"))
    size = F.size("own")
    first = F.slice("own", F.lit(1), F.greatest(F.lit(0), size + 1 - F.ceil(F.col("n") * percent / 100).cast("int")))
    prefix = own.select("rep", "root", "n", size.alias("size"), F.posexplode(first).alias("at", "one")).select("rep", "root", "n", (F.col("size") - F.col("at")).alias("rest"), "one.shingle")
    # an overlap that is enough for two sets of this size
    early = (100 + percent) * F.col("rest") >= 2 * percent * F.col("n")
    apart = written(_apart(prefix, "shingle", early).withColumn("early", early), "prefixes")
    less, more = (apart.select("shingle", *(F.col(c).alias(f"{c}_{side}") for c in ("rep", "root", "n", "rest", "minor", "early"))) for side in "ab")
    less = less.where("early_a")
    enough = f"{100 + percent} * least(rest_a, rest_b) >= {percent} * (n_a + n_b)"
    meets = f"root_a <> root_b AND (n_a < n_b OR n_a = n_b AND rep_a < rep_b) AND {enough}"
    met = less.where("minor_a").join(more, "shingle").where(meets).unionByName(less.where("NOT minor_a").join(more.where("minor_b"), "shingle").where(meets))
    swap = F.col("rep_a") < F.col("rep_b")
    return met.select(
        F.greatest("rep_a", "rep_b").alias("a"), F.least("rep_a", "rep_b").alias("b"),
        F.when(swap, F.col("root_b")).otherwise(F.col("root_a")).alias("root_a"), F.when(swap, F.col("root_a")).otherwise(F.col("root_b")).alias("root_b"),
    ).distinct()


def near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, coordinates: int = 64
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Words are runs without white space, A-Z lower-cased; a text of fewer than ``width`` words is one shingle.
    Two texts are linked if 100 * |intersection| >= percent * |union|; component_id is the smallest id that
    links reach, kept marks it.  Ids are integers.  Null, empty and blank texts have no shingles and no links.  Rows that repeat
    an id count as that one document; a row with null id has no component and is kept.  Texts of any length
    are used whole.  Other columns do not matter; no rows give no rows.
    """
    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    matches = match_threshold(coordinates, percent)
    sigs = written(_signatures(docs, width, coordinates), "signatures")
    usable = sigs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = usable.groupBy("set1", "set2").agg(F.min("doc_id").alias("rep"), F.min_by("sig", "doc_id").alias("sig"))
    live = written(_prefixes(reps.select("rep", "sig"), coordinates, matches), "live")
    sets = written(_sets(docs, written(live.select("rep"), "live-ids"), width), "sets")

    # step 3: every class against the centre that it meets most often
    trees = roots(_confirmed(_centres(live), sets, percent))

    # step 4: other links, by collisions in the prefix and look-ups beyond it
    placed = live.join(trees.withColumnRenamed("node", "rep"), "rep", "left").select("rep", F.coalesce("root", "rep").alias("root"), F.explode("prefix").alias("p"))
    apart = written(_apart(placed.select("rep", "root", F.col("p.key").alias("key"), F.col("p.df").alias("df")), "key"), "apart")
    marked = reps.select("rep", "sig").join(apart.select("rep").distinct(), "rep", "left_semi")
    pairs = _colliding(apart.where(F.col("df") <= LONG), written(marked, "marked"), matches)

    # step 5: the exact way for classes with long lists
    long_ones = apart.where(F.col("df") > LONG).groupBy("rep").agg(F.first("root").alias("root"))
    more = _confirmed(pairs.union(_overlapping(sets.join(long_ones, "rep"), percent)).dropDuplicates(["a", "b"]), sets, percent, ("root_a", "root_b"))
    joined = components(more.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    found = trees.join(joined, trees["root"] == joined["node"], "left").select(trees["node"], F.coalesce("component", "root").alias("component"))
    found = found.unionByName(joined.join(trees.select("node"), "node", "left_anti"))
    classes = reps.select("set1", "set2", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left")
    classes = classes.select("set1", "set2", F.coalesce("component", "rep").alias("component"))
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return (
        sigs.join(classes, ["set1", "set2"], "left")
        .select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
