"""Near-duplicate vectors: tiles of vectors in PCA order, compared by leading dimensions first.

1. Equal vectors of a label are one class.  The second moments of all unit vectors, summed in Spark, give the
   principal directions; only that matrix reaches the driver.  Turned into them, a vector has most of its length in
   its leading dimensions, and products stay as they are.
2. Classes are dealt into cells by their leading dimension, cells with too many of them by the next one too, and so
   on; what is left too large is cut by hashes.  So a tile has ``TILE`` vectors or about that, whatever a label or a
   dense group holds.
3. Two tiles are compared if their boxes in the leading dimensions, and the lengths of what remains, let vectors be
   close enough.  Tiles meet on a label and a band of the leading dimension as wide as the largest distance.
4. In a pair of tiles the products of the leading dimensions are summed first.  What the others can add is at most
   the product of the two remaining lengths; a pair of vectors that cannot reach the threshold any more is dropped,
   the others go on to the next dimensions.  What remains is decided on the given vectors in double precision.
5. A pair of tiles yields for each vector how many others it links to, and a tree over the linked ones: rows follow
   the vectors of the tiles, never the pairs of vectors.

Vectors spread evenly over all directions leave most pairs of tiles of a label to be compared; then the work, not
the memory and not the rows of a task, grows with the square of the label's classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components

#: Vectors of a tile, dimensions that cells and boxes use, and dimensions of one step of a comparison.
TILE, LEADING, STEP = 2048, 6, 8
#: What rounding may take off a product or a length; only pairs further off than that are dropped early.
SLACK = 1e-6


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that neither large nor small components run over."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch["dim"].to_numpy(zero_copy_only=False)
    for dim in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == dim))
        for at in range(0, part.num_rows, TILE):
            yield dim, part.slice(at, TILE)


def usable(vector: Column, label: Column) -> Column:
    """Whether a vector can link to others: a label, a component at least, all of them finite, one not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def principal(classes: DataFrame, dim: int) -> np.ndarray:
    """Directions as columns, by falling second moment of the unit vectors of ``classes(dim, vec)`` with ``dim`` components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for _, part in _by_dim(batch):
                u = _unit(_matrix(part["vec"], dim))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), dim).cast(pa.list_(pa.float64()))], names=["i", "row"])

    parts = classes.where(F.col("dim") == dim).select("dim", "vec").mapInArrow(run, "i int, row array<double>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # dim * dim numbers, whatever the vectors are
    moments = np.zeros((dim, dim))
    moments[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
    _, directions = np.linalg.eigh((moments + moments.T) / 2)
    return directions[:, ::-1]


def _placed(classes: DataFrame, directions: dict[int, np.ndarray], reach: float) -> DataFrame:
    """``classes`` with ``cells``, the cell numbers of the leading dimensions; a cell is as wide as ``reach``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part in _by_dim(batch):
                u = _unit(_matrix(part["vec"], dim))
                turned = u @ directions[dim][:, :LEADING] if dim in directions else u[:, :LEADING]
                cells = np.zeros((len(u), LEADING), np.int32)
                cells[:, : turned.shape[1]] = np.floor(turned / reach)
                own = pa.FixedSizeListArray.from_arrays(pa.array(cells.ravel()), LEADING).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, own], names=[*part.schema.names, "cells"])

    kept = classes.select("grp", "dim", "rep", "many", "vec")
    return kept.mapInArrow(run, kept.withColumn("cells", F.array().cast("array<int>")).schema)


def _tiled(placed: DataFrame) -> DataFrame:
    """``placed`` with ``tile``: cells are told apart by as few leading dimensions as leave ``TILE`` classes, and cut by hash where none do."""
    cells = written(placed.groupBy("grp", "dim", "cells").agg(F.count("*").alias("have")), "cells")
    levels = cells.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(LEADING - 1)))).withColumn("prefix", F.slice("cells", F.lit(1), F.col("k")))
    whole = levels.groupBy("grp", "dim", "k", "prefix").agg(F.sum("have").alias("whole")).where(F.col("whole") <= TILE)
    fits = levels.join(whole, ["grp", "dim", "k", "prefix"]).groupBy("grp", "dim", "cells").agg(F.min("k").alias("k"))
    # an empty prefix is a whole label; without one that fits, the cell is cut by hashes
    found = cells.join(fits, ["grp", "dim", "cells"], "left").select(
        "grp", "dim", "cells", F.slice("cells", F.lit(1), F.coalesce("k", F.lit(LEADING))).alias("tile"), F.when(F.col("k").isNull(), F.ceil(F.col("have") / TILE)).otherwise(1).alias("parts")
    )
    dealt = placed.join(written(found, "parts"), ["grp", "dim", "cells"])
    return dealt.withColumn("part", F.pmod(F.xxhash64("rep"), "parts")).drop("cells", "parts")


def _packed(tiled: DataFrame, directions: dict[int, np.ndarray]) -> DataFrame:
    """A row for each tile: its classes and vectors as bytes, and between which bounds the leading dimensions and the lengths beyond them lie."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[1].as_py()
        x = _matrix(table["vec"].combine_chunks(), dim)
        u = _unit(x)
        turned = u @ directions[dim] if dim in directions else u
        head = np.zeros((len(u), LEADING + 1))
        head[:, : min(dim, LEADING)] = turned[:, :LEADING]
        head[:, LEADING] = np.sqrt((turned[:, LEADING:] ** 2).sum(axis=1))
        reps, many = table["rep"].to_numpy(), table["many"].to_numpy()
        return pa.table({
            "tile_id": pa.array([reps.min()], pa.int64()), "grp": table["grp"][:1], "dim": pa.array([dim], pa.int32()), "lo": [head.min(axis=0).tolist()], "hi": [head.max(axis=0).tolist()],
            "reps": pa.array([reps.tobytes()], pa.binary()), "many": pa.array([many.tobytes()], pa.binary()), "vecs": pa.array([x.tobytes()], pa.binary()),
        })

    label = tiled.schema["grp"].dataType.simpleString()
    return tiled.groupBy("grp", "dim", "tile", "part").applyInArrow(run, f"tile_id bigint, grp {label}, dim int, lo array<double>, hi array<double>, reps binary, many binary, vecs binary")


def _meeting(tiles: DataFrame, reach: float) -> DataFrame:
    """``(a, b)``: the pairs of tiles, each with itself too, in which vectors can be as close as ``reach``."""
    band = lambda x: F.floor(x / F.lit(reach)).cast("bigint")
    ends = tiles.select("grp", "dim", F.col("tile_id"), "lo", "hi")
    left = ends.select("grp", "dim", F.explode(F.sequence(band(F.col("lo")[0]), band(F.col("hi")[0]))).alias("band"), F.col("tile_id").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"))
    right = ends.select("grp", "dim", F.explode(F.sequence(band(F.col("lo")[0] - reach), band(F.col("hi")[0] + reach))).alias("band"), F.col("tile_id").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"))
    gap = F.zip_with(F.arrays_zip("lo_a", "hi_a"), F.arrays_zip("lo_b", "hi_b"), lambda p, q: F.greatest(F.lit(0.0), p["lo_a"] - q["hi_b"], q["lo_b"] - p["hi_a"]))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x)
    return left.join(right, ["grp", "dim", "band"]).where(F.col("a") <= F.col("b")).where(apart <= reach * reach + SLACK).select("a", "b").distinct()


def linked(x: np.ndarray, y: np.ndarray, turn: np.ndarray | None, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the rows of ``x`` and ``y`` with a cosine of ``threshold`` or more."""
    u, v = _unit(x), _unit(y)
    p, q = (u, v) if turn is None else (u @ turn, v @ turn)
    steps = list(range(0, p.shape[1], STEP))
    rest = lambda t, k: np.sqrt((t[:, k:] ** 2).sum(axis=1))
    rows, cols = [], []
    for at in range(0, len(p), 512):
        part = p[at : at + 512]
        product = part[:, :STEP] @ q[:, :STEP].T
        i, j = np.nonzero(product + rest(part, STEP)[:, None] * rest(q, STEP)[None, :] >= threshold - SLACK)
        total = product[i, j]
        for k in steps[1:]:
            total += np.einsum("ij,ij->i", part[i, k : k + STEP], q[j, k : k + STEP])
            alive = total + rest(part, k + STEP)[i] * rest(q, k + STEP)[j] >= threshold - SLACK
            i, j, total = i[alive], j[alive], total[alive]
        for s in range(0, len(i), 1 << 15):
            a, b = i[s : s + (1 << 15)] + at, j[s : s + (1 << 15)]
            alive = np.einsum("ij,ij->i", u[a], v[b]) >= threshold
            rows.append(a[alive])
            cols.append(b[alive])
    return np.concatenate([np.zeros(0, np.int64), *rows]), np.concatenate([np.zeros(0, np.int64), *cols])


def _least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the least that links ``a``-``b`` reach."""
    least = np.arange(n)
    while len(a):
        before = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        np.minimum.at(least, before[a], low)
        np.minimum.at(least, before[b], low)
        while (least[least] != least).any():
            least = least[least]
        if (least == before).all():
            break
    return least


def _compared(meeting: DataFrame, tiles: DataFrame, directions: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """``(rep, root, links)`` of each class in each pair of tiles where it has links; ``links`` counts vectors."""
    blocks = tiles.select("tile_id", "dim", "reps", "many", "vecs")
    ends = meeting.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile_id"))
    both = ends.join(blocks, "tile_id")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        first, second = key[0].as_py(), key[1].as_py()
        of = {t: k for k, t in enumerate(table["tile_id"].to_pylist())}
        read = lambda name, t, kind: np.frombuffer(table[name][of[t]].as_buffer(), kind)
        dim = table["dim"][0].as_py()
        reps = [read("reps", t, np.int64) for t in (first, second)]
        many = [read("many", t, np.int64) for t in (first, second)]
        vecs = [read("vecs", t, np.float64).reshape(-1, dim) for t in (first, second)]
        i, j = linked(vecs[0], vecs[1], directions.get(dim), threshold)
        n = len(reps[0])
        if first == second:
            keep = i < j
            i, j = i[keep], j[keep]
            ids, weight = reps[0], many[0]
        else:
            j = j + n
            ids, weight = np.concatenate(reps), np.concatenate(many)
        links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids)) if len(i) else np.zeros(len(ids))
        order = np.argsort(ids, kind="stable")  # so that the least node is the least id
        place = np.empty_like(order)
        place[order] = np.arange(len(ids))
        least = _least_reached(len(ids), place[i], place[j])
        some = np.flatnonzero(links)
        return pa.table([pa.array(ids[some]), pa.array(ids[order][least[place[some]]]), pa.array(links[some].astype(np.int64))], names=["rep", "root", "links"])

    return both.groupBy("a", "b").applyInArrow(run, "rep bigint, root bigint, links bigint")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors with equal labels are linked if their cosine, in double precision, is ``threshold`` (above 0) or more;
    ``n_links`` counts a row's links, ``component_id`` is the least id that links reach, ``kept`` marks it.
    Vectors that are null, empty, zero, or hold null or non-finite components, those without a label and those
    with another number of components link with nothing; so does a row with null id, which has no component and is
    kept.  Ids are integers.  Rows that repeat an id with the same vector count once; with another vector, each goes by its own.  No
    rows give no rows; other columns do not matter.
    """
    given = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"), F.col(label_col).alias("label"))
    rows = given.where("vec_id IS NOT NULL").where(usable(F.col("vec"), F.col("label")))
    found = rows.groupBy("label", "vec").agg(F.min("vec_id").alias("least"), F.count_distinct("vec_id").alias("many"))
    # a name of its own for each class: two vectors may have the same least id
    named = found.select(F.col("label").alias("grp"), F.size("vec").alias("dim"), F.monotonically_increasing_id().alias("rep"), "least", "many", "vec")
    classes = written(named, "vectors")
    top = classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").first()
    directions = {top["dim"]: principal(classes, top["dim"])} if top else {}
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK)

    tiles = written(_packed(_tiled(_placed(classes, directions, reach)), directions), "tiles")
    pairs = written(_compared(_meeting(tiles, reach), tiles, directions, threshold), "links")
    links = pairs.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(pairs.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    placed = classes.select("rep", "least", "many").join(links, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    least = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id"))
    found = placed.join(least, "component", "left").select("rep", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    done = classes.select(F.col("grp").alias("label"), "vec", "rep").join(written(found, "found"), "rep").drop("rep")
    linked_rows = rows.join(done, ["label", "vec"])
    alone = given.where(F.col("vec_id").isNull() | ~usable(F.col("vec"), F.col("label")))
    out = linked_rows.select("vec_id", "n_links", "component_id").unionByName(alone.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
