"""Language identification by prediction by partial matching (PPM).

For each language a context tree over bytes holds how often each byte followed each context of up to
``ORDER`` bytes.  A byte that a context has not seen costs an escape (as many chances as the context has
distinct followers) and is coded in the next shorter context, and last at 8 bits.  The counts are frozen
after training, so a text's code length under each language is a sum of table entries: the language with the
shortest code wins.

The trees come from a bounded sample of labelled rows, counted in Spark, and all their counts take part.  They
are laid out as one table of code lengths where that has at most ``CELLS`` entries, and else sparsely, with what
each language has seen; the result is what is sent to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, carry_names, hash_bounds, id_hash, slices, utf8

#: Longest context in bytes.
ORDER = 3
#: Training rows of each language at most, those with the least hashes of their ids; further rows are not read for training.
TRAIN_ROWS = 1500
#: Bytes of training text of all languages together, an equal share for each; a language whose first text is longer than that learns from it alone.
TRAIN_BYTES = 24_000_000
#: Entries of the largest table of code lengths; with more, they are kept sparsely.
CELLS = 16_000_000


def _grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte, it and the ORDER bytes before it in its own text, packed; zeros stand before a text."""
    out = data.astype(np.uint32)
    for k in range(1, ORDER + 1):
        back = np.zeros(len(data), np.uint32)
        back[k:] = data[:-k] if k < len(data) else 0
        for j in range(min(k, ORDER)):
            at = offsets[:-1] + j
            back[at[at < offsets[1:]]] = 0
        out |= back << np.uint32(8 * k)
    return out


def count_grams(documents: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` of ``documents(lang, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                langs = np.array(part["lang"].to_pylist(), object)
                data, offsets = utf8(part["text"])
                grams = _grams(LOWER[data], offsets)
                row = np.repeat(np.arange(len(langs)), np.diff(offsets))
                for lang in dict.fromkeys(langs.tolist()):
                    own, n = np.unique(grams[(langs == lang)[row]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(own), pa.string()), pa.array(own.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"],
                    )

    return documents.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class _Rows:
    """Values by key and language: for each of the sorted ``keys``, those of the languages that have it."""

    def __init__(self, keys: np.ndarray, lang: np.ndarray, value: np.ndarray) -> None:
        self.keys, starts = np.unique(keys, return_index=True)
        self.starts, self.lang, self.value = np.append(starts, len(keys)), lang.astype(np.int32), value.astype(np.float32)

    def of(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of ``wanted``, language and value."""
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        n = np.where(self.keys[at] == wanted, self.starts[at + 1] - self.starts[at], 0)
        own = np.repeat(self.starts[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(np.arange(len(wanted)), n), self.lang[own], self.value[own]


class Model:
    """Code lengths in bits: ``cost[context, byte class, language]``, or ``sparse``: for each order what follows and what escapes."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> None:
        self.langs = langs
        self.sparse: list[tuple[_Rows, _Rows]] = []  # of order k: code lengths of the bytes seen, and of escapes
        parts = [(gram >> 8 * k & 255).astype(np.int64) for k in range(ORDER + 1)]  # parts[0] is the byte itself
        seen = np.unique(np.concatenate([*(p for p in parts), [0]]))
        self.classes = np.full(256, len(seen), np.int64)
        self.classes[seen] = np.arange(len(seen))
        self.classes = self.classes[LOWER]
        width = self.width = len(seen) + 1  # the last class stands for bytes that training never had
        cls = [np.searchsorted(seen, p) for p in parts]
        contexts = 1 + sum(len(np.unique(gram >> 8 & (1 << 8 * k) - 1)) for k in range(1, ORDER + 1))
        if contexts * width * max(1, len(langs)) > CELLS:
            self._keep_sparse(lang, gram, n)
            return
        self.index: list[np.ndarray] = []  # of order k: context of k classes -> row of cost
        tables = []
        rows = 0
        shorter: np.ndarray | None = None
        known = np.zeros(len(gram), np.int64)  # the row of each gram's context at the order below
        for k in range(ORDER + 1):
            if k == 0:
                ids, own = np.zeros(1, np.int64), np.zeros(len(gram), np.int64)
                link = np.zeros(1, np.int64)
            else:
                key = cls[1].copy()
                for j in range(2, k + 1):
                    key = key + cls[j] * width ** (j - 1)
                ids, own = np.unique(key, return_inverse=True)
                link = np.zeros(len(ids), np.int64)
                link[own] = known
            counts = np.zeros((len(ids), width, max(1, len(langs))), np.float32)
            np.add.at(counts, (own, cls[0], lang), n)
            total, kinds = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
            below = np.full((1, 1, 1), 8.0, np.float32) if shorter is None else shorter[link]
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / np.maximum(kinds, 1)), 0)
                cost = np.where(counts > 0, np.log2((total + kinds) / counts), escape + below).astype(np.float32)
            tables.append(cost)
            self.index.append(ids)
            shorter = np.concatenate(tables) if k < ORDER else None
            known = own + rows
            rows += len(ids)
        self.cost = np.concatenate(tables)
        self.starts = np.cumsum([0, *(len(x) for x in self.index)])[:-1]
        self._lay_out()

    def _keep_sparse(self, lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> None:
        many = len(self.langs)
        for k in range(ORDER + 1):
            ids, own = np.unique((gram & (1 << 8 * (k + 1)) - 1) * many + lang, return_inverse=True)
            count, key, of = np.bincount(own, weights=n), ids // many, ids % many
            before, own = np.unique((key >> 8) * many + of, return_inverse=True)
            kinds = np.bincount(own)
            total = np.bincount(own, weights=count) + kinds
            self.sparse.append((_Rows(key, of, np.log2(total[own] / count)), _Rows(before // many, before % many, np.log2(total / kinds))))

    def _sparse_bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        if not len(full):
            return out
        grams, own = np.unique(_grams(LOWER[data], offsets).astype(np.int64), return_inverse=True)
        cost = np.full((len(grams), len(self.langs)), 8.0, np.float32)
        for k, (seen, escapes) in enumerate(self.sparse):
            key = grams & (1 << 8 * (k + 1)) - 1
            at, lang, value = escapes.of(key >> 8)
            cost[at, lang] += value
            at, lang, value = seen.of(key)
            cost[at, lang] = value
        for j in range(len(self.langs)):
            out[full, j] = np.add.reduceat(cost[own, j], offsets[:-1][full], dtype=np.float64)
        return out

    def _lay_out(self) -> None:
        """Direct tables: two classes -> a number, and that number and a third class -> a row of cost."""
        w = self.width
        one = np.zeros(w, np.int32)
        one[self.index[1]] = self.starts[1] + np.arange(len(self.index[1]))
        two = np.tile(one, (w, 1))  # [before, last]
        a, b = self.index[2] // w, self.index[2] % w
        two[a, b] = self.starts[2] + np.arange(len(self.index[2]))
        pairs = np.unique(self.index[3] // w)  # the two earlier classes of known contexts of three
        self.number = np.zeros(w * w, np.int32)
        self.number[pairs] = np.arange(1, len(pairs) + 1)
        self.three = np.zeros(((len(pairs) + 1) * w,), np.int32)
        self.three[: w] = -1
        for i, p in enumerate(pairs.tolist()):
            self.three[(i + 1) * w : (i + 2) * w] = two[p % w]
        at = (np.searchsorted(pairs, self.index[3] // w) + 1) * w + self.index[3] % w
        self.three[at] = self.starts[3] + np.arange(len(self.index[3]))
        self.two = two.reshape(-1)

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The code length of each text under each language."""
        if self.sparse:
            return self._sparse_bits(data, offsets)
        w, zero = self.width, int(self.classes[0])
        cls = self.classes[data].astype(np.int32)
        back = []
        for k in range(1, ORDER + 1):
            b = np.full(len(data), zero, np.int32)
            b[k:] = cls[:-k] if k < len(cls) else zero
            for j in range(k):
                at = offsets[:-1] + j
                b[at[at < offsets[1:]]] = zero
            back.append(b)
        number = self.number[back[2] * w + back[1]]
        row = np.where(number > 0, self.three[number * w + back[0]], self.two[back[1] * w + back[0]])
        each = self.cost.reshape(-1, self.cost.shape[2])[row.astype(np.int64) * w + cls]
        out = np.zeros((len(offsets) - 1, each.shape[1]))
        full = np.flatnonzero(offsets[1:] > offsets[:-1])
        if len(full):
            out[full] = np.add.reduceat(each, offsets[:-1][full], axis=0, dtype=np.float64)
        return out


def train(labelled: DataFrame) -> Model:
    """The model of ``labelled(doc_id, lang, text)``: at most TRAIN_ROWS rows of each language, whole texts.

    The rows are those whose id's hash is below a bound of their language, in the order of these hashes up to the
    language's share of TRAIN_BYTES; texts longer than the share come last.  Null languages are left out, null texts
    count as empty, of rows that repeat an id in a language one counts (the least text); no rows give no language.
    """
    rows = labelled.where("lang IS NOT NULL").select(F.col("lang").alias("grp"), id_hash(F.col("doc_id")).alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    bounds = hash_bounds(rows.select("grp", "h"), TRAIN_ROWS)
    sample = rows.join(F.broadcast(bounds), "grp").where("h < bound")  # a row for each language
    sample = sample.groupBy(F.col("grp").alias("lang"), "h").agg(F.min("text").alias("text"))
    share, size = TRAIN_BYTES // max(1, bounds.count()), F.octet_length("text")
    along = Window.partitionBy("lang").orderBy(size > share, "h")  # TRAIN_ROWS rows at most
    sample = sample.select("lang", "text", F.sum(size).over(along).alias("upto"), F.row_number().over(along).alias("place")).where((F.col("upto") <= share) | (F.col("place") == 1))
    got = count_grams(sample.select("lang", "text")).toArrow()
    langs = sorted(pc.unique(got["lang"]).to_pylist())
    lang = pc.index_in(got["lang"], value_set=pa.array(langs, got["lang"].type)).to_numpy()
    return Model(langs, np.asarray(lang, np.int64), got["gram"].to_numpy().astype(np.int64), got["n"].to_numpy().astype(np.float64))


def predict(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, lang_pred, score, *carry)``, one row per input row: the language whose code for the whole text is shortest.

    ``score`` is that language's share of the probability that the code lengths stand for, languages being
    equally likely.  A text that is null or has no letter gets ``und`` and 0; so does every text if no language
    was learned.  On a tie the language first in alphabetical order wins.  Ids are carried as they are, null and
    repeated ones too; a carried column called like a result gets ``given_`` before its name; no rows give no rows.
    """
    own = [f"_carry{i}" for i in range(len(carry))]  # whatever they are called, they clash with nothing
    docs = documents.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("_letter"),
        *(F.col(c).alias(o) for c, o in zip(carry, own, strict=True)),
    )
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for part in slices(batch, "_text", 1 << 19):
                data, offsets = utf8(part["_text"])
                letter = part["_letter"].to_numpy(zero_copy_only=False)
                if model.langs:
                    bits = model.bits(data, offsets)
                    best = bits.argmin(axis=1)
                    score = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                    pred = [model.langs[i] if yes else "und" for i, yes in zip(best, letter, strict=True)]
                else:
                    score, pred = np.zeros(len(letter)), ["und"] * len(letter)
                yield pa.RecordBatch.from_arrays(
                    [part["_id"], pa.array(pred, pa.string()), pa.array(np.where(letter, score, 0.0)), *(part[o] for o in own)],
                    names=["doc_id", "lang_pred", "score", *own],
                )

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    out = docs.mapInArrow(run, f"doc_id {types['_id']}, lang_pred string, score double" + "".join(f", {o} {types[o]}" for o in own))
    return out.withColumnsRenamed(dict(zip(own, carry_names(carry, ["doc_id", "lang_pred", "score"]), strict=True)))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 3, is 1 (a null id is not)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(documents: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of ``documents(doc_id, text, lang)``, learned from rows not held out.

    One row per input row.  Rows with null id or null lang teach nothing, as ``train`` says; null texts, ties and no
    learned language are as in ``predict``.  Other columns do not matter; no rows give no rows.
    """
    docs = documents.select("doc_id", "text", "lang").withColumn("held_out", held_out())
    model = train(docs.where("NOT held_out AND doc_id IS NOT NULL").select("doc_id", "lang", "text"))
    return predict(docs, model, carry=("held_out",)).select("doc_id", "held_out", "lang_pred", "score")
