"""Quality classifier: supervised subword embeddings.

Every word, every two words that follow each other, every character n-gram of a word (over code points, word ends
marked) and the end of the text is a hashed feature with a learned vector; a text is the average of its features'
vectors, and a softmax over the labels reads that average.  Two words are hashed by the exclusive or of their
hashes: their order does not count, and a word beside itself is the same feature whatever the word is.  Vectors and softmax are trained by stochastic gradient
descent in numpy, on a bounded sample of labelled rows.  As the average is linear, a trained model boils down to
one number per feature and label, and that table, of fixed size, scores whole texts of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, carry_names, give_back, hash_bounds, hashed, id_hash, mix, slices, spans, utf8
from .language_id import held_out

#: Hash buckets of features.
BUCKETS = 1 << 18
#: Character n-gram lengths, word ends counting as characters.
LENGTHS = (3, 4)
DIMENSIONS = 10
EPOCHS = 5
RATE = 0.5
#: Training takes the rows with the least hashes of their ids, so many at most and with so many bytes of text at most.
TRAIN_ROWS = 4000
TRAIN_BYTES = 24_000_000

#: The feature beyond the hashed ones: the end of a text.
END = BUCKETS

_MULTIPLY = np.uint32(2654435761)


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character (its bytes, packed), and the first character of each text (one more than texts)."""
    first = np.flatnonzero((data & 0xC0) != 0x80)
    size = np.diff(np.append(first, len(data)))
    wide = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    code = wide[first]
    for k in range(1, 4):
        code = np.where(size > k, code | wide[first + k] << np.uint32(8 * k), code)
    return code, np.searchsorted(first, offsets)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row and hashed feature, in parts, for some texts."""
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    starts, ends = spans(data, offsets, SPACES)
    if len(starts):
        words, of = hashed(data, starts, ends), row[starts]
        yield of, (words % np.uint64(BUCKETS)).astype(np.int64)
        two = np.flatnonzero(of[1:] == of[:-1])
        yield of[two], (mix(words[two] ^ words[two + 1]) % np.uint64(BUCKETS)).astype(np.int64)
    # texts with one blank before and after each, blanks standing for word ends
    code, offsets = _code_points(data, offsets)
    rows = len(offsets) - 1
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets))
    padded = np.full(len(code) + 2 * rows, 32, np.uint32)
    owner = np.repeat(np.arange(rows, dtype=np.int32), np.diff(offsets) + 2)
    padded[np.arange(len(code)) + 2 * row + 1] = np.where((code < 128) & SPACES[code & 0xFF], 32, code)
    blank = padded == 32
    for n in LENGTHS:
        if len(padded) < n:
            continue
        at = len(padded) - n + 1
        gram = np.full(at, np.uint32(n))
        inner = np.ones(at, bool)
        for i in range(n):
            gram = (gram ^ padded[i : i + at]) * _MULTIPLY
            gram ^= gram >> np.uint32(15)
            if 0 < i < n - 1:
                inner &= ~blank[i : i + at]
        yield owner[:at][inner], (gram[inner] % np.uint32(BUCKETS)).astype(np.int64)


class Model:
    """``weights[feature]`` and ``bias``: the logit of label 1 of a text is its features' mean weight plus the bias."""

    def __init__(self, weights: np.ndarray, end: float, bias: float) -> None:
        self.weights, self.end, self.bias = weights, end, bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        rows = len(offsets) - 1
        total, count = np.full(rows, self.end), np.ones(rows)
        for row, feature in features(data, offsets):
            total += np.bincount(row, weights=self.weights[feature], minlength=rows)
            count += np.bincount(row, minlength=rows)
        return 1 / (1 + np.exp(-np.clip(total / count + self.bias, -500, 500)))


def fit(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> Model:
    """Trained on some texts with labels 0 and 1.  Without rows of both labels, the model only knows the share of 1."""
    if len(labels) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Model(np.zeros(BUCKETS, np.float32), 0.0, float(np.log(share / (1 - share))))
    bags = []
    for i in range(len(texts)):
        data, offsets = utf8(texts.slice(i, 1))
        parts = [f for _, f in features(data, offsets)]
        feature, n = np.unique(np.concatenate([[END], *parts]), return_counts=True)
        bags.append((feature, (n / n.sum()).astype(np.float32)))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)
    softmax, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(bags)).tolist():
            descend(vectors, softmax, bias, *bags[i], int(labels[i]), np.float32(RATE * (1 - done / steps)))
            done += 1
    weights = vectors @ (softmax[1] - softmax[0])
    return Model(weights[:BUCKETS].copy(), float(weights[END]), float(bias[1] - bias[0]))


def descend(vectors: np.ndarray, softmax: np.ndarray, bias: np.ndarray, feature: np.ndarray, share: np.ndarray, label: int, rate: np.float32) -> None:
    """One step, in place, down the gradient of the log loss of a text whose features have these shares.

    The bias moves a tenth as fast; a feature moves as its share of the text, fifty times as fast, as texts have
    many features.
    """
    own = vectors[feature]
    hidden = share @ own
    logits = softmax @ hidden + bias
    p = np.exp(logits - logits.max())
    p /= p.sum()
    p[label] -= 1
    back = p @ softmax
    softmax -= rate * np.outer(p, hidden)
    bias -= rate * np.float32(0.1) * p
    vectors[feature] = own - rate * np.float32(50) * share[:, None] * back


def train(documents: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """The model of rows of ``documents(doc_id, text)`` that ``labels(doc_id, <label_col>)`` marks 0 or 1.

    An id that is marked twice has the least mark; of rows that repeat an id one counts (the least text), so no
    more than TRAIN_ROWS texts and TRAIN_BYTES reach the driver.  Null ids teach nothing, null texts count as empty.
    """
    marked = labels.where(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label_col).alias("y"))
    marked = marked.select("doc_id", "y", id_hash(F.col("doc_id")).alias("h"))
    docs = documents.where("doc_id IS NOT NULL").select("doc_id", id_hash(F.col("doc_id")).alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id", "h").join(marked.select("doc_id"), "doc_id")
    bounds = [r["bound"] for r in hash_bounds(ids.select(F.lit("all").alias("grp"), "h"), TRAIN_ROWS).collect()]
    if not bounds:
        return fit(pa.array([], pa.string()), np.zeros(0, np.int64))
    few = docs.where(F.col("h") < bounds[0]).join(marked.where(F.col("h") < bounds[0]).select("doc_id", "y"), "doc_id")
    few = few.groupBy("h").agg(F.min(F.struct("text", "y")).alias("one")).select("h", "one.text", "one.y")
    chosen, size = [], 0
    for h, n in sorted(tuple(r) for r in few.select("h", F.octet_length("text")).collect()):
        if size + n <= TRAIN_BYTES:
            chosen.append(h)
            size += n
    got = few.where(F.col("h").isin(chosen)).toArrow().sort_by("h")
    return fit(got["text"].combine_chunks(), got["y"].to_numpy().astype(np.int64))


def _scored(documents: DataFrame, model: Model, carry: tuple[str, ...], keep_text: bool) -> DataFrame:
    """``(_carry0, _carry1, ..., score)`` and, if asked, ``_text``, which then goes to Python and back once."""
    own = [f"_carry{i}" for i in range(len(carry))]  # whatever they are called, they clash with nothing
    docs = documents.select(F.col("text").alias("_text"), *(F.col(c).alias(o) for c, o in zip(carry, own, strict=True)))
    sent = documents.sparkSession.sparkContext.broadcast(model)
    back = ["_text", *own] if keep_text else own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", 1 << 19):
                scores = sent.value.scores(*utf8(part["_text"]))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in back), pa.array(scores)], names=[*back, "score"])
        give_back()

    types = {f.name: f.dataType.simpleString() for f in docs.schema}
    return docs.mapInArrow(run, ", ".join([*(f"{c} {types[c]}" for c in back), "score double"]))


def score(documents: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(*carry, score)``, one row per row of ``documents(text, *carry)``: the chance of label 1, empty and null texts too.

    A carried column called ``score`` becomes ``given_score``; no rows give no rows.
    """
    names = {f"_carry{i}": n for i, n in enumerate(carry_names(carry, ["score"]))}
    return _scored(documents, model, carry, keep_text=False).withColumnsRenamed(names)


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row of ``documents(doc_id, text)``, learned from rows not held out.

    One row per input row: rows that repeat an id are scored each by its own text, null ids are carried, null and
    empty texts have the score of a text without words.  A score of exactly 0.5 predicts 1.  Without labels of both
    kinds all rows score the share of 1 (0.5 without any).  Other columns are never looked at; no rows give no rows.
    """
    docs = documents.select("doc_id", "text").withColumn("held_out", held_out())
    model = train(docs.where("NOT held_out").select("doc_id", "text"), labels)
    return score(docs, model, carry=("doc_id", "held_out")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` with all their columns, whatever they are called, whose score reaches ``threshold``.

    Each row goes by its own text: null ids and repeated ids too.  Null and empty texts are scored like any other.
    Without labels every row has the same score, 0.5 if there are none at all.  No rows give no rows.
    """
    model = train(documents.where(~held_out()).select("doc_id", "text"), labels)
    carry = [c for c in documents.columns if c != "text"]
    kept = _scored(documents, model, tuple(carry), keep_text=True).where(F.col("score") >= threshold)
    return kept.select(*(F.col("_text").alias(c) if c == "text" else F.col(f"_carry{carry.index(c)}").alias(c) for c in documents.columns))
