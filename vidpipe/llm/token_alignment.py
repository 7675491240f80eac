"""Alignment of two tokenizers' tokens by the places where both end, and how often each pair of ids is linked.

1. Texts are cut, by Arrow buffers alone, into pieces that no token of either tokenizer crosses: before a space that
   follows neither white space nor another space.  Of a few megabytes of texts each distinct piece is encoded once.
2. Token ends are segmented cumulative sums over flattened token lists.  A hash join of both sides' (piece, end)
   keys gives the places where both end; counting them numbers the groups of tokens between.
3. The tokens of a group are joined and counted as (piece, pair of ids), and pieces joined to texts give the texts
   that hold each pair: partial counts, which Spark adds up over all texts.
4. Texts wait as the numbers of their pieces, a row for each chunk.  The counts of all pairs are sent to every task if
   they are ``SENT`` or fewer; else those of a chunk's pairs are joined to it, a row for each pair of a chunk.

Rows of all steps follow the texts and the pairs in them.  The pairs of a chunk are worked out ``PAIRS`` rows at a
time, however many tokens a group has.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, slices, utf8, written

#: Bytes of text of a chunk (a longer text is one), rows of pairs worked out at a time, and pairs whose counts (17 bytes each) are sent to every task.
CHUNK_BYTES, PAIRS, SENT = 3 << 19, 1 << 19, 1 << 21
#: Bytes of pieces that are encoded as one text.
BLOCK = 1 << 13
#: Bits of the second id in a packed pair.
LOW = 32


class Side:
    """A tokenizer for pieces that begin with a space: token ids, and of each id its bytes."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], token_bytes: list[bytes]) -> None:
        self.encode = encode
        self.spelled = token_bytes
        self.sizes = pa.array([len(b) for b in token_bytes], pa.int64())
        self.names = pa.array([str(i) for i in range(len(token_bytes))])

    def tokens(self, pieces: pa.StringArray) -> tuple[pa.ListArray, np.ndarray]:
        """The ids of each piece, and which pieces they spell exactly.

        Pieces are encoded many at a time, as one text; only where its tokens do not spell that text, or a piece ends
        in white space, piece by piece.
        """
        data, offsets = utf8(pieces)
        raw, firm = data.tobytes(), _firm(data, offsets[1:])
        flat, sizes, whole = [np.zeros(0, np.int32)], [np.zeros(1, np.int32)], []
        cuts = np.unique(np.concatenate([[0], np.searchsorted(offsets, np.arange(BLOCK, len(data), BLOCK)), [len(pieces)]]))
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = offsets[x : y + 1] - offsets[x]
            if firm[x:y].all():
                found = self.encode([raw[offsets[x] : offsets[y]].decode()])[0]
                if b"".join(map(self.spelled.__getitem__, found)) == raw[offsets[x] : offsets[y]]:
                    flat.append(np.array(found, np.int32))
                    ends = np.cumsum(self.sizes.to_numpy()[flat[-1]])
                    sizes.append(np.diff(np.searchsorted(ends, own, side="right")).astype(np.int32))
                    whole.append(np.ones(y - x, bool))
                    continue
            texts = [raw[i:j] for i, j in zip(offsets[x:y].tolist(), offsets[x + 1 : y + 1].tolist(), strict=True)]
            found = self.encode([t.decode() for t in texts])
            sizes.append(np.fromiter(map(len, found), np.int32, len(found)))
            flat.append(np.fromiter(itertools.chain.from_iterable(found), np.int32, sizes[-1].sum()))
            whole.append(np.array([b"".join(self.spelled[i] for i in ids) == t for ids, t in zip(found, texts, strict=True)], bool))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes), dtype=np.int32)), pa.array(np.concatenate(flat)))
        return lists, np.concatenate([np.zeros(0, bool), *whole])


def _firm(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each of ``ends`` is no white space: none of C2, E1, E2, E3 begins it, as white space beyond ASCII does."""
    one, two, three = (np.where(ends >= k, data[np.maximum(ends - k, 0)], 0) for k in (1, 2, 3))
    return (one > 0x20) & (one < 0x7F) | (one >= 0x80) & (two != 0xC2) & ~((three >= 0xE1) & (three <= 0xE3))


def _byte_level(json_path: str) -> Side:
    """The byte-level BPE of a ``tokenizers`` file; its ids follow its merges, so they serve as ranks."""
    import public_tokenizers
    import tiktoken

    with open(json_path, encoding="utf-8") as file:
        model = json.load(file)
    # printable bytes stand for themselves, the others for the characters from U+0100 on
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letter = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["id"] for t in model["added_tokens"] if t["special"]}
    ranks = {bytes(letter[c] for c in token): i for token, i in model["model"]["vocab"].items() if i not in special}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    by_id = {i: b for b, i in ranks.items()}
    return Side(lambda texts: [encoding.encode_ordinary(t) for t in texts], [by_id.get(i, b"") for i in range(max(by_id) + 1)])


def _pieced(model_path: str) -> Side:
    """A ``sentencepiece`` model with byte fallback; it puts a space before what it is given."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = range(model.get_piece_size())
    names = [model.id_to_piece(i) for i in ids]
    if any("▁" in n.lstrip("▁") for n in names):
        raise ValueError("a piece of this model reaches over a space, so texts cannot be cut there")
    token_bytes = [bytes([int(n[3:-1], 16)]) if model.is_byte(i) else b"" if model.is_control(i) else n.replace("▁", " ").encode() for i, n in zip(ids, names, strict=True)]
    space = names.index("▁")
    return Side(lambda texts: [e if t != " " else [space] for t, e in zip(texts, model.encode([t[1:] for t in texts], num_threads=1), strict=True)], token_bytes)


@cache
def _sides(json_path: str, model_path: str) -> tuple[Side, Side]:
    return _byte_level(json_path), _pieced(model_path)


def cut(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """The pieces of ``space + text`` of all texts in order, and the first piece of each text (one more than texts); empty texts have none."""
    filled = pc.fill_null(texts.cast(pa.string()), "")
    spaced = pc.if_else(pc.equal(filled, ""), "", pc.binary_join_element_wise(" ", filled, ""))
    data, offsets = utf8(spaced)
    if not len(data):
        return pa.array([], pa.string()), np.zeros(len(offsets), np.int64)
    spaces = np.flatnonzero(data == 0x20)
    begins = np.zeros(len(data), bool)
    begins[spaces[_firm(data, spaces)]] = True
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data.tobytes()))
    return pieces, np.searchsorted(starts, offsets)


def _ends(tokens: pa.ListArray, side: Side) -> pa.Table:
    """A row for each token: its piece, where in the piece it ends, its place among all tokens and its id."""
    flat, piece = pc.list_flatten(tokens), pc.list_parent_indices(tokens)
    total = pc.cumulative_sum(pc.take(side.sizes, flat)) if len(flat) else pa.array([], pa.int64())
    before = np.concatenate([[0], total.to_numpy()])[tokens.offsets.to_numpy()[:-1]]
    end = pc.subtract(total, pc.take(pa.array(before), piece))
    return pa.table({"piece": piece.cast(pa.int64()), "end": end, "at": pa.array(np.arange(len(flat))), "id": flat.cast(pa.int64())})


def _groups(a: pa.Table, b: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of each token of both sides, that is how many common ends come before its own, and the piece of each group."""
    both = a.select(["piece", "end", "at"]).join(b.select(["piece", "end", "at"]), ["piece", "end"], join_type="inner", right_suffix="_b", use_threads=False)
    out = []
    for side, at in ((a, "at"), (b, "at_b")):
        last = np.zeros(len(side), np.int64)
        last[both[at].to_numpy()] = 1
        out.append(np.cumsum(last) - last)
    return out[0], out[1], np.sort(both["piece"].to_numpy())


def _strings(rows: pa.Table, group: np.ndarray, groups: int, side: Side) -> pa.Array:
    """The ids of each group, joined by commas."""
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(group, np.arange(groups + 1)).astype(np.int32)), pc.take(side.names, rows["id"].combine_chunks()))
    return pc.binary_join(lists, ",")


def _counted(table: pa.Table, keys: list[str], value: str) -> pa.Table:
    out = table.group_by(keys, use_threads=False).aggregate([(value, "sum")])
    return out.rename_columns([value if c == f"{value}_sum" else c for c in out.column_names]).select([*keys, value])


def _pairs(a: pa.Table, group_a: np.ndarray, b: pa.Table, group_b: np.ndarray, piece_of: np.ndarray) -> pa.Table:
    """``(piece, pair, n)``: how often the tokens of a pair of ids stand in one group of a piece."""
    size_a, size_b = (np.bincount(g, minlength=len(piece_of)) for g in (group_a, group_b))
    large = size_a * size_b > 64  # there equal ids are counted before they meet others
    sides = []
    for t, g in ((a, group_a), (b, group_b)):
        rows, many = pa.table({"group": pa.array(g), "id": t["id"], "n": pa.array(np.ones(len(g), np.int64))}), large[g]
        if many.any():
            rows = pa.concat_tables([rows.filter(pa.array(~many)), _counted(rows.filter(pa.array(many)), ["group", "id"], "n")])
        sides.append(rows)
    one, two = sides[0], sides[1].rename_columns(["group", "other", "m"])
    # a bounded number of rows of the join at a time: rows of the first side, by how many of the second each meets
    met = np.bincount(two["group"].to_numpy(), minlength=len(piece_of))[one["group"].to_numpy()]
    upto, out, at = np.cumsum(met), [], 0
    while at < len(one):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        part = one.slice(at, to - at).join(two, "group", join_type="inner", use_threads=False)
        pair = pc.bit_wise_or(pc.shift_left(part["id"], LOW), part["other"])
        out.append(_counted(pa.table({"piece": pc.take(pa.array(piece_of), part["group"]), "pair": pair, "n": pc.multiply(part["n"], part["m"])}), ["piece", "pair"], "n"))
        at = to
    none = pa.table({"piece": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    return out[0] if len(out) == 1 else _counted(pa.concat_tables([none, *out]), ["piece", "pair"], "n")


def _texts_by_pair(row: np.ndarray, numbers: np.ndarray, piece: np.ndarray, place: np.ndarray, pieces: int) -> pa.Table:
    """``(place, docs)``: how many texts hold each pair; ``row`` and ``numbers`` are the text and number of each piece, ``piece`` and ``place`` the pairs of each, sorted."""
    held = np.unique(row << 32 | numbers)
    text, own = held >> 32, held & 0xFFFFFFFF
    bounds = np.searchsorted(piece, np.arange(pieces + 1))
    many = np.diff(bounds)[own]
    upto, out, at = np.cumsum(many), [pa.table({"place": pa.array([], pa.int64()), "docs": pa.array([], pa.int64())})], 0
    while at < len(held):  # whole texts, some rows at a time
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS, side="right")))
        to = int(np.searchsorted(text, text[to - 1], side="right"))
        n = many[at:to]
        each = np.repeat(bounds[own[at:to]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        distinct = pa.table({"key": pa.array(np.repeat(text[at:to], n) << 32 | place[each])}).group_by("key", use_threads=False).aggregate([])
        places = pc.bit_wise_and(distinct["key"], 0xFFFFFFFF)
        out.append(pa.table({"place": places}).group_by("place", use_threads=False).aggregate([("place", "count")]).rename_columns(["place", "docs"]))
        at = to
    return _counted(pa.concat_tables(out), ["place"], "docs").sort_by("place")


def _bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


#: A chunk of texts: their ids, and the pieces of each, none if it has no tokens; what the pieces hold; the pairs of each piece in
#: turn, by place in ``pair``, and how often; the pairs of the chunk, and how many of its texts hold each.  Binary: packed tables.
_ENCODED = "chunk bigint, ids array<bigint>, sizes binary, pieces binary, lexicon binary, links binary, pair array<bigint>, docs array<bigint>"


def _chunk(part: pa.RecordBatch, name: int, sides: tuple[Side, Side]) -> pa.RecordBatch:
    pieces, first = cut(part["text"])
    coded = pieces.dictionary_encode()
    lexicon, numbers = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    del pieces, coded
    tokens, exact = zip(*(s.tokens(lexicon) for s in sides), strict=True)
    whole = exact[0] & exact[1]
    # texts with a piece that one side does not give back have no tokens
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    good = np.ones(len(first) - 1, bool)
    good[row[~whole[numbers]]] = False
    numbers = numbers[good[row]].astype(np.int32)
    sizes = np.where(good, np.diff(first), 0).astype(np.int32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    if not whole.all():
        tokens = [pc.if_else(pa.array(whole), t, pa.array([[]], pa.list_(pa.int32()))[0]) for t in tokens]
    a, b = (_ends(t, s) for t, s in zip(tokens, sides, strict=True))
    group_a, group_b, piece_of = _groups(a, b)
    texts = pc.binary_join_element_wise(_strings(a, group_a, len(piece_of), sides[0]), _strings(b, group_b, len(piece_of), sides[1]), "|")
    bounds = np.searchsorted(piece_of, np.arange(len(lexicon) + 1))
    size_a, size_b = (np.bincount(g, minlength=len(piece_of)).astype(np.int64) for g in (group_a, group_b))
    sums = lambda x: pa.array(np.diff(np.concatenate([[0], np.cumsum(x)])[bounds]))
    described = pa.table({
        "groups": pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), texts), ";"),
        "n_a": sums(size_a), "n_b": sums(size_b), "n_groups": pa.array(np.diff(bounds)), "n_links": sums(size_a * size_b),
    })
    del texts
    links = _pairs(a, group_a, b, group_b, piece_of).sort_by([("piece", "ascending"), ("pair", "ascending")])
    of_piece, link_pair = links["piece"].to_numpy(), links["pair"].to_numpy()
    # pieces of texts without tokens have pairs that no text holds
    pair, place = np.unique(link_pair, return_inverse=True)
    counts = _texts_by_pair(row, numbers, of_piece, place, len(lexicon))
    kept = counts["place"].to_numpy()
    known = np.isin(place, kept) if len(kept) < len(pair) else np.ones(len(place), bool)
    each = np.bincount(of_piece[known], minlength=len(lexicon))
    linked = pa.table({"place": pa.array(np.searchsorted(kept, place[known]).astype(np.int32)), "times": links["n"].to_numpy()[known]})
    described = described.append_column("links", pa.array(each))
    values = [_bytes(t) for t in (pa.table({"n": sizes}), pa.table({"n": numbers}), described, linked)]
    lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (part["doc_id"], pa.array(pair[kept]), counts["docs"].combine_chunks())]
    return pa.RecordBatch.from_arrays(
        [pa.array([name], pa.int64()), lists[0], *(pa.array([v], pa.binary()) for v in values), *lists[1:]], names=[f.split()[0] for f in _ENCODED.split(", ")]
    )


def _encoded(documents: DataFrame, json_path: str, model_path: str, id_col: str, text_col: str) -> DataFrame:
    """All texts by their pieces, chunk by chunk, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, many = TaskContext.get(), 0
        sides = _sides(json_path, model_path)
        for batch in batches:
            for part in slices(batch, "text", CHUNK_BYTES):
                yield _chunk(part, task.partitionId() << 32 | many, sides)
                many += 1
                give_back()

    docs = documents.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return written(docs.mapInArrow(run, _ENCODED), "aligned")


def _pair_rows(encoded: DataFrame) -> DataFrame:
    return encoded.select("chunk", F.inline(F.arrays_zip("pair", "docs")))


def _totals(rows: DataFrame) -> DataFrame:
    """``(pair, docs, best)`` over all texts; ``best`` marks the highest counts of each first id."""
    total = written(rows.groupBy("pair").agg(F.sum("docs").alias("docs")), "pairs").withColumn("a", F.shiftright("pair", LOW))
    most = total.groupBy("a").agg(F.max("docs").alias("most"))
    return written(total.join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pairs")


def pair_counts(documents: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(a, b, docs, best)``: in how many rows the ids ``a`` and ``b`` of both tokenizers are linked, and whether that is the most of any ``b``."""
    out = _totals(_pair_rows(_encoded(documents, json_path, model_path, id_col, text_col)))
    return out.select(F.shiftright("pair", LOW).alias("a"), F.col("pair").bitwiseAND(F.lit((1 << LOW) - 1)).alias("b"), "docs", "best")


_ALIGNED = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string"


def _answered(row: pa.RecordBatch, pair: np.ndarray, docs: np.ndarray, best: np.ndarray) -> pa.Table:
    """The texts of one chunk, by the counts of pairs, sorted, among which are all of the chunk's."""
    sizes, pieces, described, links = (pa.ipc.open_stream(row[c][0].as_buffer()).read_all() for c in ("sizes", "pieces", "lexicon", "links"))
    at = np.searchsorted(pair, row["pair"].flatten().to_numpy())[links["place"].to_numpy()]
    bounds, times = np.concatenate([[0], np.cumsum(described["links"].to_numpy())]), links["times"].to_numpy()
    by_piece = {c: described[c].to_numpy() for c in ("n_a", "n_b", "n_groups", "n_links")}
    for c, value in (("n_best", times * best[at]), ("count_sum", times * docs[at])):
        by_piece[c] = np.diff(np.concatenate([[0], np.cumsum(value)])[bounds])
    pieces, offsets = pieces["n"].to_numpy(), np.concatenate([[0], np.cumsum(sizes["n"].to_numpy())])
    sums = {c: np.diff(np.concatenate([[0], np.cumsum(v[pieces])])[offsets]) for c, v in by_piece.items()}
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pc.take(described["groups"].combine_chunks(), pa.array(pieces))), ";")
    return pa.table({"doc_id": row["ids"].flatten(), **{c: sums[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")}, "groups": texts})


def _by_sent_counts(encoded: DataFrame, totals: DataFrame) -> DataFrame:
    counts = totals.toArrow().sort_by("pair")  # SENT rows at most
    sent = encoded.sparkSession.sparkContext.broadcast([counts[c].to_numpy() for c in ("pair", "docs", "best")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield from _answered(batch.slice(k, 1), *sent.value).to_batches()
        give_back()

    return encoded.mapInArrow(run, _ALIGNED)


def _by_joined_counts(encoded: DataFrame, totals: DataFrame) -> DataFrame:
    answers = _pair_rows(encoded).select(F.col("chunk").alias("of"), "pair").join(totals, "pair")

    def run(chunk: pa.Table, own: pa.Table) -> pa.Table:
        own = own.sort_by("pair")
        done = _answered(chunk.combine_chunks().to_batches()[0], *(own[c].to_numpy() for c in ("pair", "docs", "best")))
        give_back()
        return done

    return encoded.groupBy("chunk").cogroup(answers.groupBy("of")).applyInArrow(run, _ALIGNED)


def align(documents: DataFrame, json_path: str, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``, one row per input row.

    A's tokens are those of the byte-level BPE file ``json_path`` for space + text, B's those of the sentencepiece
    model ``model_path`` for the text, which adds the space; strings of special tokens are plain text.  The places
    where tokens of both end cut the tokens into groups; ``groups`` writes them as ``a1,a2|b1;a3|b2,b3``.  Each
    token of A in a group is linked with each of B.  A pair of ids counts the rows that hold it linked;
    ``count_sum`` adds that over a row's links, ``n_best`` counts the links whose count is the highest of their A id.
    Null and empty texts, and those whose tokens' bytes differ from space + text, have no tokens: zeros and ''.
    Every row is a text of its own, so repeated and null ids stay as they are; ids are integers.  Texts are used
    whole, however long.  No rows give no rows; other columns do not matter.
    """
    encoded = _encoded(documents, json_path, model_path, id_col, text_col)
    totals = _totals(_pair_rows(encoded))
    return (_by_sent_counts if totals.count() <= SENT else _by_joined_counts)(encoded, totals)
