"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are context, and only its reply is
trainable.  Turns that no reply follows become one further example without a trainable part, so nothing of a
conversation is lost.

The template writes a turn as ``[role]text[/role]`` and ends a reply with ``</s>``.  In roles and texts each of
``\\ [ ] <`` is preceded by a backslash, so a text that spells out a mark cannot make one, and the way back is
to drop those backslashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ESCAPED = r"(?:[^\\\[\]<]|\\.)*+"
_TURN = re.compile(rf"\[({_ESCAPED})\]({_ESCAPED})\[/({_ESCAPED})\](?:</s>)?", re.S)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\\[\]<])", r"\\$1")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def format_chats(conversations: DataFrame) -> DataFrame:
    """``(conv_id, example, last, text, loss_start, loss_end)`` of ``conversations(conv_id, turn, role, text)``.

    The loss mask covers code points ``loss_start`` to ``loss_end`` of ``text``, both its length where nothing is
    trainable.  ``example`` counts from 0 within a conversation; the one marked ``last`` holds all turns.  Turns
    go by turn, then role, then text, nulls first; null roles and texts count as empty, null conv_id is an id
    like others.  Repeated rows are repeated turns.  Other columns do not matter; no rows give no rows.

    An example holds its whole context, so a conversation's output grows with the square of its turns, and each
    example, and so each conversation, must fit into a task's memory: the expansion asks for that.
    """
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))

    def piece(t: Column) -> Column:
        role, reply = escape(t["role"]), t["role"] == "assistant"
        tail = F.concat(F.lit("[/"), role, F.lit("]"), F.when(reply, F.lit("</s>")).otherwise(F.lit("")))
        return F.struct(reply.alias("reply"), F.concat(F.lit("["), role, F.lit("]")).alias("head"), escape(t["text"]).alias("body"), tail.alias("tail"))

    pieces = ordered.select("conv_id", F.transform("turns", piece).alias("pieces"))
    at = F.filter(F.sequence(F.lit(1), F.size("pieces")), lambda i: F.get("pieces", i - 1)["reply"] | (i == F.size("pieces")))
    rows = pieces.select("conv_id", "pieces", F.size(at).alias("examples"), F.posexplode(at).alias("example", "at"))
    before = F.array_join(F.transform(F.slice("pieces", F.lit(1), F.col("at") - 1), lambda p: F.concat(p["head"], p["body"], p["tail"])), "")
    rows = rows.select("conv_id", "example", (F.col("example") == F.col("examples") - 1).alias("last"), before.alias("before"), F.get("pieces", F.col("at") - 1).alias("p"))
    text = F.concat("before", "p.head", "p.body", "p.tail")
    start = F.length("before") + F.length("p.head")
    return rows.select(
        "conv_id", "example", "last", text.alias("text"),
        F.when(F.col("p.reply"), start).otherwise(F.length(text)).cast("bigint").alias("loss_start"),
        F.when(F.col("p.reply"), start + F.length("p.body")).otherwise(F.length(text)).cast("bigint").alias("loss_end"),
    )


def parse_chat(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted example; a text that the template cannot have made raises."""
    out, at = [], 0
    while at < len(text):
        turn = _TURN.match(text, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return out


def read_back(examples: DataFrame) -> DataFrame:
    """``(conv_id, example, chars, loss, n_turns, turns)`` read from formatted texts and masks alone.

    ``loss`` is the unescaped text under the mask; ``turns``, of last examples only, has role, line feed, text,
    line feed for each turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars, loss, n, turns = [], [], [], []
            for last, text, a, b in zip(*(batch[c].to_pylist() for c in ("last", "text", "loss_start", "loss_end")), strict=True):
                chars.append(len(text))
                loss.append(unescape(text[a:b]))
                found = parse_chat(text) if last else None
                n.append(None if found is None else len(found))
                turns.append(None if found is None else "".join(f"{r}\n{t}\n" for r, t in found))
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["example"], pa.array(chars, pa.int64()), pa.array(loss, pa.string()), pa.array(n, pa.int64()), pa.array(turns, pa.string())],
                names=["conv_id", "example", "chars", "loss", "n_turns", "turns"],
            )

    kind = examples.schema["conv_id"].dataType.simpleString()
    return examples.mapInArrow(run, f"conv_id {kind}, example int, chars bigint, loss string, n_turns bigint, turns string")
