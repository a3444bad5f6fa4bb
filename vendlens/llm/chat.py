"""Operator 5: conversations as training windows of a token budget, with a loss mask.

A conversation becomes windows, each a text of at most `budget` tokens made of whole turns:

    system turn | repeated history | new turns

Every turn is new in exactly one window.  Prefix sums of the turns' tokens choose the spans:
first the history, the longest run of turns before the new ones within `history` tokens that
leaves room for the next turn, then as many new turns as still fit.  A first turn of role
`system` leads every window.  A turn larger than the budget has a window of its own, without
repeats, and that window is larger than the budget.  Repeated turns are masked, so each
assistant text is under the loss mask once.

Prefix sums run over chunks of turns, and the greedy choice over blocks of `BLOCK` budgets of
tokens (one window per block may be left part empty), so one conversation may be of any
length: no task or group holds all of it.  Turns near a block's start and the system turn are
copied to the next block.

The template writes a turn as <s>[ROLE]role[/ROLE]text</s> and a line end.  Inside role and
text, a backslash is doubled, and a backslash follows every < and [, which breaks all control
strings; `unescape` reverses this.

Defined results: null role or text is the empty text.  Turns are ordered by turn number (null
first), then role, then text; repeated rows are turns of their own.  Rows with a null
conversation id form one conversation.  An empty table gives no windows.  Other columns of
the input are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from vendlens.llm.bpe import _codec, vocabulary
from vendlens.llm.common import slices

BUDGET = 2048        # tokens of a window
HISTORY = 512        # most tokens of repeated history
BLOCK = 64           # budgets of a block
TURNS_PER_CHUNK = 1024
ROWS = 1024
LOSS_ROLE = "assistant"

# The template.
OPEN, ROLE_OPEN, ROLE_CLOSE, CLOSE = "<s>", "[ROLE]", "[/ROLE]", "</s>\n"
_TURN = re.compile(r"<s>\[ROLE\](.*?)\[/ROLE\](.*?)</s>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\\\|<\\|\[\\")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda found: found[0][0], text)


def turn_text(role: str, text: str) -> str:
    return f"{OPEN}{ROLE_OPEN}{escape(role)}{ROLE_CLOSE}{escape(text)}{CLOSE}"


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted window."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


# ---------------------------------------------------------------- tokens and prefix sums


def _with_tokens(turns: DataFrame, path: str) -> DataFrame:
    """Adds the number of tokens of each formatted turn."""
    shared = vocabulary(turns, path)
    names = turns.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value)
        for batch in slices(batches, ROWS):
            pairs = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            tokens = [len(codec.encode(turn_text(role, text))) // 4 for role, text in pairs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tokens, pa.int64())], [*names, "tokens"]
            )

    schema = T.StructType([*turns.schema, T.StructField("tokens", T.LongType())])
    return turns.mapInArrow(run, schema)


def _with_positions(turns: DataFrame) -> DataFrame:
    """Adds `pos`, the place in the conversation, and `before`, the tokens before the turn.

    A chunk has `TURNS_PER_CHUNK` turn numbers; within chunks and over chunks, sums are
    windows, so no window holds a conversation's turns.
    """
    chunked = turns.withColumn("chunk", F.floor(F.col("turn") / TURNS_PER_CHUNK))
    over = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = chunked.groupBy("conv_id", "chunk").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("turns")
    ).select(
        F.col("conv_id").alias("c"), F.col("chunk").alias("k"),
        F.coalesce(F.sum("tokens").over(over), F.lit(0)).alias("tokens_before"),
        F.coalesce(F.sum("turns").over(over), F.lit(0)).alias("turns_before"),
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    rows = inside.rowsBetween(Window.unboundedPreceding, 0)
    return chunked.withColumns({
        "nth": F.row_number().over(inside), "sum": F.sum("tokens").over(rows),
    }).join(
        totals, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("chunk").eqNullSafe(F.col("k"))
    ).select(
        "conv_id", "role", "text", "tokens",
        (F.col("turns_before") + F.col("nth")).cast("long").alias("pos"),
        (F.col("tokens_before") + F.col("sum") - F.col("tokens")).alias("before"),
    )


# ---------------------------------------------------------------- windows


def _spans(tokens: list[int], system: int, old: int, budget: int, history: int):
    """(first repeated, first new, after the last) of each window of a block.

    tokens: of the turns copied from the block before (`old` many), then of its own turns.
    """
    total = [0]
    for n in tokens:
        total.append(total[-1] + n)
    start = old
    while start < len(tokens):
        first, end = start, start + 1
        room = budget - system
        while first and total[start] - total[first - 1] <= history \
                and total[end] - total[first - 1] <= room:
            first -= 1
        while end < len(tokens) and total[end + 1] - total[first] <= room:
            end += 1
        yield first, start, end
        start = end


def windows(conversations: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY
            ) -> DataFrame:
    """Rows of a window: conv_id, block, window, n_tokens, n_repeated, text, loss.

    `loss` lists the (start, length) in code points of what is under the mask; the first
    `n_repeated` turns of the text are in an earlier window as new ones.
    """
    turns = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")],
    )
    placed = _with_positions(_with_tokens(turns, path))
    width = F.lit(BLOCK * budget)
    block = F.floor(F.col("before") / width)
    to_next = (block + 1) * width - F.col("before")
    own = F.struct(block.alias("block"), F.lit(2).alias("kind"))
    copy = F.struct((block + 1).alias("block"), F.lit(1).alias("kind"))
    # The system turn is not history, it leads every window.
    is_system = (F.col("pos") == 1) & (F.col("role") == "system")
    repeats: Column = F.when(
        (to_next <= history) & ~is_system, F.array(own, copy)
    ).otherwise(F.array(own))
    spread = placed.select("*", F.inline(repeats))
    lead = spread.where(is_system & (F.col("kind") == 2))
    later = spread.where((F.col("kind") == 2) & (F.col("block") > 0)).select(
        F.col("conv_id").alias("c"), F.col("block").alias("later_block")
    ).distinct()
    leads = lead.join(later, F.col("conv_id").eqNullSafe(F.col("c"))).select(
        "conv_id", "role", "text", "tokens", "pos", F.col("later_block").alias("block"),
        F.lit(0).alias("kind"),
    )
    columns = ["conv_id", "block", "pos", "kind", "role", "text", "tokens"]
    rows = spread.select(*columns).unionByName(leads.select(*columns))
    ordered = rows.repartition("conv_id", "block").sortWithinPartitions(
        "conv_id", "block", "kind", "pos"
    )
    id_type = conversations.schema["conv_id"].dataType
    arrow_type = to_arrow_type(id_type)
    schema = T.StructType([
        T.StructField("conv_id", id_type), T.StructField("block", T.LongType()),
        T.StructField("window", T.IntegerType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_repeated", T.IntegerType()), T.StructField("text", T.StringType()),
        T.StructField("loss", T.ArrayType(T.StructType([
            T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        ]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        for _, group in groupby(_rows(batches), lambda r: (r["conv_id"], r["block"])):
            made.extend(_block_windows(list(group), budget, history))
            if len(made) >= ROWS:
                yield _window_batch(made, arrow_type)
                made = []
        if made:
            yield _window_batch(made, arrow_type)

    return ordered.mapInArrow(run, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in slices(batches, ROWS):
        yield from batch.to_pylist()


def _window_batch(made: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    kinds = {
        "block": pa.int64(), "window": pa.int32(), "n_tokens": pa.int64(),
        "n_repeated": pa.int32(), "text": pa.string(),
        "loss": pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])),
    }
    return pa.RecordBatch.from_arrays(
        [pa.array([m["conv_id"] for m in made], id_type)]
        + [pa.array([m[name] for m in made], kind) for name, kind in kinds.items()],
        ["conv_id", *kinds],
    )


def _block_windows(rows: list[dict], budget: int, history: int) -> Iterator[dict]:
    """The windows of one block; rows: system turn of an earlier block, history, own turns."""
    copied = [r for r in rows if r["kind"] == 0]
    own = [r for r in rows if r["kind"] == 2]
    if not copied and own and own[0]["pos"] == 1 and own[0]["role"] == "system":
        copied, own, first_block = own[:1], own[1:], True
    else:
        first_block = False
    system = copied[0] if copied else None
    old = [r for r in rows if r["kind"] == 1]
    turns = old + own
    lead = system["tokens"] if system else 0
    spans = list(_spans([t["tokens"] for t in turns], lead, len(old), budget, history))
    if system and first_block and not spans:
        spans = [(0, 0, 0)]  # a conversation of a system turn only
    for number, (first, start, end) in enumerate(spans):
        alone = end - start == 1 and lead + turns[start]["tokens"] > budget
        new_system = system and first_block and number == 0
        shown = ([system] if system and (new_system or not alone) else []) + turns[first:end]
        repeated = (start - first) + bool(shown and shown[0] is system and not new_system)
        parts, loss, at = [], [], 0
        for place, turn in enumerate(shown):
            text = turn_text(turn["role"], turn["text"])
            if place >= repeated and turn["role"] == LOSS_ROLE:
                inner = len(escape(turn["text"]))
                loss.append({"start": at + len(text) - len(CLOSE) - inner, "length": inner})
            parts.append(text)
            at += len(text)
        yield {
            "conv_id": rows[0]["conv_id"], "block": rows[0]["block"], "window": number,
            "n_tokens": sum(t["tokens"] for t in shown), "n_repeated": repeated,
            "text": "".join(parts), "loss": loss,
        }


# ---------------------------------------------------------------- reading back


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, what its windows hold: turns, text under the mask, characters.

    Windows stream through in order, so a conversation of any length needs little memory.
    """
    id_type = formatted.schema["conv_id"].dataType
    arrow_type = to_arrow_type(id_type)
    ordered = formatted.select(
        "conv_id", "block", "window", "n_repeated", "text", "loss"
    ).repartition("conv_id").sortWithinPartitions("conv_id", "block", "window")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for conv_id, group in groupby(_rows(batches), lambda r: r["conv_id"]):
            turns, loss = hashlib.sha256(), hashlib.sha256()
            n_turns = loss_chars = chars = 0
            for row in group:
                text = row["text"]
                chars += len(text)
                for role, said in read_turns(text)[row["n_repeated"]:]:
                    turns.update(f"{role}\n{said}\n".encode())
                    n_turns += 1
                for span in row["loss"]:
                    said = unescape(text[span["start"]:span["start"] + span["length"]])
                    loss.update(said.encode())
                    loss_chars += len(said)
            values = [n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars]
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv_id], arrow_type), *[pa.array([v]) for v in values]], [
                "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                "formatted_chars",
            ])

    return ordered.mapInArrow(
        run, f"conv_id {id_type.simpleString()}, n_turns long, turns_sha256 string, loss_chars long,"
        " loss_sha256 string, formatted_chars long"
    )
