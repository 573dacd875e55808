"""Chat formatting in budgeted, turn-aligned windows with a loss mask.

Prefix sums of turn tokens place every turn: with a step T, the turns that begin in [wT, (w + 1)T) form
window w, and one longer than T has a window of its own. T is half of what the budget leaves beside the
history and the system turn, so only a single turn that is too long can break the budget. Every window repeats the system
turn that opens the conversation and, before its own turns, the longest run of earlier turns of at
most ``history`` tokens. Repeated turns carry no loss: each assistant text is a target exactly once.

Sums go over chunks of turns first and then within a chunk, so a conversation with a third of all
turns is spread over many tasks; a task holds one window at most.

Template: ``<turn ROLE>``, newline, text, newline, ``</turn>``, newline. In texts and roles a backslash
is doubled and ``<turn`` and ``</turn`` get one in front; in roles, also ``>``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.llm.mixing import words
from stayline.llm.store import small_batches

BUDGET = 512
HISTORY = 96
SYSTEM = 64  # room for the system turn where it is repeated
MARKERS = 4  # tokens of a turn's markers
CHUNK = 64  # turn numbers that are summed together first
CONTROLS = ("<turn", "</turn")
TARGET = "assistant"


def escape(text: Column, *more: str) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (*CONTROLS, *more):
        text = F.replace(text, F.lit(control), F.lit("\\" + control))
    return text


_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"<turn ((?:[^\\>]|\\.)*)>\n((?:[^\\]|\\.)*?)\n</turn>\n", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def read_window(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def placed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, tokens, nth (place in the conversation), start (tokens before)."""
    rows = turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("tokens", words(F.col("text")) + MARKERS).withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    sums = rows.groupBy("conv_id", "chunk").agg(F.sum("tokens").alias("all_tokens"), F.count("*").alias("all_rows"))
    line = Window.partitionBy("conv_id").orderBy("chunk")
    bases = sums.select(
        F.col("conv_id").alias("c"),
        F.col("chunk").alias("k"),
        (F.sum("all_tokens").over(line) - F.col("all_tokens")).alias("base_tokens"),
        (F.sum("all_rows").over(line) - F.col("all_rows")).alias("base_rows"),
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text")
    before = F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens")
    rows = rows.withColumn("before", before).withColumn("row", F.row_number().over(inside) - 1)
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("chunk").eqNullSafe(F.col("k"))
    rows = rows.join(bases, same)
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        "tokens",
        (F.col("base_rows") + F.col("row")).alias("nth"),
        (F.col("base_tokens") + F.col("before")).alias("start"),
    )


def format_windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, system_room: int = SYSTEM) -> DataFrame:
    """conv_id, window, first_nth, n_turns, n_repeated, tokens, over_budget, formatted, loss_spans.

    One row per window; ``n_repeated`` turns at its beginning are the system turn and history;
    ``loss_spans`` are [begin, end) in code points of ``formatted``. Turns are ordered by turn, then
    role and text, nulls first; a null role or text counts as empty; rows without a conv_id form one
    conversation. The system turn is a first turn with role ``system``. Other columns are ignored.
    """
    step = (budget - history - system_room) // 2
    if history > step:
        raise ValueError("the budget leaves too little beside history and system turn")
    rows = placed(turns)
    system = rows.where("nth = 0 and role = 'system'").select(
        F.col("conv_id").alias("c"), F.struct("nth", "role", "text", "tokens").alias("system")
    )
    long = (F.col("tokens") > step).cast("int")
    rows = rows.withColumn("window", F.floor(F.col("start") / step) * 2 + long)
    opens = rows.groupBy("conv_id", "window").agg(F.min("start").alias("opens"))
    own = rows.select("conv_id", "window", "nth", "role", "text", "tokens", F.lit(False).alias("repeated"))
    # A turn of window w can only be history of the long turn beside it or of the next two windows.
    earlier = rows.where("window % 2 = 0").withColumn("later", F.explode(F.expr("sequence(window + 1, window + 3)")))
    at = opens.select(F.col("conv_id").alias("c"), F.col("window").alias("w"), "opens")
    near = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("later") == F.col("w")) & (F.col("start") < F.col("opens")) & (F.col("opens") - F.col("start") <= history)
    repeats = earlier.join(at, near).select(
        "conv_id", F.col("later").alias("window"), "nth", "role", "text", "tokens", F.lit(True).alias("repeated")
    )
    kept = opens.join(system, F.col("conv_id").eqNullSafe(F.col("c"))).where(F.col("opens") > history)
    # Within reach of the history, or in its first window, the system turn is there already.
    kept = kept.select("conv_id", "window", "system.*", F.lit(True).alias("repeated"))
    shown = own.unionByName(repeats).unionByName(kept)
    head = F.concat(F.lit("<turn "), escape(F.col("role"), ">"), F.lit(">\n"))
    shown = shown.withColumn("head", head).withColumn("body", escape(F.col("text")))
    shown = shown.withColumn("segment", F.concat("head", "body", F.lit("\n</turn>\n"))).withColumn("size", F.length("segment"))
    order = Window.partitionBy("conv_id", "window").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shown = shown.withColumn("begin", F.sum("size").over(order) - F.col("size") + F.length("head"))
    is_target = ~F.col("repeated") & (F.col("role") == TARGET)
    span = F.when(is_target, F.struct(F.col("begin").alias("begin"), (F.col("begin") + F.length("body")).alias("end")))
    return shown.groupBy("conv_id", "window").agg(
        F.min("nth").alias("first_nth"),
        F.count("*").alias("n_turns"),
        F.count_if("repeated").alias("n_repeated"),
        F.sum("tokens").alias("tokens"),
        (F.sum("tokens") > budget).alias("over_budget"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("nth", "segment"))), lambda s: s["segment"]), "").alias("formatted"),
        F.sort_array(F.collect_list(span)).alias("loss_spans"),
    )


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows sorted by conversation in, a digest of each conversation out; holds one window."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
    )
    state = None

    def done(s):
        return (s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5])

    for batch in batches:
        out = []
        for conv, repeated, formatted, spans in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
            if state is None or state[0] != conv:
                if state is not None:
                    out.append(done(state))
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_window(formatted)[repeated:]:
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for span in spans:
                text = unescape(formatted[span["begin"] : span["end"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(list(zip(*out, strict=True)) or [()] * 6, schema, strict=True)], schema=schema)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(done(state), schema, strict=True)], schema=schema)


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from the windows.

    A digest of a whole conversation is one pass over its windows in order, so they meet in one task,
    which holds one window at a time.
    """
    rows = small_batches(windows).select("conv_id", "window", "n_repeated", "formatted", "loss_spans")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(_read_back, kinds)
