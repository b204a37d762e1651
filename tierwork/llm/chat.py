"""Chat formatting in budgeted windows of whole turns.

The turns of a conversation are put in order and their tokens counted; prefix sums
of the counts choose the windows. A window begins with the system turn (the first
turn, where its role is ``system``), then repeats up to HISTORY tokens of whole
turns from before, then takes new turns while the total stays within the budget.
Every turn is new in exactly one window. What a window repeats is never under its
loss mask; the texts of its new assistant turns are.

The template writes a user turn as ``[INST]text[/INST]``, an assistant turn as
``[OUT]text</s>``, and any other as ``[ROLE]role[/ROLE]text</s>``; windows begin
with ``<s>``. A control string inside a text or a role gets a backslash before it,
and a backslash gets another, so texts read back as they were.

A conversation is read as a stream of sorted rows: only the system turn, the
repeated turns and the open window are held, whatever its length. Its digest is
one chain over its turns, so one conversation stays in one task.

Defined cases: NULL text or role is empty; NULL conv_id is a conversation of its
own; a NULL turn comes first. Repeated rows and equal turn numbers are all kept,
ordered by role and text. A turn that alone exceeds the budget is never cut: it
gets a window of its own, whose ``tokens`` shows the excess. A system turn of more
than half the budget would fill the windows it is repeated in, so it stands in the
first window only. Tokens are counted by a byte-pair
vocabulary where its path is given (the driver reads the file, up to VOCABULARY_MB,
and broadcasts it), else as UTF-8 bytes / 4, rounded up. Other columns are ignored;
no turns give no windows.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import query, table

BUDGET = 1024
HISTORY = 192
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[ROLE]", "[/ROLE]")
_CONTROL = "|".join(map(re.escape, CONTROL))
_ESCAPE = re.compile(rf"\\|(?={_CONTROL})")
_MARK = re.compile(rf"\\.|({_CONTROL})", re.S)
_PLAIN = re.compile(r"\\(.)", re.S)
MARKS = 4       # tokens that the template adds to a turn
OPEN = 64       # turns cut into windows at once
VOCABULARY_MB = 16


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m.group() else "\\", text)


def unescape(text: str) -> str:
    return _PLAIN.sub(r"\1", text)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    """What stands before, the escaped text, and what stands after."""
    if role == "user":
        return "[INST]", escape(text), "[/INST]"
    if role == "assistant":
        return "[OUT]", escape(text), "</s>"
    return f"[ROLE]{escape(role)}[/ROLE]", escape(text), "</s>"


def read_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start, end) of the turns of a formatted window; start and end
    bound the escaped text."""
    role, begin = None, 0
    for m in _MARK.finditer(formatted):
        mark = m.group(1)
        if mark is None or mark == "<s>":
            continue
        if mark in ("[INST]", "[OUT]"):
            role, begin = ("user" if mark == "[INST]" else "assistant"), m.end()
        elif mark == "[ROLE]":
            begin = m.end()
        elif mark == "[/ROLE]":
            role, begin = unescape(formatted[begin:m.start()]), m.end()
        else:
            yield role, unescape(formatted[begin:m.start()]), begin, m.start()


class _Conversation:
    """State of the stream over one conversation."""

    def __init__(self, conv_id, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system: tuple | None = None
        self.before: list[tuple] = []       # turns that the next window may repeat
        self.waiting: list[tuple] = []      # turns without a window yet
        self.window = self.seen = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[dict]:
        turn = (role, text, tokens + MARKS)
        self.waiting.append(turn)
        self.seen += 1
        if self.seen == 1 and role == "system":
            self.system = turn
        if len(self.waiting) >= OPEN:
            yield from self.cut(last=False)

    def cut(self, last: bool) -> Iterator[dict]:
        """Windows over the waiting turns; the last one stays open unless ``last``."""
        while self.waiting:
            repeated = [self.system] if self.system and self.window and 2 * self.system[2] <= self.budget else []
            ends = [0]      # prefix sums of the waiting turns
            for _, _, n in self.waiting:
                ends.append(ends[-1] + n)
            back = [0]      # and of those before, from the latest on
            for _, _, n in reversed(self.before):
                back.append(back[-1] + n)
            base = sum(n for _, _, n in repeated)
            room = self.budget - base - self.waiting[0][2]      # the first new turn has to fit
            k = max(0, bisect_right(back, min(self.history, max(0, room))) - 1)
            repeated += self.before[len(self.before) - k:]
            base += back[k]
            take = max(1, bisect_right(ends, self.budget - base) - 1)
            if take >= len(self.waiting) and not last:
                return
            new, self.waiting = self.waiting[:take], self.waiting[take:]
            yield self.made(repeated, new, base + ends[take])
            kept = self.before + [t for t in new if t is not self.system]
            total = [0]
            for _, _, n in reversed(kept):
                total.append(total[-1] + n)
            self.before = kept[len(kept) - (bisect_right(total, self.history) - 1):] if kept else []
            self.window += 1

    def made(self, repeated: list, new: list, tokens: int) -> dict:
        parts, at, spans, fresh_from = ["<s>"], 3, [], 3
        for k, (role, text, _) in enumerate(repeated + new):
            head, body, tail = turn_parts(role, text)
            if k == len(repeated):
                fresh_from = at
            at += len(head)
            if k >= len(repeated) and role == "assistant":
                spans.append((at, at + len(body)))
            at += len(body) + len(tail)
            parts += (head, body, tail)
        return {"conv_id": self.conv_id, "window": self.window, "text": "".join(parts), "fresh_from": fresh_from,
                "loss": [{"start": a, "end": b} for a, b in spans], "tokens": tokens, "new_turns": len(new)}


def vocabulary_bytes(path: str | None) -> bytes | None:
    """A vocabulary file, read where the job is planned."""
    if path is None:
        return None
    if os.path.getsize(path) > VOCABULARY_MB << 20:
        raise ValueError(f"the vocabulary exceeds {VOCABULARY_MB} MB and can't be broadcast")
    with open(path, "rb") as f:
        return f.read()


def counter(vocabulary: bytes | None):
    """Token counts of a list of texts."""
    if vocabulary is None:
        return lambda texts: [-(-len(t.encode("utf-8", "replace")) // 4) for t in texts]
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    coder = tiktoken.Encoding("turns", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return lambda texts: [len(x) for x in coder.encode_ordinary_batch(texts, num_threads=1)]


def format_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, vocabulary: str | None = None,
    conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Windows of ``turns``: conv_id, window, text, fresh_from (offset of the first
    turn that is not repeated), loss (spans of offsets), tokens, new_turns."""
    if budget < 1 or not 0 <= history < budget:
        raise ValueError("the budget must be positive and exceed the history")
    rows = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    shared = turns.sparkSession.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    def run(batches):
        count, open_conv, out, size = counter(shared.value), None, [], 0
        for batch in batches:
            roles, texts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for conv_id, r, t, n in zip(batch.column(0).to_pylist(), roles, texts, count(texts)):
                if open_conv is None or open_conv.conv_id != conv_id:
                    if open_conv is not None:
                        out += open_conv.cut(last=True)
                    open_conv = _Conversation(conv_id, budget, history)
                out += open_conv.add(r, t, n)
                size += len(t)
                if size > 4_000_000:
                    yield pa.RecordBatch.from_pylist(out, schema=shape)
                    out, size = [], 0
        if open_conv is not None:
            out += open_conv.cut(last=True)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=shape)

    kind = to_arrow_type(rows.schema["conv_id"].dataType)
    shape = pa.schema([
        ("conv_id", kind), ("window", pa.int32()), ("text", pa.string()), ("fresh_from", pa.int64()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("tokens", pa.int64()), ("new_turns", pa.int32())])
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(
        run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, window int, text string, fresh_from long, "
             "loss array<struct<start:long,end:long>>, tokens long, new_turns int")


def digests(windows: DataFrame) -> DataFrame:
    """What a reader of the windows finds, by conversation."""
    kind = windows.schema["conv_id"].dataType

    def run(batches):
        state, out = None, []

        def close():
            conv_id, turns, all_turns, masked, loss, chars = state
            out.append((conv_id, turns, all_turns.hexdigest(), masked, loss.hexdigest(), chars))

        def made():
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state is not None:
                        close()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text, starts = row["text"], [s["start"] for s in row["loss"]]
                state[5] += len(text)
                for role, plain, begin, _ in read_turns(text):
                    if begin >= row["fresh_from"]:
                        state[1] += 1
                        state[2].update(f"{role}\n{plain}\n".encode("utf-8", "replace"))
                for span in row["loss"]:
                    plain = unescape(text[span["start"]:span["end"]])
                    state[3] += len(plain)
                    state[4].update(plain.encode("utf-8", "replace"))
            if len(out) > 10_000:
                yield made()
                out.clear()
        if state is not None:
            close()
        yield made()

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [to_arrow_type(kind), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    ordered = windows.select("conv_id", "window", "text", "fresh_from", "loss").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(
        run, f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def vocabulary_path() -> str | None:
    """The byte-pair vocabulary of the installed public tokenizers, if there is one."""
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    return path if os.path.exists(path) else None


@query()
def op10_chat_windows(spark, folder):
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(format_windows(turns, vocabulary=vocabulary_path()))
