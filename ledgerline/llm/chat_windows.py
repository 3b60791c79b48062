"""Chat formatting into budgeted, turn-aligned windows.

Turns become ``<|im_start|>role`` newline ``text<|im_end|>`` newline.  Control
strings inside roles and texts are broken up by an escape that can be undone,
so a text can never open or close a turn of its own.

A running sum of turn tokens cuts a conversation into windows of whole turns
within a token budget.  Every later window starts with the system turn (if the
conversation opens with one) and the last turns of the window before, within
limits of their own; these repeated turns are never under the loss mask.  New
assistant texts are, so each is trained on exactly once.

Escaping and token counts are column expressions.  The windows of one
conversation follow from one another, so turns are hashed on the conversation,
sorted by Spark (which spills) and streamed through an Arrow iterator that
holds one window at a time, however long the conversation.

Defined cases: null text and null role are empty; turns with equal numbers
follow in the order of role and text, repeated rows are turns of their own; a
null conversation id is a conversation, a null turn number comes first; a turn
over the budget gets a window of its own, uncut; a window may pass the budget
only by the system turn and one turn; extra columns are ignored; an empty
table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import split_words, text_of

START, END = "<|im_start|>", "<|im_end|>"
# Control strings of common chat templates, fixed values; none may reach the output unescaped.
CONTROL = ["<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<s>", "</s>",
           "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_CONTROL_RE = "(" + "|".join(re.escape(c[0]) for c in sorted({c[0] for c in CONTROL})) + ")(?=" + "|".join(
    re.escape(c[1:]) for c in CONTROL) + ")"
_TURN_RE = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_UNESCAPE_RE = re.compile(r"\\(.)", re.S)
_UNESCAPED = {"\\": "\\", ":": "", "n": "\n"}

WINDOW_SCHEMA = ("conv_id {id}, window bigint, n_turns bigint, n_repeated bigint, n_tokens bigint, text string, "
                 "loss array<struct<start:bigint,end:bigint>>")


def escape(text: Column) -> Column:
    """Backslashes double, and a backslash-colon goes behind the first
    character of each control string."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL_RE, r"$1\\:")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return _UNESCAPE_RE.sub(lambda m: _UNESCAPED.get(m[1], m[0]), text)


def default_tokens(text: Column) -> Column:
    """Words plus four for the turn's frame."""
    return F.size(split_words(text)) + 4


class _Packer:
    """Windows of one conversation after another."""

    def __init__(self, budget: int, history_turns: int, history_tokens: int):
        self.budget, self.history_turns, self.history_tokens = budget, history_turns, history_tokens
        self.conv: object = None
        self.open = False

    def _begin(self) -> None:
        self.system, self.window, self.turns, self.repeated, self.tokens = None, 0, [], 0, 0
        self.recent: deque = deque(maxlen=max(self.history_turns, 1))

    def add(self, conv, role: str, text: str, tokens: int):
        """Yield the windows that are complete once this turn is known."""
        if not self.open or conv != self.conv:
            yield from self.close()
            self.conv, self.open = conv, True
            self._begin()
            if role == "system":
                self.system = (role, text, tokens)
        if len(self.turns) > self.repeated and self.tokens + tokens > self.budget:
            yield self._emit()
            self._carry(tokens)
        self.turns.append((role, text, tokens))
        self.tokens += tokens
        self.recent.append((role, text, tokens))

    def _carry(self, coming: int) -> None:
        """Open the next window with the system turn and limited history."""
        self.window += 1
        self.turns = [self.system] if self.system else []
        self.tokens = sum(t[2] for t in self.turns)
        room = min(self.history_tokens, self.budget - self.tokens - coming)
        kept: list = []
        for turn in reversed(self.recent):
            if len(kept) == self.history_turns or turn[2] > room or turn is self.system:
                break
            kept.append(turn)
            room -= turn[2]
        self.turns += reversed(kept)
        self.tokens += sum(t[2] for t in kept)
        self.repeated = len(self.turns)

    def _emit(self):
        parts, loss, at = [], [], 0
        for i, (role, text, _) in enumerate(self.turns):
            head = f"{START}{role}\n"
            if i >= self.repeated and role == "assistant":
                loss.append({"start": at + len(head), "end": at + len(head) + len(text)})
            part = f"{head}{text}{END}\n"
            parts.append(part)
            at += len(part)
        return (self.conv, self.window, len(self.turns), self.repeated, self.tokens, "".join(parts), loss)

    def close(self):
        if self.open:
            yield self._emit()
        self.open = False


def _batches(rows: Iterator, schema: pa.Schema, at_once: int = 256) -> Iterator[pa.RecordBatch]:
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _window_arrow(id_type: pa.DataType) -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.schema([("conv_id", id_type), ("window", pa.int64()), ("n_turns", pa.int64()),
                      ("n_repeated", pa.int64()), ("n_tokens", pa.int64()), ("text", pa.string()),
                      ("loss", pa.list_(span))])


def format_windows(turns: DataFrame, budget: int = 1024, history_turns: int = 2, history_tokens: int = 256,
                   tokens: Column | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per window: conv_id, window, n_turns, n_repeated (leading turns
    that repeat earlier ones), n_tokens, text, loss (spans of ``text`` in code
    points)."""
    n_tokens = default_tokens(F.col(text_col)) if tokens is None else tokens
    src = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                       escape_role(text_of(F.col(role_col))).alias("role"),
                       escape(text_of(F.col(text_col))).alias("text"), n_tokens.cast("long").alias("n_tokens"))
    src = (src.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
           .select("conv_id", "role", "text", "n_tokens"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(budget, history_turns, history_tokens)
        first = next(batches, None)
        if first is None:
            return

        def windows():
            b = first
            while b is not None:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    yield from packer.add(*row)
                b = next(batches, None)
            yield from packer.close()

        yield from _batches(windows(), _window_arrow(first.schema.field(0).type))

    return src.mapInArrow(pack, WINDOW_SCHEMA.format(id=src.schema["conv_id"].dataType.simpleString()))


def read_window(text: str, n_repeated: int, loss: list[dict]) -> tuple[list[tuple[str, str]], list[str]]:
    """The new turns of a window and its texts under the loss mask, unescaped."""
    turns = [(unescape(r), unescape(t)) for r, t in _TURN_RE.findall(text)[n_repeated:]]
    return turns, [unescape(text[s["start"]:s["end"]]) for s in loss]


def read_back(windows: DataFrame) -> DataFrame:
    """Digests per conversation, read from the windows as ``format_windows``
    returned them (same partition and order): conv_id, n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars, n_windows."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema = pa.schema([("conv_id", first.schema.field(0).type), ("n_turns", pa.int64()),
                            ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                            ("formatted_chars", pa.int64()), ("n_windows", pa.int64())])

        def rows():
            b, conv, state = first, None, None
            while b is not None:
                cols = {n: b.column(n).to_pylist() for n in ("conv_id", "n_repeated", "text", "loss")}
                for cid, rep, text, loss in zip(cols["conv_id"], cols["n_repeated"], cols["text"], cols["loss"]):
                    if state is None or cid != conv:
                        if state is not None:
                            yield (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:])
                        conv, state = cid, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                    turns, masked = read_window(text, rep, loss)
                    for role, said in turns:
                        state[1].update(f"{role}\n{said}\n".encode())
                    for said in masked:
                        state[3].update(said.encode())
                        state[2] += len(said)
                    state[0] += len(turns)
                    state[4] += len(text)
                    state[5] += 1
                b = next(batches, None)
            if state is not None:
                yield (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), *state[4:])

        yield from _batches(rows(), schema)

    kind = windows.schema["conv_id"].dataType.simpleString()
    return windows.mapInArrow(digest, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                      "loss_sha256 string, formatted_chars bigint, n_windows bigint")
