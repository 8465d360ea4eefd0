"""Chat formatting around a black-box template: turn spans are found by rendering successive prefixes.

The template is any function from messages to text. The output for each prefix of a conversation is compared
with the one before: what was added is the span of the new turn; if the earlier output is not kept as it was,
the template rewrites history. Nothing else is assumed about it, so the spans hold for templates that add
separators, number turns or drop empty ones.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Message = dict[str, str]

#: Marks of the built-in template, fixed values. Inside texts and roles they are escaped.
START, END = "<|im_start|>", "<|im_end|>"
_CONTROL = re.compile(r"<(\\*)(\|im_(?:start|end)\|>)")
_ESCAPED = re.compile(r"<\\(\\*)(\|im_(?:start|end)\|>)")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)
#: Private-use characters; one that the output does not hold stands in for a text to see what surrounds it.
_PROBES = [chr(c) for c in range(0xE000, 0xF8FF)]


@dataclass(frozen=True)
class Template:
    """``render`` maps messages to text; ``lookback`` is how many earlier messages a turn's output depends on.

    With ``lookback`` None every prefix is rendered whole. Otherwise the first ``trial`` prefixes of a conversation
    are, and later ones from ``lookback`` messages before their last on, which bounds time and memory for
    conversations of any length. A declaration gives up this much: a turn beyond ``trial`` that changes output of
    more than ``lookback`` turns before it is not seen to do so. With a ``lookback`` of 0 nothing is compared there.
    """

    render: Callable[[list[Message]], str]
    lookback: int | None = None
    trial: int = 6


def escape(text: str) -> str:
    """Puts one more backslash into anything that reads as a control string, escaped ones included."""
    return _CONTROL.sub(lambda m: f"<\\{m[1]}{m[2]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: f"<{m[1]}{m[2]}", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("%", "%25").replace("\n", "%0A")


def _unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def render_turns(messages: list[Message]) -> str:
    """The built-in template: a marked line with the role, the text, an end mark."""
    return "".join(f"{START}{_escape_role(m['role'])}\n{escape(m['text'])}{END}\n" for m in messages)


TURNS = Template(render_turns, lookback=1)


def read_turns(formatted: str) -> Iterator[tuple[str, str, int, int]]:
    """Role and text of each turn of the built-in template's output, unescaped, and where the text stands."""
    at = 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        yield _unescape_role(turn[1]), unescape(turn[2]), turn.start(2), turn.end(2)
        at = turn.end()


@dataclass
class _State:
    """What is kept of a conversation while its turns stream by."""

    messages: list[Message]
    before: str = ""
    length: int = 0
    seen: int = 0


def _added(template: Template, state: _State, message: Message) -> tuple[str, bool]:
    """What the next message adds to the output, and whether the output before it was changed.

    Leaves in ``state.length`` where the addition begins in the output of the whole conversation.
    """
    whole = template.lookback is None or state.seen < template.trial
    state.seen += 1
    if not whole:
        state.messages = state.messages[len(state.messages) - template.lookback :] if template.lookback else []
        state.before = template.render(state.messages) if state.messages else ""
    state.messages.append(message)
    before, state.before = state.before, template.render(state.messages)
    kept = state.before.startswith(before)
    if not kept:
        before = os.path.commonprefix([before, state.before])
    if whole:
        state.length = len(before)
    return state.before[len(before) :], not kept


def _text_span(template: Template, state: _State) -> tuple[int, int] | None:
    """Where the last message's text stands in the output, from what a probe in its place is surrounded by.

    None if the template drops the probe, repeats it, or writes something else around the text itself.
    """
    probe = next(c for c in _PROBES if c not in state.before and all(c not in m["role"] for m in state.messages))
    head, *tail = template.render([*state.messages[:-1], {**state.messages[-1], "text": probe}]).split(probe)
    whole = state.before
    if len(tail) != 1 or len(head) + len(tail[0]) > len(whole) or not (whole.startswith(head) and whole.endswith(tail[0])):
        return None
    return len(head), len(whole) - len(tail[0])


_SCHEMA = pa.schema(
    [("conv", pa.int64()), ("seq", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("piece", pa.string()), ("loss_begin", pa.int64()), ("loss_end", pa.int64()), ("rewrites", pa.bool_())]
)


def _formatted(template: Template, learn: str) -> Callable:
    def form(batches):
        conv, state, seq = object(), _State([]), 0
        for batch in batches:
            rows = []
            for own, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv", "role", "text")), strict=True):
                if own != conv:
                    conv, state, seq = own, _State([]), 0
                message = {"role": role or "", "text": text or ""}
                added, rewrites = _added(template, state, message)
                start, state.length = state.length, state.length + len(added)
                span = _text_span(template, state) if message["role"] == learn else None
                shift = state.length - len(state.before)
                loss = (span[0] + shift, span[1] + shift) if span else (None, None)
                rows.append((own, seq, start, start + len(added), added, *loss, rewrites))
                seq += 1
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)

    return form


def format_chats(turns: DataFrame, template: Template = TURNS, learn: str = "assistant", id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """A row per turn: ``conv, seq``, its span ``begin`` to ``end`` in the conversation's output, the ``piece`` of
    output there, the span of its text if its role is ``learn`` (the loss mask), and ``rewrites``, whether the
    turn changed earlier output.

    Turns are ordered by ``turn`` (null first), then role and text, so repeated turn numbers have one order;
    ``seq`` counts from 0. Null roles and texts count as empty; conversations are told apart by a 64-bit id, null
    being one of them. Other columns are ignored; an empty table gives no rows. Output is kept in pieces, one per
    turn: a conversation streams through a task and is never held whole if the template has a ``lookback``.
    """
    columns = [F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")]
    ordered = turns.select(*columns).repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    schema = "conv long, seq long, begin long, end long, piece string, loss_begin long, loss_end long, rewrites boolean"
    return ordered.mapInArrow(_formatted(template, learn), schema)


def _digest(batches):
    """Reads each conversation back from its pieces, as they come in order."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    conv, state = None, None

    def done():
        turns, all_text, learned, loss, length = state
        return conv, turns, all_text.hexdigest(), learned, loss.hexdigest(), length

    for batch in batches:
        rows = []
        for own, begin, piece, first, last in zip(*(batch.column(n).to_pylist() for n in ("conv", "begin", "piece", "loss_begin", "loss_end")), strict=True):
            if state is None or own != conv:
                if state is not None:
                    rows.append(done())
                conv, state = own, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text, _, _ in read_turns(piece):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            if first is not None:
                text = unescape(piece[first - begin : last - begin])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(piece)
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
    if state is not None:
        yield pa.record_batch([pa.array([c], t) for c, t in zip(done(), schema.types, strict=True)], schema=schema)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """A row per conversation of ``format_chats`` by the built-in template, all read back from its output:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.mapInArrow(_digest, schema)
