"""Chat formatting by incremental black-box rendering.

The formatter knows a template only as ``render(messages, opening) -> str``:
``messages`` are (role, text) pairs and ``opening`` asks for the start of one
more turn of that role. It renders successive turn prefixes and compares
consecutive outputs: what a longer prefix adds is the turn's span, what the
opening adds is its header, and rendering the turn with an empty text gives
its footer, so the text's own span lies between. A template that rewrites
history is one whose output does not start with the output for the turns
before. The string returned is always the template's rendering of the whole
conversation; where history was rewritten, each turn's text is located in it by
rendering the conversation with two other texts in its place.

Rows are dealt by conversation and read in turn order. A template that is
declared ``independent`` (a turn looks the same whatever came before it) is
rendered in blocks of ``block`` turns, each begun with the ``overlap`` turns
before it, so a conversation of any length holds one block in memory; each
block is rendered after a longer prefix too, and a template that breaks its
promise there is an error. Of any other template a conversation is held whole:
its blocks count only while, after each of them, they add up to the rendering
of all turns so far; otherwise every prefix is rendered whole, in quadratic
time. Each block is one row of the result; a conversation whose history was
rewritten is one row.

A null text, role or conversation id is defined: a null text is empty, a null
role is the empty role, and all rows with a null id are one conversation.
Null turns come first; rows with equal turns are ordered by role and text and
all kept, so a repeated row is one more turn. Empty tables give no rows. Only
the four columns are read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_arrow

Message = tuple[str, str]
Render = Callable[[list[Message], str | None], str]

# The marks of the default template, and what replaces the
# characters that marks are made of inside a text or role.
TURN, HEAD_END, TURN_END = "[INST]", "[/INST]", "</s>"
ESCAPES = (("\\", "\\\\"), ("[", "\\b"), ("<", "\\l"))
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    """The text without the characters that begin a mark; ``unescape`` undoes it."""
    for plain, code in ESCAPES:
        text = text.replace(plain, code)
    return text


def unescape(text: str) -> str:
    back = {code: plain for plain, code in ESCAPES}
    return re.sub(r"\\.", lambda m: back[m.group()], text, flags=re.S)


def marked_template(messages: list[Message], opening: str | None = None) -> str:
    """``[INST]role[/INST]text</s>`` for each turn, texts and roles escaped."""
    out = [f"{TURN}{escape(role)}{HEAD_END}{escape(text)}{TURN_END}" for role, text in messages]
    if opening is not None:
        out.append(f"{TURN}{escape(opening)}{HEAD_END}")
    return "".join(out)


def read_back(formatted: str) -> list[Message]:
    """The turns of a string that ``marked_template`` made."""
    turns = []
    for turn in formatted.split(TURN_END)[:-1]:
        role, text = turn.removeprefix(TURN).split(HEAD_END)
        turns.append((unescape(role), unescape(text)))
    return turns


class Located:
    """The spans of one block of turns: ``parts`` are what each turn added to
    the output, with the place of its text inside."""

    def __init__(self, render: Render, before: list[Message], turns: list[Message]):
        self.rewrites = False
        self.roles = [role for role, _ in turns]
        self.parts: list[tuple[str, int, int]] = []
        done = list(before)
        last = render(done, None) if done else ""
        for role, text in turns:
            opened = render(done, role)
            empty = render([*done, (role, "")], None)
            done.append((role, text))
            now = render(done, None)
            if not (now.startswith(last) and opened.startswith(last) and now.startswith(opened)):
                self.rewrites = True
            head = len(opened)
            while not now.startswith(opened[:head]):  # the common part, where history was rewritten
                head = _common(now, opened)
            foot = len(empty) - _common(empty, opened)
            while foot and not now.endswith(empty[len(empty) - foot:]):
                foot -= 1
            first = _common(now, last)
            self.parts.append((now[first:], max(head - first, 0), max(len(now) - foot - first, 0)))
            last = now
        self.final = last


def _common(a: str, b: str) -> int:
    """Length of the common start, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a.startswith(b[:middle]):
            low = middle
        else:
            high = middle - 1
    return low


SPANS = pa.list_(pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("text_start", pa.int64()), ("text_end", pa.int64())]))
SCHEMA = ("conv_id bigint, block bigint, formatted string, spans array<struct<role: string, start: bigint, "
          "end: bigint, text_start: bigint, text_end: bigint>>, rewrites_history boolean")


class Placed:
    """The spans of a conversation whose history was rewritten, in its final
    output: a text stands where outputs with two other texts in its place differ.
    A turn that the final output leaves out has an empty text span."""

    STAND_INS = "\ue000", "\ue001"

    def __init__(self, render: Render, turns: list[Message]):
        self.rewrites = True
        self.roles = [role for role, _ in turns]
        final, places, at = render(turns, None), [], 0
        for k, (role, _) in enumerate(turns):
            first, after = self._around(render, turns[:k], role, turns[k + 1:])
            if first is not None:
                first = min(max(first, at), len(final))
                at = max(len(final) - after, first)
            places.append((at if first is None else first, at))
        begin, self.parts = 0, []
        for k, (start, stop) in enumerate(places):
            end = len(final)
            if k + 1 < len(turns):  # a turn ends with its footer, as far as the final output has it
                footer = self._footer(render, turns[:k + 1])
                end = stop + _common(final[stop:places[k + 1][0]], footer)
            self.parts.append((final[begin:end], start - begin, stop - begin))
            begin = end

    def _around(self, render: Render, before: list[Message], role: str, after: list[Message]) -> tuple:
        """Lengths of what stands before and after a text; None if it is left out."""
        one, two = (render([*before, (role, t), *after], None) for t in self.STAND_INS)
        return (None, 0) if one == two else (_common(one, two), _common(one[::-1], two[::-1]))

    def _footer(self, render: Render, turns: list[Message]) -> str:
        now, (_, n) = render(turns, None), self._around(render, turns[:-1], turns[-1][0], [])
        return now[len(now) - n:]


def _whole(turns: list[Message], render: Render, block: int, overlap: int) -> list[Located | Placed]:
    """The pieces of a conversation, for a template of any kind."""
    pieces, so_far = [], ""
    for k in range(0, len(turns), block):
        pieces.append(Located(render, turns[max(k - overlap, 0):k], turns[k:k + block]))
        so_far += "".join(part for part, _, _ in pieces[-1].parts)
        if k and (pieces[-1].rewrites or so_far != render(turns[:k + block], None)):
            pieces = [Located(render, [], turns)]
            break
    return [Placed(render, turns)] if any(p.rewrites for p in pieces) else pieces


def _streamed(turns: Iterator[Message], render: Render, block: int, overlap: int) -> Iterator[Located]:
    """The pieces of a conversation, for a template that is declared independent."""
    before: list[Message] = []
    while own := list(itertools.islice(turns, block)):
        found = Located(render, before, own)
        longer = before * 2
        if before and render([*longer, *own], None) != render(longer, None) + "".join(p[0] for p in found.parts):
            raise ValueError("the template is not independent: a block looks different after a longer prefix")
        if found.rewrites:
            raise ValueError("the template is not independent: it rewrites history")
        yield found
        before = (before + own)[-overlap:] if overlap else []


def _blocks(rows: Iterator[tuple], render: Render, block: int, overlap: int, independent: bool) -> Iterator[tuple]:
    """One tuple for each block of the conversations, whose rows come together."""
    for conv, own in itertools.groupby(rows, key=lambda r: r[0]):
        turns = ((role or "", text or "") for _, role, text in own)
        pieces = _streamed(turns, render, block, overlap) if independent else _whole(list(turns), render, block, overlap)
        for number, found in enumerate(pieces):
            spans, at = [], 0
            for role, (part, a, b) in zip(found.roles, found.parts):
                spans.append({"role": role, "start": at, "end": at + len(part), "text_start": at + a, "text_end": at + b})
                at += len(part)
            yield conv, number, "".join(p[0] for p in found.parts), spans, found.rewrites


def format_conversations(rows: DataFrame, render: Render = marked_template, block: int = 64,
                         overlap: int = 2, independent: bool | None = None) -> DataFrame:
    """One row for each block of a conversation: the formatted string, the spans
    of its turns and their texts in it (code points, end exclusive), and whether
    the template rewrote history. Blocks of a conversation are in order. Unless
    it is said, only ``marked_template`` counts as independent."""
    streamed = render is marked_template if independent is None else independent

    def run(batches):
        def each():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")))

        def batch(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), SPANS, pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                              ["conv_id", "block", "formatted", "spans", "rewrites_history"])

        held, size = [], 0
        for row in _blocks(each(), render, block, overlap, streamed):
            held.append(row)
            size += len(row[2])
            if size > 4_000_000 or len(held) >= 1000:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)

    four = rows.select(F.col("conv_id").cast("long"), F.col("turn"), F.col("role").cast("string"),
                       F.col("text").cast("string"))
    dealt = four.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return map_arrow(dealt, run, SCHEMA)


DIGEST_SCHEMA = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
                 "formatted_chars bigint, rewrites_history boolean")


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """What can be read back from ``format_conversations``' result, streamed over
    each conversation's blocks: turns from the string, loss texts from the spans."""
    import hashlib

    def run(batches):
        def batch(rows):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
                     "rewrites_history"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        now, done = None, []

        def finish():
            conv, turns, sha, chars, loss, length, rewrites = now
            return conv, turns, sha.hexdigest(), chars, loss.hexdigest(), length, rewrites

        for b in batches:
            for conv, number, text, spans, rewrites in zip(*(c.to_pylist() for c in b.columns)):
                if number == 0:
                    if now:
                        done.append(finish())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                for role, said in read_back(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode())
                for s in spans:
                    if s["role"] == LOSS_ROLE:
                        said = unescape(text[s["text_start"]:s["text_end"]])
                        now[3] += len(said)
                        now[4].update(said.encode())
                now[5] += len(text)
                now[6] |= rewrites
            if done:
                yield batch(done)
                done = []
        if now:
            yield batch([finish()])

    return map_arrow(formatted, run, DIGEST_SCHEMA)
