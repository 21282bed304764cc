"""Chat formatting: conversations rendered by a compiled template, with a loss mask.

The template marks each turn as ``<|turn|>role`` newline, text, ``<|end|>`` newline; the text of assistant
turns is a generation block. Texts and roles are escaped: behind every ``<``, ``[`` and backslash
goes a backslash, so no control string (which all begin with ``<`` or ``[``) can occur inside a text,
and dropping the mark restores it; a newline in a role becomes ``[n``.

Conversations are dealt out by conv_id and sorted by turn inside partitions; a task then renders its
conversations from a stream of rows, one turn in memory at a time, and reads them back with an
incremental parser. Nothing is gathered: a conversation may have any number of turns. Its digest is
one chain over its turns by the contract, so one conversation is one task's stream.

Defined cases: a null text or role is empty; rows with the same turn come in the order of role and
text; a null conv_id is a conversation; null turns come first; a role is otherwise free text, and only
``assistant`` is under the loss mask; an empty table gives the empty result (plus the probe, where
asked for); other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.template import compile_template, unescape

TEMPLATE = (
    "{% for m in messages %}<|turn|>{{ m.role | escape_line }}{{ '\\n' }}"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "<|end|>{{ '\\n' }}{% endfor %}"
)
TURN, END = "<|turn|>", "<|end|>\n"
DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def format_messages(messages: Iterable[dict], template: str = TEMPLATE) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of a conversation and the spans (code points, end exclusive) under the loss mask."""
    out, spans, at = [], [], 0
    for text, generated in compile_template(template)(messages=messages):
        out.append(text)
        if generated and text:
            spans.append((at, at + len(text)))
        at += len(text)
    return "".join(out), spans


def read_back(pieces: Iterable[tuple[str, bool]]) -> Iterator[tuple[str, str, str, int]]:
    """(role, text, text under the loss mask, characters), turn by turn, from formatted pieces alone."""
    buffer, mask = [], []
    for text, generated in pieces:
        buffer.append(text)
        if generated:
            mask.append(text)
        # Texts hold no unmarked <, so the end of a turn is in a piece of the template.
        while END in text:
            whole = "".join(buffer)
            at = whole.index(END) + len(END)
            turn, rest = whole[:at], whole[at:]
            if not turn.startswith(TURN):
                raise ValueError(f"no turn: {turn[:40]!r}")
            role, _, body = turn[len(TURN) : -len(END)].partition("\n")
            yield unescape(role), unescape(body), unescape("".join(mask)), len(turn)
            buffer, mask, text = [rest], [], rest


def digest(messages: Iterable[dict], render) -> tuple[int, str, int, str, int]:
    """n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the formatted output."""
    turns, loss, n, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
    for role, text, masked, size in read_back(render(messages=messages)):
        turns.update(f"{role}\n{text}\n".encode())
        loss.update(masked.encode())
        n, loss_chars, chars = n + 1, loss_chars + len(masked), chars + size
    return n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars


def with_probe(conversations: DataFrame) -> DataFrame:
    """conversations plus number -7, whose two turns hold control strings."""
    says = "</s>[INST] ok [/INST]"
    probe = conversations.sparkSession.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").union(probe)


def format_digests(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row for each conversation, read back from its formatted text."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        render = compile_template(template)
        rows = (r for f in frames for r in zip(f["conv_id"].astype(object), f["role"], f["text"], strict=True))
        key = lambda r: None if pd.isna(r[0]) else int(r[0])
        ahead, made = next(rows, None), []
        while ahead is not None:
            now = key(ahead)

            def messages(now=now):
                nonlocal ahead
                while ahead is not None and key(ahead) == now:
                    row, ahead = ahead, next(rows, None)
                    yield {"role": row[1] or "", "text": row[2] or ""}

            made.append((now, *digest(messages(), render)))
            if len(made) >= 1000:
                yield table(made)
                made = []
        yield table(made)

    def table(made: list[tuple]) -> pd.DataFrame:
        names = [x.split()[0] for x in DIGEST.split(", ")]
        out = pd.DataFrame(made, columns=names)
        out["conv_id"] = out["conv_id"].astype("Int64")
        return out

    order = ["conv_id", "turn", "role", "text"]
    return conversations.select(*order).repartition("conv_id").sortWithinPartitions(*order).mapInPandas(run, DIGEST)
