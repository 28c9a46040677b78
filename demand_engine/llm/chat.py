"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to one string. It is called on each prefix of a
conversation; where the next output begins with the one before, the rest is the new turn's span, and where it
doesn't, the template rewrites history: the turn is reported, and the conversation has no spans. Inside a span,
the text is found by rendering the same prefix with a probe in place of the turn's text. The loss mask is the
text part of the assistant's spans.

A conversation's turns are gathered into one row and rendered in one task without a Python group; the work is
the template's, quadratic in the turns of one conversation, and a conversation has to fit into a task, as its
output is one string. Copies of a conversation, however many, are separate rows.

Defined results: turns are ordered by turn, role and text, nulls first; a null text or role is empty; an
empty text has an empty span; rows that repeat a turn are turns of their own; rows with a null id form one
conversation; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.llm.common import pick, small_batches

Template = Callable[[list[tuple[str, str]]], str]

#: Fixed values of the default template: what begins and ends a turn, and what marks a character of a text
#: that could be read as part of them.
OPEN, CLOSE, ESCAPE = "### ", " </turn>\n", "\\"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PROBE = "probe"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("<", "\\<")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def turn_template(turns: list[tuple[str, str]]) -> str:
    """``### role: text </turn>`` per turn. A backslash goes before every ``\\``, ``#`` and ``<`` of texts (and
    ``:`` of roles), so neither mark can stand inside one."""
    return "".join(f"{OPEN}{escape(role).replace(':', ESCAPE + ':')}: {escape(text)}{CLOSE}" for role, text in turns)


def spans_of(render: Template, turns: list[tuple[str, str]]):
    """``output, spans, rewrites``: a span per turn, (start, end, text start, text end) in code points, and the
    first turn whose rendering changes what was before (None, and spans for all turns, if there is none)."""
    before, spans = "", []
    for i, (role, text) in enumerate(turns):
        now = render(turns[: i + 1])
        probed = render([*turns[:i], (role, PROBE)])
        head, found, tail = probed[len(before) :].partition(PROBE)
        if not now.startswith(before) or not probed.startswith(before) or not found:
            return render(turns), [], i
        start, end = len(before) + len(head), len(now) - len(tail)
        if end < start or not now.startswith(before + head) or not now.endswith(tail):
            return render(turns), [], i
        spans.append((len(before), len(now), start, end))
        before = now
    return before, spans, None


_SPAN = pa.struct([("role", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64())])
_FORMATTED = pa.schema(
    [("conv_id", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(_SPAN)), ("rewrites_at", pa.int32())]
)


def format_conversations(conversations: DataFrame, render: Template = turn_template) -> DataFrame:
    """Per conversation ``conv_id, formatted, spans`` (role, start, end, text_start, text_end in code points)
    and ``rewrites_at`` (the first turn that rewrites history, else null)."""
    small_batches(conversations.sparkSession)
    rows = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    whole = rows.groupBy(F.col("conv_id").cast("bigint").alias("conv_id")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )

    def run(batches):
        for batch in batches:
            out = []
            for conv_id, turns in zip(batch.column("conv_id").to_pylist(), batch.column("turns").to_pylist()):
                pairs = [(t["role"] or "", t["text"] or "") for t in turns]
                output, spans, rewrites = spans_of(render, pairs)
                marked = [
                    {"role": role, "start": a, "end": b, "text_start": c, "text_end": d}
                    for (role, _), (a, b, c, d) in zip(pairs, spans)
                ]
                out.append((conv_id, output, marked, rewrites))
            columns = list(zip(*out)) if out else [[] for _ in _FORMATTED]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FORMATTED)], schema=_FORMATTED)

    return whole.select("conv_id", "turns").mapInArrow(
        run,
        "conv_id bigint, formatted string, spans array<struct<role: string, start: bigint, end: bigint, "
        "text_start: bigint, text_end: bigint>>, rewrites_at int",
    )


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of the default template's output, read from its marks alone."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        body = part.removeprefix(OPEN)
        at = 0
        while body[at] != ":":
            at += 2 if body[at] == ESCAPE else 1
        turns.append((unescape(body[:at]), unescape(body[at + 2 :])))
    return turns


def digests(formatted: DataFrame, role: str = "assistant") -> DataFrame:
    """Of the default template's output: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars``, turns by its marks and the loss by the spans of ``role``."""
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )

    def run(batches):
        for batch in batches:
            out = []
            for conv_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans"))):
                turns = parse_turns(text)
                loss = "".join(unescape(text[s["text_start"] : s["text_end"]]) for s in spans if s["role"] == role)
                whole = "".join(f"{r}\n{t}\n" for r, t in turns)
                out.append(
                    (
                        conv_id,
                        len(turns),
                        hashlib.sha256(whole.encode()).hexdigest(),
                        len(loss),
                        hashlib.sha256(loss.encode()).hexdigest(),
                        len(text),
                    )
                )
            columns = list(zip(*out)) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return formatted.select("conv_id", "formatted", "spans").mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
