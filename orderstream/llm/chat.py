"""Chat formatting with a compiled template (operator 10).

Conversations (rows by turn) are sorted by Spark within hash partitions of
conv_id and rendered one after the other, so a task holds one conversation at a
time. The template marks turns; the ``quoted`` filter escapes the control strings
inside roles and texts reversibly (every ``<|`` becomes ``<\\|``, with one more
backslash if some are there already), so a marker in the output is always the
template's. The loss mask is what stands inside the template's generation blocks.

Edge cases: NULL role or text counts as empty. Rows of one conversation that
share a turn follow each other by role and text; a NULL turn comes first. A NULL
conv_id is a conversation of its own. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .template import compile_template

TEMPLATE = (
    "{% for m in messages %}<|im_start|>{{ m.role | quoted }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | quoted }}{% endgeneration %}"
    "{% else %}{{ m.text | quoted }}{% endif %}<|im_end|>\n{% endfor %}"
)
FORMATTED = "conv_id long, n_turns long, formatted string, loss array<struct<start:int,end:int>>"
_QUOTE = re.compile(r"<(\\*)\|")
_UNQUOTE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_end\|>\n", re.S)


def quoted(text: str) -> str:
    return _QUOTE.sub(r"<\\\1|", text)


def unquoted(text: str) -> str:
    return _UNQUOTE.sub(r"<\1|", text)


def quoted_role(text: str) -> str:
    """A role ends at the first line break, so its own ones are escaped too."""
    return quoted(text).replace("%", "%25").replace("\n", "%0A")


def unquoted_role(text: str) -> str:
    return unquoted(text.replace("%0A", "\n").replace("%25", "%"))


FILTERS = {"quoted": quoted, "quoted_role": quoted_role}
TEMPLATE = TEMPLATE.replace("m.role | quoted }}", "m.role | quoted_role }}")


def render(messages: list[dict], run: Callable) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans (code points) under the loss mask."""
    parts, spans, at = [], [], 0
    for text, generated in run({"messages": messages}):
        if generated and text:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        parts.append(text)
        at += len(text)
    return "".join(parts), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from the formatted text."""
    turns = []
    for m in _TURN.finditer(formatted):
        role, _, text = m[1].partition("\n")
        turns.append((unquoted_role(role), unquoted(text)))
    return turns


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, list[dict]]]:
    """Consecutive rows of one conv_id; at most one conversation is held."""
    current, messages = None, []
    for batch in batches:
        for conv, role, text in zip(batch["conv_id"].tolist(), batch["role"].tolist(), batch["text"].tolist(), strict=True):
            conv = None if conv is None else int(conv)
            if messages and conv != current:
                yield current, messages
                messages = []
            current = conv
            messages.append({"role": role or "", "text": text or ""})
    if messages:
        yield current, messages


def format_chats(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, n_turns, formatted, loss (spans)."""
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = conversations.select("conv_id", "turn", "role", "text")
    ordered = rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    # As a string, since pandas would make a column with NULLs a float.
    ordered = ordered.select(F.col("conv_id").cast("string").alias("conv_id"), "role", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = compile_template(template, FILTERS)
        out, size = [], 0
        for conv, messages in _conversations(batches):
            formatted, spans = render(messages, compiled)
            out.append((conv, len(messages), formatted, [{"start": a, "end": b} for a, b in spans]))
            size += len(formatted)
            if size > 4_000_000:
                yield _frame(out)
                out, size = [], 0
        if out:
            yield _frame(out)

    return ordered.mapInPandas(run, FORMATTED)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "formatted", "loss"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


def digests(formatted: DataFrame) -> DataFrame:
    """What the contract asks for, read back from the formatted text alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for conv, text, loss in zip(batch["conv_id"].tolist(), batch["formatted"].tolist(), batch["loss"].tolist(), strict=True):
                turns = read_turns(text)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                masked = "".join(unquoted(text[s["start"] : s["end"]]) for s in loss)
                sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
                out.append((None if conv is None else int(conv), len(turns), sha(whole), len(masked), sha(masked), len(text)))
            columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            frame = pd.DataFrame(out, columns=columns)
            frame["conv_id"] = frame["conv_id"].astype("Int64")
            yield frame

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return formatted.select(F.col("conv_id").cast("string").alias("conv_id"), "formatted", "loss").mapInPandas(run, schema)
