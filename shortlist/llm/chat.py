"""Chat formatting with a grammar round trip.

A conversation becomes one text of turns::

    <|im_start|>ROLE\n TEXT <|im_end|>\n

(without the spaces around TEXT). Rendered text is read back by a deterministic
parser, and turns that do not come back as they went in are escaped and rendered
again until all do. A text conflicts if it holds a control string, of this
template or of another common one, or something that looks like an escaped one.
An escape puts one backslash behind the first character of a control string,
whatever number of backslashes stands there, and reading takes one away, so
every text can be told from every other.

Cases: a null text or role is empty; turns of one conversation that share a
number are ordered by role and text; a null turn comes first; rows of a null id
are one conversation; an empty table gives no row. Columns beside the four named
ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# Control strings that no formatted text may hold but as marks of turns.
CONTROLS = (START, END, "<s>", "</s>", "[INST]", "[/INST]")
# One control string, with any backslashes behind its first character.
ESCAPABLE = r"([<\[])(\\*)(\|im_start\|>|\|im_end\|>|/?s>|/?INST\])"
_ANY = re.compile(ESCAPABLE)
_MARK = re.compile("|".join(re.escape(c) for c in CONTROLS))

Turn = tuple[str, str]


def escape(text: str) -> str:
    return _ANY.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return _ANY.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def role_name(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def role_of(name: str) -> str:
    return unescape(name).replace("%0A", "\n").replace("%25", "%")


def render(turns: Sequence[Turn], escaped: Sequence[bool]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and where each turn's content stands in it."""
    out, spans, at = [], [], 0
    for (role, text), quoted in zip(turns, escaped):
        head = f"{START}{role_name(role)}\n"
        body = escape(text) if quoted else text
        spans.append((at + len(head), at + len(head) + len(body)))
        piece = f"{head}{body}{END}\n"
        out.append(piece)
        at += len(piece)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[Turn, tuple[int, int]]]:
    """Turns and the places of their contents; ValueError where the text is not of the grammar."""
    at, turns = 0, []
    while at < len(formatted):
        if not formatted.startswith(START, at):
            raise ValueError(f"no turn at {at}")
        at += len(START)
        line = formatted.find("\n", at)
        close = _MARK.search(formatted, at)
        if close is None or close[0] != END or not at <= line < close.start():
            raise ValueError(f"turn at {at} is not closed")
        if not formatted.startswith("\n", close.end()):
            raise ValueError(f"no end of line at {close.end()}")
        role, body = formatted[at:line], (line + 1, close.start())
        turns.append(((role_of(role), unescape(formatted[body[0] : body[1]])), body))
        at = close.end() + 1
    return turns


def comes_back(turn: Turn, quoted: bool) -> bool:
    """Whether a turn on its own is read back as it was."""
    try:
        return [t for t, _ in parse(render([turn], [quoted])[0])] == [turn]
    except ValueError:
        return False


def format_turns(turns: Sequence[Turn]) -> tuple[str, list[tuple[int, int]], int]:
    """Formatted text, places of the contents, and the number of escaped turns.

    The grammar has no state beyond a turn, so a text that fails as a whole is
    mended turn by turn.
    """
    escaped = [False] * len(turns)
    while True:
        text, spans = render(turns, escaped)
        try:
            if [t for t, _ in parse(text)] == list(turns):
                return text, spans, sum(escaped)
        except ValueError:
            pass
        wrong = [not comes_back(t, q) for t, q in zip(turns, escaped)]
        if not any(w and not q for w, q in zip(wrong, escaped)):
            raise ValueError("an escaped conversation does not come back")
        escaped = [q or w for q, w in zip(escaped, wrong)]


def format_conversations(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant"
) -> DataFrame:
    """One row per conversation: its id, formatted text, loss mask and number of escaped turns.

    The mask lists the places ``[start, end)``, in code points, of the texts of
    the role ``trained``. A conversation is one text, so its turns meet in one
    row; tasks stream over conversations.
    """
    said = df.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("said"),
    )
    grouped = said.groupBy("conv").agg(F.sort_array(F.collect_list("said")).alias("said"))
    turns = grouped.select(
        "conv", F.transform("said", lambda s: s["role"]).alias("roles"), F.transform("said", lambda s: s["text"]).alias("texts")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, roles, texts in zip(batch["conv"], batch["roles"], batch["texts"]):
                said = list(zip(roles, texts))
                formatted, spans, quoted = format_turns(said)
                mask = [{"start": a, "end": b} for (name, _), (a, b) in zip(said, spans) if name == trained]
                rows.append((key, formatted, mask, quoted))
            yield pd.DataFrame(rows, columns=["conv", "formatted", "loss", "escaped"])

    kind = df.schema[conv].dataType.simpleString()
    schema = f"conv {kind}, formatted string, loss array<struct<start:bigint,end:bigint>>, escaped bigint"
    return turns.mapInPandas(run, schema).withColumnRenamed("conv", conv)


def read_back(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Turns, trained texts and length of every conversation, read from its formatted text alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text, mask in zip(batch["conv"], batch["formatted"], batch["loss"]):
                turns = [t for t, _ in parse(text)]
                trained = [unescape(text[m["start"] : m["end"]]) for m in mask]
                rows.append((key, [r for r, _ in turns], [t for _, t in turns], trained, len(text)))
            yield pd.DataFrame(rows, columns=["conv", "roles", "texts", "trained", "chars"])

    kind = formatted.schema[conv].dataType.simpleString()
    schema = f"conv {kind}, roles array<string>, texts array<string>, trained array<string>, chars bigint"
    source = formatted.select(F.col(conv).alias("conv"), "formatted", "loss")
    return source.mapInPandas(run, schema).withColumnRenamed("conv", conv)
