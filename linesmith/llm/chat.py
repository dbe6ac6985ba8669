"""Conversations rendered by a compiled template, and read back from the result.

Turns come in order of turn, then role and text; null turns come first. A null
text or role is an empty one, a null conversation id is a conversation of its
own. An empty table gives an empty one; only the four columns named are read, so
others cannot clash. A conversation becomes one row, as long as its turns together: its turns
are gathered by an aggregate that combines before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shipping import ship
from .templates import compiled, unescape

ship(__name__)

OPEN, CLOSE, HEAD, TAIL = "<s>", "</s>", "[INST]", "[/INST]"
CONTROLS = (OPEN, CLOSE, HEAD, TAIL)
TEMPLATE = ("{% for m in messages %}" + OPEN + "{{ m.role | escape }}" + HEAD
            + "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
            + "{% else %}{{ m.text | escape }}{% endif %}" + TAIL + CLOSE + "{% endfor %}")


def formatted(turns: DataFrame, template: str = TEMPLATE, controls: tuple[str, ...] = CONTROLS) -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_spans``, the code point ranges to learn from."""
    gathered = (turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("turn"))
                .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")))
    kind = dict(turns.dtypes)["conv_id"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, controls)
        for batch in batches:
            done = [render({"messages": conversation}) for conversation in batch.column(1).to_pylist()]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([t for t, _ in done], pa.string()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], names=["conv_id", "formatted", "loss_spans"])
    return gathered.mapInArrow(rows, f"conv_id {kind}, formatted string, loss_spans array<struct<start: long, end: long>>")


def read_back(done: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text) and ``loss_text`` from the formatted text and its ranges alone.

    For the texts of :data:`TEMPLATE`. Escaped texts hold no control string, so
    these mark the turns; a text that is not made of whole turns is an error.
    """
    turn = re.compile("(.*?)".join(re.escape(c) for c in (OPEN, HEAD, TAIL + CLOSE)), re.S)
    names = list(done.columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns, losses = [], []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                at, found = 0, []
                while at < len(text):
                    m = turn.match(text, at)
                    if not m:
                        raise ValueError(f"no turn at {at}")
                    found.append({"role": unescape(m[1]), "text": unescape(m[2])})
                    at = m.end()
                turns.append(found)
                losses.append("".join(unescape(text[s["start"]:s["end"]]) for s in spans))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(turns, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))), pa.array(losses, pa.string())],
                names=[*names, "turns", "loss_text"])
    kinds = ", ".join(f"`{n}` {t}" for n, t in done.dtypes)
    return done.mapInArrow(rows, f"{kinds}, turns array<struct<role: string, text: string>>, loss_text string")
