"""Conversations rendered by a template, with the spans a loss is taken on, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm.chat_template import compile_template, unescape
from anchorline.llm.common import arrow_map

#: Every turn is marked by its role. Texts and other roles are escaped, so marks are marks.
TEMPLATE = (
    "<s>{% for m in messages %}"
    "{% if m.role == 'user' %}[INST]{{ m.text | escape }}[/INST]"
    "{% elif m.role == 'assistant' %}[OUT]"
    "{% generation %}{{ m.text | escape }}{% endgeneration %}</s>"
    "{% else %}[TURN {{ m.role | escape }}]{{ m.text | escape }}[/TURN]{% endif %}"
    "{% endfor %}"
)
_TURN = re.compile(
    r"\[(?:(?P<user>INST)\](?P<said>[^\[<]*)\[/INST\]"
    r"|(?P<assistant>OUT)\](?P<out>[^\[<]*)</s>"
    r"|TURN (?P<role>[^\[\]<]*)\](?P<text>[^\[<]*)\[/TURN\])"
)
#: Characters of a rendering after which a new row begins.
PART = 1 << 20

PARTS = "conv_id long, part long, formatted string, loss_spans array<struct<start: long, stop: long>>"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long"
)

NAMES = [c.split()[0] for c in DIGESTS.split(", ")]


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def render_conversations(
    conversations: DataFrame, template: str = TEMPLATE, part: int = PART
) -> DataFrame:
    """The rendering of each conversation, in parts of about `part` characters.

    Needs conv_id, turn, role, text; other columns are not read. Rows of one conversation go
    by turn, then role, then text, nulls first; repeated rows are repeated turns. A null text
    or role is empty. Rows without an id form one conversation without an id. Parts of a
    conversation lie in one partition, in order; only one part is held at a time, so the
    length of a conversation does not bound memory. Spans count code points of their part.
    """

    def rows(batches):
        render = compile_template(template)
        out: dict[str, list] = {"conv_id": [], "part": [], "formatted": [], "loss_spans": []}
        for conv, turns in groupby(_rows(batches), key=lambda r: r[0]):
            pieces: list[str] = []
            spans: list[tuple[int, int]] = []
            size = number = 0

            def flush(conv=conv):
                nonlocal size, number
                for name, value in zip(out, (conv, number, "".join(pieces), list(spans)), strict=True):
                    out[name].append(value)
                pieces.clear()
                spans.clear()
                size, number = 0, number + 1

            def emit(text, inside):
                nonlocal size
                if inside and text:
                    spans.append((size, size + len(text)))
                pieces.append(text)
                size += len(text)

            def messages(turns=turns):
                for _, _, role, text in turns:
                    if size > part:
                        flush()
                    yield {"role": role or "", "text": text or ""}

            render(emit, messages=messages())
            flush()
            if len(out["part"]) >= 1000 or sum(map(len, out["formatted"])) > part:
                yield out
                out = {name: [] for name in out}
        yield out

    ordered = (
        conversations.select(
            F.col("conv_id").cast("long").alias("conv_id"),
            F.col("turn").cast("long").alias("turn"),
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return arrow_map(ordered, PARTS, rows)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, from renderings by TEMPLATE.

    Takes the partitions of `render_conversations` as they are. A turn may cross parts.
    """

    def rows(batches):
        out: list[tuple] = []
        for conv, found in groupby(_rows(batches), key=lambda r: r[0]):
            out.append((conv, *_digests(found)))
            if len(out) >= 1000:
                yield dict(zip(NAMES, zip(*out, strict=True), strict=True))
                out = []
        if out:
            yield dict(zip(NAMES, zip(*out, strict=True), strict=True))

    return arrow_map(parts, DIGESTS, rows)


def _digests(parts: Iterator[tuple]) -> tuple:
    turns, loss = hashlib.sha256(), hashlib.sha256()
    n_turns = loss_chars = chars = 0
    rest = ""
    for _, _, formatted, spans in parts:
        chars += len(formatted)
        for span in spans:
            text = unescape(formatted[span["start"] : span["stop"]])
            loss_chars += len(text)
            loss.update(text.encode())
        rest += formatted
        at = 0
        for m in _TURN.finditer(rest):
            role = "user" if m["user"] else "assistant" if m["assistant"] else m["role"]
            text = next(x for x in (m["said"], m["out"], m["text"]) if x is not None)
            turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
            n_turns += 1
            at = m.end()
        rest = rest[at:]
    return n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars


#: read_back over render_conversations in DuckDB, for tables whose turns have an id.
SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, turn, role, '</s>[INST] ok [/INST]'
  FROM (VALUES (0, 'user'), (1, 'assistant')) AS probe(turn, role)
), sized AS (
  SELECT *,
    length(text) + 4 * (length(text) - length(translate(text, '&[]', '')))
      + 3 * (length(text) - length(replace(text, '<', ''))) AS text_size,
    length(role) + 4 * (length(role) - length(translate(role, '&[]', '')))
      + 3 * (length(role) - length(replace(role, '<', ''))) AS role_size
  FROM said
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(text_size + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 9
    ELSE 14 + role_size END) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""
