"""Chat formatting: typed content parts flattened into one training string.

A conversation is a set of rows (conversation id, turn, role, content parts).
A part is text, an image, an audio clip or a document. ``PartVisitor`` walks
the parts of a turn and flattens them, in order, into text and placeholders;
each attachment leaves its reference, its place in the formatted string and
the number of tokens it expands to.

Template, per turn::

    <|turn|>role<|body|>content<|end|>

Control strings inside roles and texts are escaped reversibly: one backslash
goes behind the opening bracket of anything that looks like a control string
(already escaped ones included), so a marker in the output is always one the
template put there. ``read_back`` parses a formatted string into its turns.

Scale: turns are grouped by conversation, since one conversation is one output
row; a task holds one conversation at a time besides its Arrow batch.

Defined results: null text, part or part list = empty; null role = empty role;
null turns sort first; ties sort by role, then content; repeated rows are all
kept; null conversation ids form one conversation; an unknown part type
becomes an ``attachment`` placeholder of 0 tokens; extra input columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kmstream.llm.common import text_batches

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"

#: What may open a control string: <| ..., <s>, </s>, [INST], [/INST].
_ESCAPE = re.compile(r"([<\[])(\\*)(\||/?s>|/?INST\])")
_UNESCAPE = re.compile(r"([<\[])\\(\\*)(\||/?s>|/?INST\])")
_TURN = re.compile(r"<\|turn\|>(.*?)<\|body\|>(.*?)<\|end\|>", re.S)
_PLACEHOLDER = re.compile(r"<\|(image|audio|document|attachment):(\d+)\|>")

PART_TYPE = ("array<struct<type:string,text:string,ref:string,width:long,"
             "height:long,seconds:double,pages:long>>")
FORMATTED_TYPE = ("conv_id long, n_turns long, formatted string, "
                  "loss_spans array<struct<start:long,stop:long>>, "
                  "attachments array<struct<ordinal:long,kind:string,ref:string,turn_index:long,start:long,tokens:long>>, "
                  "attachment_tokens long")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


@dataclass(frozen=True)
class TokenRule:
    """How many tokens an attachment expands to."""

    patch: int = 28             # image pixels a side of one token
    audio_per_second: int = 25
    page: int = 256


class PartVisitor:
    """Flattens the parts of one conversation; ordinals run over the whole of it."""

    def __init__(self, rule: TokenRule = TokenRule()):
        self.rule = rule
        self.attachments: list[dict] = []

    def visit(self, part, turn_index: int, at: int) -> str:
        if part is None:
            return ""
        kind = part["type"] or "text"
        method = getattr(self, f"visit_{kind}", None) if kind in ("text", "image", "audio", "document") else None
        return (method or self.visit_attachment)(part, turn_index, at)

    def visit_text(self, part, turn_index, at) -> str:
        return escape(part["text"] or "")

    def visit_image(self, part, turn_index, at) -> str:
        sides = [max(1, math.ceil(_number(part[k]) / self.rule.patch)) for k in ("width", "height")]
        return self._place("image", part, turn_index, at, sides[0] * sides[1])

    def visit_audio(self, part, turn_index, at) -> str:
        return self._place("audio", part, turn_index, at, math.ceil(_number(part["seconds"]) * self.rule.audio_per_second))

    def visit_document(self, part, turn_index, at) -> str:
        return self._place("document", part, turn_index, at, int(_number(part["pages"])) * self.rule.page)

    def visit_attachment(self, part, turn_index, at) -> str:
        return self._place("attachment", part, turn_index, at, 0)

    def _place(self, kind, part, turn_index, at, tokens) -> str:
        k = len(self.attachments)
        self.attachments.append({"ordinal": k, "kind": kind, "ref": part["ref"], "turn_index": turn_index,
                                 "start": at, "tokens": tokens})
        return f"<|{kind}:{k}|>"


def _number(x) -> float:
    """A size with null, NaN and negative values read as 0."""
    return float(x) if x is not None and x == x and x > 0 else 0.0


def format_turns(turns, learn: str = "assistant", rule: TokenRule = TokenRule()) -> dict:
    """One conversation: ``turns`` holds (role, parts) in order."""
    visitor, out, at, spans = PartVisitor(rule), [], 0, []
    for k, (role, parts) in enumerate(turns):
        head = TURN + escape(role or "") + BODY
        body, place = [], at + len(head)
        for part in parts if parts is not None else ():
            body.append(visitor.visit(part, k, place))
            place += len(body[-1])
        if role == learn:
            spans.append({"start": at + len(head), "stop": place})
        out += [head, *body, END]
        at = place + len(END)
    return {"n_turns": len(turns), "formatted": "".join(out), "loss_spans": spans,
            "attachments": visitor.attachments,
            "attachment_tokens": sum(a["tokens"] for a in visitor.attachments)}


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, content) of each turn of a formatted string, unescaped; placeholders stay as they are."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         parts: str = "parts", learn: str = "assistant", rule: TokenRule = TokenRule()) -> DataFrame:
    """One row per conversation: formatted string, loss spans (code points) and attachments."""
    text_batches(df.sparkSession)
    rows = df.select(F.col(conv).cast("long").alias("conv_id"),
                     F.struct(F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"),
                              F.col(parts).cast(PART_TYPE).alias("parts")).alias("row"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))

    def run(batches):
        for pdf in batches:
            done = [format_turns([(r["role"], r["parts"]) for r in rows], learn, rule) for rows in pdf["rows"]]
            yield pd.DataFrame({"conv_id": pdf["conv_id"].array, **{
                k: [d[k] for d in done] for k in ("n_turns", "formatted", "loss_spans", "attachments", "attachment_tokens")}})

    return whole.mapInPandas(run, FORMATTED_TYPE)


def text_parts(column: str = "text"):
    """A plain text column as a list of one text part (null text: the empty text)."""
    return F.array(F.struct(
        F.lit("text").alias("type"), F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("long").alias("width"),
        F.lit(None).cast("long").alias("height"), F.lit(None).cast("double").alias("seconds"),
        F.lit(None).cast("long").alias("pages")))


def formatted_digest(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted strings say, read back from them."""

    def run(batches):
        for pdf in batches:
            rows = []
            for conv, text, spans in zip(pdf["conv_id"].array, pdf["formatted"], pdf["loss_spans"], strict=True):
                turns = read_back(text)
                learnt = "".join(unescape(text[s["start"]:s["stop"]]) for s in spans)
                rows.append((conv, len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learnt), _sha(learnt), len(text)))
            yield pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
