"""Chat formatting of turns with typed content parts.

A turn's content is a list of parts: text, image, audio or document.  A visitor goes over
them in order.  Text is written with its control strings escaped; every other part becomes a
numbered placeholder, and the visitor records the attachment it stands for and the number of
tokens that the placeholder will be expanded to.

Turns that are plain texts may hold links to media in Markdown, ``![a cat](cat.png)``, with sizes
behind them as in ``{width=280 height=140}``, ``{seconds=2.5}`` or ``{pages=3}``.  ``linked_parts``
cuts a text into its typed parts there; an attachment keeps the link as it was written, so that
reading back gives the same text.

A turn is written as ``<|turn|>role<|text|>content<|end|>``.  Control strings, those of the
template and other common ones, are broken up in roles and texts by a backslash after their
first character, and backslashes are doubled, so reading back gives the same text.  The loss
mask has the spans of the contents of assistant turns.

A conversation is one training example: its turns are dealt out by its id, sorted, and read
as a stream, one conversation at a time.

Defined results: a null text is empty, a null role reads as an empty role; null ids are one
conversation and null turns come first; equal turn numbers are ordered by role and text;
repeated rows are written as often as they occur; invalid UTF-8 is read with replacement
characters; an unknown kind of part is an error; an attachment without sizes costs no tokens; no
rows give no conversations.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewindow.session import shuffle_width

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
ESCAPE = "\\"
#: Also covers every string of the template: none begins otherwise.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]")
LOSS_ROLE = "assistant"

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
ATTACHMENT = "struct<number:int,type:string,ref:string,turn:int,tokens:long,text:string>"

# A link and its sizes, in the syntax that Java and Python share.
LINK = r"!\[[^\]\n]*\]\([^()\s]+\)(?:\{[a-z0-9=. ]*\})?"
AUDIO = ("aac", "flac", "m4a", "mp3", "ogg", "opus", "wav")
DOCUMENT = ("doc", "docx", "epub", "odt", "pdf", "ppt", "pptx")

_CONTROL = re.compile("|".join([re.escape(ESCAPE), *(f"(?:{re.escape(c)})" for c in CONTROL)]))
# Placeholders and escaped characters: no other "<|" is left within an escaped text.
_WRITTEN = re.compile(r"<\|[a-z]+:([0-9]+)\|>|" + re.escape(ESCAPE) + "(.)", re.DOTALL)
_TURNS = re.compile(f"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str, attachments: Sequence[dict] = ()) -> str:
    """A doubled escape is one, a single one is dropped; placeholders of attachments with a text
    are that text."""

    def written(m: re.Match) -> str:
        if m[2] is not None:
            return m[2]
        number = int(m[1])
        known = attachments[number]["text"] if number < len(attachments) else None
        return m[0] if known is None else known

    return _WRITTEN.sub(written, text)


def linked_parts(text: Column) -> Column:
    """The typed parts of a text: the texts between its links to media, and the links."""
    links = F.regexp_extract_all(text, F.lit(LINK), F.lit(0))

    def size(link: Column, name: str, kind: str) -> Column:
        return F.regexp_extract(link, r"\)\{(?:[^}]* )?" + name + r"=([0-9]+(?:\.[0-9]+)?)[ }]", 1).try_cast(kind)

    def attachment(link: Column) -> Column:
        ref = F.regexp_extract(link, r"\(([^()\s]+)\)", 1)
        ending = F.lower(F.regexp_extract(ref, r"\.([A-Za-z0-9]+)$", 1))
        kind = F.when(ending.isin(*AUDIO), "audio").when(ending.isin(*DOCUMENT), "document").otherwise("image")
        return _part(
            kind, link, ref=ref, width=size(link, "width", "int"), height=size(link, "height", "int"),
            seconds=size(link, "seconds", "double"), pages=size(link, "pages", "int"),
        )

    between = F.split(text, LINK, -1)
    return F.filter(
        F.flatten(F.transform(between, lambda said, i: F.when(
            i < F.size(links), F.array(_part(F.lit("text"), said), attachment(F.get(links, i)))
        ).otherwise(F.array(_part(F.lit("text"), said))))),
        lambda p: p["text"] != "",
    )


def _part(kind: Column, text: Column, **known: Column) -> Column:
    """A part (``PART``) with nulls for what is not known of it."""
    return F.struct(kind.alias("type"), text.alias("text"), *(
        known.get(name, F.lit(None)).cast(k).alias(name) for name, k in _PART_FIELDS
    ))


_PART_FIELDS = (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))


@dataclass
class TokenCosts:
    """How many tokens an attachment is expanded to."""

    patch: int = 14
    audio_per_second: float = 25.0
    per_page: int = 1024

    def image(self, part: dict) -> int:
        return math.ceil((part["width"] or 0) / self.patch) * math.ceil((part["height"] or 0) / self.patch)

    def audio(self, part: dict) -> int:
        return math.ceil((part["seconds"] or 0.0) * self.audio_per_second)

    def document(self, part: dict) -> int:
        return (part["pages"] or 0) * self.per_page


@dataclass
class PartVisitor:
    """Flattens the parts of a conversation's turns, in order."""

    costs: TokenCosts
    attachments: list[dict] = field(default_factory=list)

    def visit(self, part: dict, turn: int) -> str:
        kind = part["type"]
        handler = getattr(self, f"visit_{kind}", None)
        if handler is None:
            raise ValueError(f"unknown part type: {kind!r}")
        return handler(part, turn)

    def visit_text(self, part: dict, turn: int) -> str:
        return escape(part["text"] or "")

    def visit_image(self, part: dict, turn: int) -> str:
        return self._attach(part, turn, self.costs.image(part))

    def visit_audio(self, part: dict, turn: int) -> str:
        return self._attach(part, turn, self.costs.audio(part))

    def visit_document(self, part: dict, turn: int) -> str:
        return self._attach(part, turn, self.costs.document(part))

    def _attach(self, part: dict, turn: int, tokens: int) -> str:
        number = len(self.attachments)
        self.attachments.append(
            {"number": number, "type": part["type"], "ref": part["ref"], "turn": turn, "tokens": tokens,
             "text": part["text"]}
        )
        return f"<|{part['type']}:{number}|>"


def format_turns(turns: list[tuple[str, list[dict]]], costs: TokenCosts):
    """The formatted text, the spans of the loss mask and the attachments."""
    visitor = PartVisitor(costs)
    pieces, spans, size = [], [], 0
    for turn, (role, parts) in enumerate(turns):
        head = TURN + escape(role) + TEXT
        content = "".join(visitor.visit(p, turn) for p in parts)
        if role == LOSS_ROLE:
            spans.append({"s": size + len(head), "e": size + len(head) + len(content)})
        pieces += [head, content, END]
        size += len(head) + len(content) + len(END)
    return "".join(pieces), spans, visitor.attachments


def read_back(formatted: str, attachments: Sequence[dict] = ()) -> list[tuple[str, str]]:
    """Roles and texts; attachments stand in the texts as they were written, if that is known,
    else as placeholders."""
    return [(unescape(m[1]), unescape(m[2], attachments)) for m in _TURNS.finditer(formatted)]


_FORMATTED = (
    f"formatted string, loss_spans array<struct<s:long,e:long>>, attachments array<{ATTACHMENT}>, "
    "attachment_tokens long"
)


def _format(costs: TokenCosts):
    spans_type = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    attached_type = pa.list_(pa.struct([
        ("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()),
        ("turn", pa.int32()), ("tokens", pa.int64()), ("text", pa.string()),
    ]))

    def run(batches):
        name, turns, started = None, [], False
        kind = None

        def done():
            formatted, spans, attached = format_turns(turns, costs)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name], kind), pa.array([formatted], pa.string()), pa.array([spans], spans_type),
                    pa.array([attached], attached_type), pa.array([sum(a["tokens"] for a in attached)], pa.int64()),
                ],
                ["_conv", "formatted", "loss_spans", "attachments", "attachment_tokens"],
            )

        ready = []
        for batch in batches:
            kind = batch.schema.field("_conv").type
            columns = (batch.column(c).to_pylist() for c in ("_conv", "_role", "_parts"))
            for conv, role, parts in zip(*columns):
                if started and conv != name:
                    ready.append(done())
                    turns = []
                name, started = conv, True
                turns.append((role or "", parts or []))
            if ready:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                ready = []
        if started:
            yield done()

    return run


def format_conversations(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str | None = "text", parts: str | None = None, costs: TokenCosts | None = None,
) -> DataFrame:
    """One row for each conversation: ``conv_id``, ``formatted``, ``loss_spans`` (code points),
    ``attachments`` and ``attachment_tokens``.

    ``parts`` names an array of typed parts (``PART``); else they are those of ``text``.
    """
    if parts:
        content = F.col(parts).cast(f"array<{PART}>")
    else:
        content = linked_parts(F.make_valid_utf8(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    plain = rows.select(
        F.col(conv_id).alias("_conv"), F.col(turn).alias("_turn"),
        F.make_valid_utf8(F.col(role).cast("string")).alias("_role"), content.alias("_parts"),
    )
    ordered = plain.repartition(shuffle_width(rows.sparkSession), "_conv").sortWithinPartitions(
        "_conv", "_turn", "_role", F.to_json("_parts")
    )
    kind = rows.schema[conv_id].dataType.simpleString()
    return ordered.mapInArrow(_format(costs or TokenCosts()), f"_conv {kind}, {_FORMATTED}").withColumnRenamed(
        "_conv", conv_id
    )


def _digest(batches):
    for batch in batches:
        out = [[] for _ in range(7)]
        for formatted, spans, attached in zip(
            *(batch.column(c).to_pylist() for c in ("formatted", "loss_spans", "attachments"))
        ):
            turns = read_back(formatted, attached)
            loss = "".join(unescape(formatted[x["s"] : x["e"]], attached) for x in spans)
            said = "".join(f"{role}\n{text}\n" for role, text in turns)
            for column, value in zip(out, (
                len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                hashlib.sha256(loss.encode()).hexdigest(), len(formatted),
                len(attached), sum(a["tokens"] for a in attached),
            )):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_conv"), *(
                pa.array(v, pa.string() if i in (1, 3) else pa.int64()) for i, v in enumerate(out)
            )],
            [
                "_conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars",
                "n_attachments", "attachment_tokens",
            ],
        )


def digests(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """What can be read back from formatted conversations, as counts and digests."""
    kind = formatted.schema[conv_id].dataType.simpleString()
    plain = formatted.select(F.col(conv_id).alias("_conv"), "formatted", "loss_spans", "attachments")
    return plain.mapInArrow(
        _digest,
        f"_conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_attachments long, attachment_tokens long",
    ).withColumnRenamed("_conv", conv_id)
