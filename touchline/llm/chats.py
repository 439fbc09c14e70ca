"""Chat formatting from an event log: streamed pieces, edits and regenerations become messages, messages become text.

A log row is (conv_id, turn, variant, copy, seq, kind, role, text). The first four name a message: rows of one turn follow
each other by `variant`, and `copy` tells equal ones apart. `seq` orders the events of a message:

* `start` opens it with its role,
* `delta` appends a streamed piece,
* `edit` puts another text in place of what is there,
* `regenerate` throws away what is there; deltas of the new answer follow.

The log is dealt out by ranges of (conversation, message) and sorted once, so a conversation of any size is spread over
tasks while its messages stay in order; folding, rendering and joining follow in the same tasks without another shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of common chat formats.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
MESSAGE = ["conv_id", "turn", "variant", "copy"]
EVENT = [*MESSAGE, "seq", "kind", "role", "text"]
#: Code points of a streamed piece in `as_log`.
PIECE = 400
#: A part of a formatted conversation ends with the turn that fills it.
PART_CHARS = 1 << 20
#: Messages held by a task before they are passed on.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 4096


@dataclass(frozen=True)
class Template:
    """Marks around each turn and the control strings that texts may not hold.

    A control string in a text gets a backslash behind its first character, and one that has such backslashes already gets
    one more, so every text can be had back and no control string is left in it. Control strings must not overlap.
    """
    open: str = "<|im_start|>"
    close: str = "<|im_end|>\n"
    controls: tuple[str, ...] = CONTROLS
    learned: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        if self.open not in self.controls or self.close.rstrip("\n") not in self.controls:
            raise ValueError("the marks must be control strings")
        if any(len(c) < 2 or c[1] == "\\" or "\n" in c for c in self.controls):
            raise ValueError("a control string has two characters at least, no line end and no backslash at its second place")
        for a in self.controls:
            for b in self.controls:
                if a != b and a in b or any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")

    def pattern(self, escaped: bool) -> str:
        any_of = "|".join(f"(?<={_quoted(c[0])}){{}}{_quoted(c[1:])}" for c in self.controls)
        return any_of.replace("{}", r"\\+" if escaped else r"\\*")

    @cached_property
    def escaped(self) -> re.Pattern:
        return re.compile(self.pattern(True))

    def escape(self, text: Column) -> Column:
        """A text column without control strings."""
        return F.regexp_replace(text, self.pattern(False), r"\\$0")

    def unescape(self, text: str) -> str:
        return self.escaped.sub(lambda m: m.group()[1:], text) if "\\" in text else text

    def escape_role(self, role: Column) -> Column:
        """A role on one line."""
        return self.escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))

    def unescape_role(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m.group(1) == "n" else m.group(1), self.unescape(role))


def _quoted(text: str) -> str:
    """A literal for both Java's and Python's patterns."""
    return re.sub(r"([^A-Za-z0-9 _])", r"\\\1", text)


def as_log(conversations: DataFrame, piece: int = PIECE) -> DataFrame:
    """A table of final messages (conv_id, turn, role, text) as the log that a chat service would have written.

    Texts are streamed in pieces. One answer in three, by a hash, was regenerated after a first attempt of half its text;
    one message in three of the others was edited from a draft. NULL texts and roles are empty; rows of one turn are kept,
    in the order of a hash of their content; other columns are left out.
    """
    rows = conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"variant": F.xxhash64("role", "text"), "copy": F.monotonically_increasing_id(),
                             "_third": F.pmod(F.xxhash64("conv_id", "turn"), F.lit(3))})
    half = F.substring(F.col("text"), F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    event = lambda kind, role=None, text=None: F.struct(
        F.lit(kind).alias("kind"), F.lit(role).cast("string").alias("role") if role is None else role.alias("role"),
        F.lit(text).cast("string").alias("text") if text is None else text.alias("text"))
    is_answer = F.col("role") == "assistant"
    before = (F.when(is_answer & (F.col("_third") == 0), F.array(event("delta", None, half), event("regenerate")))
               .when(~is_answer & (F.col("_third") == 1), F.array(event("delta", None, F.upper(half)), event("edit", None, F.lit(""))))
               .otherwise(F.array().cast("array<struct<kind:string,role:string,text:string>>")))
    pieces = F.transform(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{piece}}}"), F.lit(0)), lambda t: event("delta", None, t))
    events = F.concat(F.array(event("start", F.col("role"))), before, pieces)
    return rows.select(*MESSAGE, F.posexplode(events).alias("seq", "_e")).select(*MESSAGE, F.col("seq").cast("long").alias("seq"), "_e.*")


def _key_type(df: DataFrame) -> str:
    return df.schema["conv_id"].dataType.simpleString()


def _batches(rows: list[list], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, role, pieces, out, size, types = None, "", [], [], 0, None

    for batch in batches:
        if types is None:
            types = [*[batch.schema.field(c).type for c in MESSAGE], pa.string(), pa.string()]
        for *name, _, kind, who, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if name != key:
                if key is not None:
                    out.append([*key, role, "".join(pieces)])
                    size += sum(map(len, pieces))
                    if size > BATCH_BYTES or len(out) >= BATCH_ROWS:
                        yield _batches(out, [*MESSAGE, "role", "text"], types)
                        out, size = [], 0
                key, role, pieces = name, "", []
            if kind == "delta":
                pieces.append(text or "")
            elif kind == "edit":
                pieces = [text or ""]
            elif kind == "regenerate":
                pieces = []
            elif kind == "start":
                role = who or ""
    if key is not None:
        out.append([*key, role, "".join(pieces)])
        yield _batches(out, [*MESSAGE, "role", "text"], types)


def messages(log: DataFrame) -> DataFrame:
    """One row per message with its final role and text, sorted within ranges of (conversation, message).

    Events of equal `seq` are taken in the order of kind and text; kinds not listed above change nothing, a message without
    `start` has an empty role, NULL texts are empty. A task holds one message's pieces at a time; what an edit or a
    regeneration replaces is dropped at once. Columns other than the log's are left out.
    """
    ordered = log.select(*EVENT).repartitionByRange(*MESSAGE).sortWithinPartitions(*MESSAGE, "seq", "kind", "text")
    return ordered.mapInArrow(_folded, f"conv_id {_key_type(log)}, turn bigint, variant bigint, copy bigint, role string, text string")


def rendered(said: DataFrame, template: Template = Template()) -> DataFrame:
    """The formatted turn of each message and how far its learned text lies from the turn's start (NULL: not learned)."""
    role, text = template.escape_role(F.col("role")), template.escape(F.col("text"))
    turns = said.select(*MESSAGE, "role", role.alias("_role"), text.alias("_text"))
    head = F.length("_role") + len(template.open) + 1
    learned = F.col("role").isin(*template.learned)
    return turns.select(
        *MESSAGE, F.concat(F.lit(template.open), "_role", F.lit("\n"), "_text", F.lit(template.close)).alias("formatted"),
        F.when(learned, head).cast("long").alias("learn_from"), F.when(learned, head + F.length("_text")).cast("long").alias("learn_to"))


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [*MESSAGE, "n_turns", "formatted", "loss"]
    key, turns, size, spans, out, held, types = None, [], 0, [], [], 0, None

    def part():
        return [*key, len(turns), "".join(turns), spans]

    for batch in batches:
        if types is None:
            types = [*[batch.schema.field(c).type for c in MESSAGE], pa.int64(), pa.string(), SPANS]
        for *name, text, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key is None or name[0] != key[0] or size >= PART_CHARS:
                if key is not None:
                    out.append(part())
                    held += size
                    if held > BATCH_BYTES or len(out) >= BATCH_ROWS:
                        yield _batches(out, names, types)
                        out, held = [], 0
                key, turns, size, spans = name, [], 0, []
            if begin is not None:
                spans.append({"start": size + begin, "end": size + end})
            turns.append(text)
            size += len(text)
    if key is not None:
        out.append(part())
        yield _batches(out, names, types)


def format_log(log: DataFrame, template: Template = Template()) -> DataFrame:
    """Formatted conversations: one row per part with the text, its number of turns and its learned spans in code points.

    A part holds whole turns of one conversation; all but very long conversations are a single part. Parts of a conversation
    follow each other by (turn, variant, copy), the name of their first message. An empty log gives no rows; a NULL
    conversation id or turn is a value like any other.
    """
    return rendered(messages(log), template).mapInArrow(
        _joined, f"conv_id {_key_type(log)}, turn bigint, variant bigint, copy bigint, n_turns bigint, formatted string, "
                 "loss array<struct<start:bigint,end:bigint>>")


def turns_of(formatted: str, template: Template) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted part."""
    for turn in formatted.split(template.open)[1:]:
        role, _, text = turn.removesuffix(template.close).partition("\n")
        yield template.unescape_role(role), template.unescape(text)


def _digested(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        key, types, out = None, None, []
        said = learned = n_turns = n_learned = n_chars = None

        def row():
            return [key[0], n_turns, said.hexdigest(), n_learned, learned.hexdigest(), n_chars]

        for batch in batches:
            types = types or [batch.schema.field(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss")), strict=True):
                if key is None or key[0] != conv:
                    if key is not None:
                        out.append(row())
                        if len(out) >= BATCH_ROWS:
                            yield _batches(out, names, types)
                            out = []
                    key, said, learned, n_turns, n_learned, n_chars = (conv,), hashlib.sha256(), hashlib.sha256(), 0, 0, 0
                for who, what in turns_of(text, template):
                    said.update(f"{who}\n{what}\n".encode("utf-8", "surrogatepass"))
                    n_turns += 1
                for span in spans:
                    what = template.unescape(text[span["start"]:span["end"]])
                    learned.update(what.encode("utf-8", "surrogatepass"))
                    n_learned += len(what)
                n_chars += len(text)
        if key is not None:
            out.append(row())
            yield _batches(out, names, types)
    return run


def digests(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read back from formatted conversations: turns, learned text and their sha256.

    Parts are streamed in order, one at a time. A hash over a conversation can only be taken in sequence, so one
    conversation's parts meet in one task; nothing of them is kept there but the state of the hashes.
    """
    ordered = parts.select(*MESSAGE, "formatted", "loss").repartition("conv_id").sortWithinPartitions(*MESSAGE)
    return ordered.mapInArrow(_digested(template), f"conv_id {_key_type(parts)}, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                                                   "loss_sha256 string, formatted_chars bigint")
