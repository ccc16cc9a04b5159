"""Chat formatting of heterogeneous conversation records.

A record's layout is recognised by its schema fingerprint: the hash of the
paths of its non-null fields (``messages[].role``). Fingerprints select a
declarative mapping (``Layout``), which says where the turns of such a record
lie: in a list of messages, in prompt and answer fields, or in the row itself.
All mappings give the same canonical turns, which are written with one
template, one output row per turn.

Paths, fingerprints, mappings and the template are column expressions built
from the frame's schema: a table read from JSON lines of many layouts has one
wide schema, in which the fields that a record lacks are null.

A conversation may spread over many records, ordered by a column. Nothing
gathers a conversation: its formatted turns are rows, to be written sorted, and
whatever reads them back streams over them.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridwright.llm.common import in_slices

# The template: a turn is OPEN role NAMED text CLOSE.
OPEN, NAMED, CLOSE = "<turn>", "</role>", "</turn>\n"
# Control strings are escaped in roles and texts; CLOSE without its line feed.
CONTROL = "<turn>|</role>|</turn>"
LEARNED_ROLE = "assistant"
BATCH_ROWS = 1024


@dataclass(frozen=True)
class Turn:
    """A turn held in fields of the record itself. ``text`` are paths, whose
    non-null texts are joined by a blank line; a turn without any is left out
    unless it is ``needed``, and is then empty."""

    role: str
    text: tuple[str, ...]
    needed: bool = True


@dataclass(frozen=True)
class Layout:
    """Mapping of one record layout to canonical turns.

    Either ``turns``, or messages: ``each`` is the path of an array of structs
    (empty: the record itself is the message) with the fields ``role`` and
    ``text``. ``parts`` names the text field of content given as a list of
    parts. ``roles`` translates role names; others stay as they are. Records
    may lack the ``optional`` paths.
    """

    name: str
    turns: tuple[Turn, ...] = ()
    each: str | None = None
    role: str = "role"
    text: str = "content"
    parts: str | None = None
    roles: dict[str, str] = field(default_factory=dict, hash=False)
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        """All paths that such a record may have."""
        if self.each is None:
            return [p for t in self.turns for p in t.text]
        if not self.each:
            return [self.role, self.text]
        text = f"{self.each}[].{self.text}"
        of_text = [f"{text}[]", f"{text}[].{self.parts}"] if self.parts else [text]
        return [f"{self.each}[]", f"{self.each}[].{self.role}", *of_text]

    def fingerprints(self) -> list[str]:
        """Of every choice of optional paths."""
        always = [p for p in self.paths() if p not in self.optional]
        chosen = itertools.chain.from_iterable(
            itertools.combinations(self.optional, k) for k in range(len(self.optional) + 1))
        return [fingerprint([*always, *more]) for more in chosen]


SHARED_ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LAYOUTS = (
    Layout("row", each="", role="role", text="text", optional=("role", "text")),
    Layout("messages", each="messages", roles=SHARED_ROLES, optional=("messages[].content",)),
    Layout("message_parts", each="messages", parts="text", roles=SHARED_ROLES),
    Layout("from_value", each="conversations", role="from", text="value", roles=SHARED_ROLES,
           optional=("conversations[].value",)),
    Layout("instruction", turns=(
        Turn("system", ("system",), needed=False), Turn("user", ("instruction", "input")),
        Turn("assistant", ("output",))), optional=("system", "input")),
    Layout("prompt_completion", turns=(
        Turn("system", ("system",), needed=False), Turn("user", ("prompt",)), Turn("assistant", ("completion",))),
        optional=("system",)),
    Layout("prompt_response", turns=(
        Turn("system", ("system",), needed=False), Turn("user", ("prompt",)), Turn("assistant", ("response",))),
        optional=("system",)),
    Layout("question_answer", turns=(
        Turn("system", ("context",), needed=False), Turn("user", ("question",)), Turn("assistant", ("answer",))),
        optional=("context",)),
)


def fingerprint(paths: list[str]) -> str:
    """SHA-256 of the sorted paths, one per line."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def nested_paths(schema: T.StructType, columns: list[str]) -> dict[str, Column]:
    """Path of every field under ``columns``, with the condition that a row
    has it: a value at that path that is not null (for an array ``x[]``: the
    array is there; below it: some element has it)."""
    out: dict[str, Column] = {}

    def walk(path: str, kind: T.DataType, holds) -> None:
        # holds(test): the row has a value at this path that meets the test
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}", f.dataType,
                     lambda test, name=f.name: holds(lambda v: test(v.getField(name))))
        elif isinstance(kind, T.ArrayType):
            out[f"{path}[]"] = holds(lambda v: v.isNotNull())
            if isinstance(kind.elementType, (T.StructType, T.ArrayType)):
                walk(f"{path}[]", kind.elementType,
                     lambda test: holds(lambda v: F.coalesce(F.exists(v, test), F.lit(False))))
                if isinstance(kind.elementType, T.ArrayType):
                    del out[f"{path}[]"]
        else:
            out[path] = holds(lambda v: v.isNotNull())

    for name in columns:
        walk(name, schema[name].dataType, lambda test, c=F.col(_quoted(name)): test(c))
    return out


def fingerprint_column(schema: T.StructType, columns: list[str]) -> Column:
    """``fingerprint`` of the paths that each row has."""
    paths = nested_paths(schema, columns)
    present = [F.when(paths[p], F.lit(p)) for p in sorted(paths)]
    return F.sha2(F.concat_ws("\n", *present) if present else F.lit(""), 256)


def _has(schema: T.StructType, path: str) -> bool:
    """The frame can hold such a path as text (or a list of structs, at ``[]``)."""
    kind: T.DataType = schema
    for name in path.replace("[]", ".[]").split("."):
        if name == "[]":
            if not isinstance(kind, T.ArrayType):
                return False
            kind = kind.elementType
        elif not isinstance(kind, T.StructType) or name not in kind.names:
            return False
        else:
            kind = kind[name].dataType
    return not isinstance(kind, (T.ArrayType, T.MapType)) and (path.endswith("[]") or not isinstance(kind, T.StructType))


TURN = "struct<role:string,text:string>"


def _turn(role: Column, text: Column) -> Column:
    return F.struct(
        F.coalesce(role.cast("string"), F.lit("")).alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    ).cast(TURN)


def _renamed(role: Column, roles: dict[str, str]) -> Column:
    return F.coalesce(*[F.when(role.cast("string") == k, F.lit(v)) for k, v in roles.items()], role.cast("string"))


def turns_of(layout: Layout, schema: T.StructType) -> Column:
    """array<struct<role, text>> of a record of the layout."""
    if layout.each is None:
        made = []
        for t in layout.turns:
            texts = [F.col(_quoted(p)).cast("string") for p in t.text if _has(schema, p)]
            present = [F.when(c != "", c) for c in texts]
            text = F.concat_ws("\n\n", *present) if texts else F.lit("")
            one = F.array(_turn(F.lit(t.role), text))
            some = reduce(lambda a, b: a | b, [c.isNotNull() for c in texts], F.lit(t.needed))
            made.append(F.when(some, one).otherwise(F.array().cast(f"array<{TURN}>")))
        return F.concat(*made)
    if not layout.each:
        def column(name: str) -> Column:
            return F.col(_quoted(name)) if _has(schema, name) else F.lit(None)

        return F.array(_turn(_renamed(column(layout.role), layout.roles), column(layout.text)))
    names = schema[layout.each].dataType.elementType.names

    def of_message(m: Column) -> Column:
        text = m.getField(layout.text) if layout.text in names else F.lit(None)
        if layout.parts:
            parts = F.transform(text, lambda p: F.coalesce(p.getField(layout.parts).cast("string"), F.lit("")))
            text = F.concat_ws("", parts)
        return _turn(_renamed(m.getField(layout.role), layout.roles), text)

    return F.transform(F.col(_quoted(layout.each)), of_message)


def usable(layouts: tuple[Layout, ...], schema: T.StructType) -> list[Layout]:
    """The layouts that rows of the frame can have."""
    return [
        v for v in layouts
        if all(_has(schema, p) for p in v.paths() if p not in v.optional) and any(_has(schema, p) for p in v.paths())
    ]


def canonical_turns(
    records: DataFrame,
    conversation: str = "conv_id",
    order: str | None = "turn",
    layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """One row per turn of every record: conv, turn_order (the value of
    ``order``, null without one), position (of the turn in its record), role,
    text, layout and fingerprint.

    Columns that no layout mentions are ignored. A record whose fingerprint
    has no mapping gives one row with a null layout, position, role and text,
    so that it is seen; ``unmapped`` counts them by fingerprint. A null text
    or role is empty. Repeated records give their turns again. An empty table
    gives no rows.
    """
    schema = records.schema
    known = {re.split(r"[.\[]", p)[0] for v in layouts for p in v.paths()} - {conversation, order}
    columns = [c for c in records.columns if c in known]
    fits = usable(layouts, schema)
    print_of = F.col("fingerprint")
    none = F.lit(None).cast(f"array<{TURN}>")
    name, turns = F.lit(None).cast("string"), none
    for v in fits:
        mine = print_of.isin(v.fingerprints())
        name, turns = F.when(mine, F.lit(v.name)).otherwise(name), F.when(mine, turns_of(v, schema)).otherwise(turns)
    at = F.col(_quoted(order)).cast("bigint") if order else F.lit(None).cast("bigint")
    found = records.select(
        F.col(_quoted(conversation)).alias("conv"), at.alias("turn_order"),
        fingerprint_column(schema, columns).alias("fingerprint"), *[F.col(_quoted(c)) for c in columns if c not in (
            "conv", "turn_order", "fingerprint")],
    ).select("conv", "turn_order", "fingerprint", name.alias("layout"), turns.alias("turns"))
    rows = found.select("conv", "turn_order", "fingerprint", "layout", F.posexplode_outer("turns").alias("position", "t"))
    # A record of a known layout may hold no turn at all: it has nothing to format.
    return rows.where(F.col("t").isNotNull() | F.col("layout").isNull()).select(
        "conv", "turn_order", "position", F.col("t.role").alias("role"), F.col("t.text").alias("text"),
        "layout", "fingerprint")


def unmapped(turns: DataFrame) -> DataFrame:
    """Fingerprints without a mapping and how many records have them."""
    return turns.where(F.col("layout").isNull()).groupBy("fingerprint").agg(F.count(F.lit(1)).alias("records"))


def escaped(text: Column) -> Column:
    r"""Control strings get a backslash in front. Backslashes that stand before
    a control string, or at the end of the text (where the template's own
    string follows), are doubled first, so that an odd number of them before a
    control string means that it belongs to the text."""
    doubled = F.regexp_replace(text, rf"(?<!\\)(\\++)(?={CONTROL}|\z)", "$1$1")
    return F.regexp_replace(doubled, f"({CONTROL})", r"\\$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """Each turn as text of the template: conv, turn_order, position,
    formatted, and the loss mask mask_start, mask_end (code points of
    ``formatted``; null but for turns of ``LEARNED_ROLE``), which covers the
    turn's text alone. Records without a mapping have no turns to format."""
    role, text = escaped(F.col("role")), escaped(F.col("text"))
    head = F.concat(F.lit(OPEN), role, F.lit(NAMED))
    learned = F.col("role") == LEARNED_ROLE
    start = F.char_length(F.col("head")).cast("bigint")
    return turns.where(F.col("layout").isNotNull()).select(
        "conv", "turn_order", "position", learned.alias("learned"), head.alias("head"), text.alias("body"),
    ).select(
        "conv", "turn_order", "position", F.concat("head", "body", F.lit(CLOSE)).alias("formatted"),
        F.when(F.col("learned"), start).alias("mask_start"),
        F.when(F.col("learned"), start + F.char_length(F.col("body"))).alias("mask_end"),
    )


_CONTROL = re.compile(CONTROL)


def _written(text: str) -> list[tuple[str, int, int]]:
    """Control strings of a formatted text that the template wrote: those
    behind an even number of backslashes."""
    out = []
    for m in _CONTROL.finditer(text):
        at = m.start()
        while at and text[at - 1] == "\\":
            at -= 1
        if (m.start() - at) % 2 == 0:
            out.append((m.group(), m.start(), m.end()))
    return out


def unescaped(text: str) -> str:
    """The role or text that ``escaped`` was given."""
    out, done = [], 0
    for m in _CONTROL.finditer(text):
        at = m.start()
        while at > done and text[at - 1] == "\\":
            at -= 1
        out += [text[done:at], "\\" * ((m.start() - at) // 2), m.group()]
        done = m.end()
    rest = text[done:]
    kept = rest.rstrip("\\")
    return "".join([*out, kept, "\\" * ((len(rest) - len(kept)) // 2)])


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) pairs of text in the template, from the text alone."""
    turns, role, start = [], "", 0
    for mark, at, end in _written(formatted):
        if mark == NAMED:
            role = unescaped(formatted[start:at])
        elif mark != OPEN:
            turns.append((role, unescaped(formatted[start:at])))
        start = end
    return turns


DIGEST = (
    "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say: conv, n_turns, turns_sha256 (of
    role, line feed, text, line feed of each turn, parsed from the template),
    loss_chars and loss_sha256 (of the unescaped text under the mask) and
    formatted_chars.

    Turns come in the order of turn_order (null last) and position, equal ones
    by their text. The rows of a conversation stream through one task, since a
    SHA-256 is a chain; only the digests are held. Rows with a null conv are
    one conversation.
    """
    kind = formatted.schema["conv"].dataType
    one_task = formatted.repartition("conv").sortWithinPartitions(
        "conv", F.col("turn_order").asc_nulls_last(), "position", "formatted")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        done: list[tuple] = []

        def closed() -> list[tuple]:
            if state is None:
                return []
            n, turns, chars, loss, total = state
            return [(conv, n, turns.hexdigest(), chars, loss.hexdigest(), total)]

        def out(found: list[tuple], like: pa.RecordBatch) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True))
            types = [like.schema.field("conv").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                   names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                          "formatted_chars"])

        last = None
        for batch in in_slices(batches, BATCH_ROWS):
            last = batch
            for key, text, start, end in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if state is None or key != conv:
                    done += closed()
                    conv, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                if start is not None:
                    learned = unescaped(text[start:end])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            if done:
                yield out(done, batch)
                done = []
        if last is not None and (rest := closed()):
            yield out(rest, last)

    return one_task.select("conv", "formatted", "mask_start", "mask_end").mapInArrow(
        rows, f"conv {kind.simpleString()}, {DIGEST}")


# A conversation whose texts hold control strings behind a backslash; added by
# the query, to be read back like all others.
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The rows conv_id, turn, role, text and those of the probe."""
    spark = conversations.sparkSession
    probe = spark.createDataFrame(
        [(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, "assistant", PROBE_TEXT)],
        "conv_id bigint, turn bigint, role string, text string")
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.unionByName(probe)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """The formatted turns of a table with one turn per row."""
    return format_turns(canonical_turns(conversations, "conv_id", "turn"))
