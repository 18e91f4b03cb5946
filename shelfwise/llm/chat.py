"""Chat formatting as a prefix tree.

Conversations that begin alike share those turns. Sorted by the hashes of their turns,
they come in the depth-first order of the tree, and each one needs only the turns after
those it shares with the one before it. One sorted stream therefore writes every shared
turn once, with its place in the sequence, its position (the length of its ancestors)
and the intervals of the sequence that it may attend to, which are its ancestors.

No conversation is ever held in memory: turns stream by, and what a task keeps is one
small entry for each turn of the current path.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.batches import batches, named, stored

#: The template. A turn is HEAD role MIDDLE text CLOSE; only ASSISTANT text is learned.
HEAD, MIDDLE, CLOSE = "### ", ":\n", "\n</turn>\n"
ASSISTANT = "assistant"

_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:|\n")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*):\n((?:[^\\]|\\.)*)\n</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_OUT_ROWS = 2_000


def escape(text: str, control: re.Pattern = _CONTROL) -> str:
    """``text`` with a backslash before each backslash and each control string."""
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its learned text begins and ends (0, 0 if none is)."""
    head, body = HEAD + escape(role, _ROLE_CONTROL) + MIDDLE, escape(text)
    at = (len(head), len(head) + len(body)) if role == ASSISTANT else (0, 0)
    return head + body + CLOSE, *at


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    return unescape(found[1]), unescape(found[2])


# --- order of the tree ---------------------------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    """conv, turn, role, text, mark: a 128-bit hash of the turn; nulls in role and text are empty."""
    role, text = (F.coalesce(named(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        named("conv_id").alias("conv"), named("turn").alias("turn"), role.alias("role"), text.alias("text")
    ).withColumn("mark", F.substring(F.unhex(F.sha2(F.concat_ws("\n", F.length("role").cast("string"), "role", "text"), 256)), 1, 16))


def _with_id(name: str, id_: T.DataType, *rest: tuple[str, T.DataType]) -> T.StructType:
    """Columns after an id of whatever type conversations have."""
    return T.StructType([T.StructField(name, id_), *[T.StructField(*r) for r in rest]])


def _paths(schema: T.StructType):
    """The marks of each conversation's turns in a row; rows come sorted by conversation and turn."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, path, started, done = None, bytearray(), False, []
        for batch in stream:
            for conv, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if started and conv != current:
                    done.append((current, bytes(path)))
                    path = bytearray()
                current, started = conv, True
                path += mark
            if len(done) >= _OUT_ROWS:
                yield batches(schema, list(zip(*done)))
                done = []
        if started:
            yield batches(schema, list(zip(*done, (current, bytes(path)))))

    return task


def _places(schema: T.StructType):
    """Each conversation's place in the sorted order, and how many turns it shares with the one before."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, place, before = TaskContext.get().partitionId(), 0, b""
        for batch in stream:
            shared, sizes = [], []
            for path in batch.column(1).to_pylist():
                n = min(len(path), len(before))
                k = 0
                while k < n and path[k : k + 16] == before[k : k + 16]:
                    k += 16
                shared.append(k // 16)
                sizes.append(len(path) // 16)
                before = path
            n = batch.num_rows
            yield batches(schema, [batch.column(0), [part] * n, list(range(place, place + n)), shared, sizes])
            place += n

    return task


# --- packing -------------------------------------------------------------------------

_INTERVALS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_LONG, _TEXT = T.LongType(), T.StringType()


def packed_schema(id_: T.DataType) -> T.StructType:
    """One row a node of a tree, in depth-first order, and one row a conversation after its last node."""
    names = [("pack", _TEXT), ("at", _LONG), ("conv_id", id_), ("depth", _LONG), ("formatted", _TEXT), ("start", _LONG), ("position", _LONG)]
    more = [("loss_start", _LONG), ("loss_end", _LONG), ("attends", _INTERVALS), ("tokens", T.ArrayType(T.IntegerType())), ("loss_first", _LONG), ("loss_last", _LONG)]
    return T.StructType([T.StructField(*f) for f in (*names, *more)])


#: Makes, in each task, the function from a text to its token ids.
Tokenizer = Callable[[], Callable[[str], Sequence[int]]]


def _packed(schema: T.StructType, tokenizer: Tokenizer | None):
    """Nodes and conversation ends from turns sorted by place and turn."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, tree, at, offset = TaskContext.get().partitionId(), -1, 0, 0
        #: (start, end, position, attends) of each turn of the current conversation
        path: list[tuple[int, int, int, list[dict]]] = []
        current, depth, shared, conv = None, 0, 0, None
        rows: list[tuple] = []
        cut = tokenizer() if tokenizer else None

        def below(depth: int) -> tuple[int, list[dict]]:
            """Position and ancestors of what comes after the first ``depth`` turns."""
            if not depth:
                return 0, []
            start, end, position, seen = path[depth - 1]
            return position + end - start, _grown(seen, (start, end))

        def ended() -> tuple:
            return (f"{part}-{tree}", at, conv, depth, None, None, None, None, None, below(depth)[1], None, None, None)

        for batch in stream:
            for p, place, own, conv_, role, text in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if (p, place) != current:
                    if current is not None:
                        rows.append(ended())
                        at += 1
                    # What went before in another task can't be shared with.
                    shared = 0 if current is None else own
                    current, depth, conv = (p, place), 0, conv_
                    if not shared:
                        tree, at, offset, path = tree + 1, 0, 0, []
                if depth >= shared:
                    del path[depth:]
                    formatted, a, b = format_turn(role, text)
                    ids, first, last, size = None, None, None, len(formatted)
                    if cut:
                        # The learned part is cut on its own, so that whole tokens belong to it.
                        head, body, tail = (list(cut(x)) for x in (formatted[:a], formatted[a:b], formatted[b:]))
                        ids, first, last = head + body + tail, len(head), len(head) + len(body)
                        size = len(ids)
                    position, seen = below(depth)
                    rows.append((f"{part}-{tree}", at, conv, depth, formatted, offset, position, a, b, seen, ids, first, last))
                    path.append((offset, offset + size, position, seen))
                    offset, at = offset + size, at + 1
                depth += 1
                if len(rows) >= _OUT_ROWS:
                    yield batches(schema, list(zip(*rows)))
                    rows = []
        if current is not None:
            rows.append(ended())
        if rows:
            yield batches(schema, list(zip(*rows)))

    return task


def _grown(seen: list[dict], last: tuple[int, int]) -> list[dict]:
    """The ancestors of the parent and the parent itself."""
    if seen and seen[-1]["end"] == last[0]:
        return [*seen[:-1], {"start": seen[-1]["start"], "end": last[1]}]
    return [*seen, {"start": last[0], "end": last[1]}]


def pack(conversations: DataFrame, tokenizer: Tokenizer | None = None) -> DataFrame:
    """The trees of ``conversations(conv_id, turn, role, text)`` as packed sequences.

    A row with ``formatted`` is a turn that is written once for all conversations that begin
    so: its start in the pack, its position, the learned part of it (``loss_start`` to
    ``loss_end``, in characters of the turn) and the earlier intervals of the pack it attends to.
    A row without is the end of a conversation: its ``attends`` are the intervals of the pack
    that make it up. ``at`` is the order within the pack, ``depth`` the turn, or for an end their number.

    With a ``tokenizer`` each node has its ``tokens`` once, of which those from ``loss_first`` to
    ``loss_last`` are learned, and starts, positions and intervals count tokens; without one
    they count characters. The k-th token of a node has position id ``position + k`` and may
    attend to the intervals of its node and to the tokens of the node up to itself.

    Ids may be of any type that can be sorted. Turns of one conversation go by turn (nulls first), then role and text; repeated rows are
    turns of their own, and all rows without conv_id are one conversation. Trees are cut where
    a task ends; what is shared across the cut is written on both sides.
    """
    turns = _turns(conversations)
    id_ = turns.schema["conv"].dataType
    order = ["conv", "turn", "role", "mark"]
    light = turns.select(*order).repartition("conv").sortWithinPartitions(*order)
    paths = light.select("conv", "mark").mapInArrow(*_over(_paths, _with_id("conv", id_, ("path", T.BinaryType()))))
    place_schema = _with_id("conv", id_, *[(n, _LONG) for n in ("part", "place", "shared", "n_turns")])
    places = stored(paths.orderBy("path", "conv").select("conv", "path").mapInArrow(*_over(_places, place_schema)), "places")
    placed = turns.hint("merge").join(places.hint("merge"), turns.conv.eqNullSafe(places.conv)).select("part", "place", "shared", turns.conv.alias("conv"), "role", "text", "turn", "mark")
    placed = placed.repartitionByRange("part", "place").sortWithinPartitions("part", "place", "turn", "role", "mark")
    schema = packed_schema(id_)
    return placed.select("part", "place", "shared", "conv", "role", "text").mapInArrow(_packed(schema, tokenizer), schema)


def _over(make, schema: T.StructType) -> tuple:
    return make(schema), schema


# --- reading back --------------------------------------------------------------------

def _read_back(schema: T.StructType):
    """Digests of every conversation from packs in depth-first order."""

    def task(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _digests(stream, schema)

    return task


def _digests(stream: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    pack_, path, done = None, [], []
    for batch in stream:
        for pack, conv, depth, formatted, loss_start, loss_end in zip(*[batch.column(i).to_pylist() for i in range(6)]):
            if pack != pack_:
                pack_, path = pack, [(hashlib.sha256(), 0, hashlib.sha256(), 0)]
            if formatted is None:
                turns, loss_chars, loss, chars = path[depth]
                done.append((conv, depth, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
                continue
            del path[depth + 1 :]
            turns, loss_chars, loss, chars = path[depth]
            turns, loss = turns.copy(), loss.copy()
            role, text = parse_turn(formatted)
            turns.update(f"{role}\n{text}\n".encode())
            learned = unescape(formatted[loss_start:loss_end])
            loss.update(learned.encode())
            path.append((turns, loss_chars + len(learned), loss, chars + len(formatted)))
        if len(done) >= _OUT_ROWS:
            yield batches(schema, list(zip(*done)))
            done = []
    if done:
        yield batches(schema, list(zip(*done)))


def read_back(packed: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from packs alone."""
    sorted_ = packed.repartition("pack").sortWithinPartitions("pack", "at")
    schema = _with_id(
        "conv_id", packed.schema["conv_id"].dataType, ("n_turns", _LONG), ("turns_sha256", _TEXT), ("loss_chars", _LONG), ("loss_sha256", _TEXT), ("formatted_chars", _LONG)
    )
    return sorted_.select("pack", "conv_id", "depth", "formatted", "loss_start", "loss_end").mapInArrow(*_over(_read_back, schema))
