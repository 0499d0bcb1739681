"""Chat formatting by columnar byte assembly.

A batch of turns becomes one buffer: the lengths of all segments (header, text, closer) are laid out row by row, their
running sum says where each one goes, and numpy copies headers and texts to those places of one preallocated Arrow
buffer. No string is built per turn.

Template: every turn stands between control strings of its role, with a blank inside each::

    [INST] text [/INST]      user            <<SYS>> text <</SYS>>             system
    <s> text </s>            assistant       [ROLE] name [/ROLE] text [END]    any other role

A text never holds a control string: backslashes are doubled, and a control string inside a text gets a backslash after
its first character (``</s>`` becomes ``<\\/s>``). Both are taken back when reading, so every text survives.

Rows come in order of conversation and turn, ties by role and then text, and are dealt by range, so that the turns of a
large conversation are formatted by many tasks. Output are *parts*: consecutive turns of one conversation that were
formatted together, about a MB at most or one longer turn, in the order of ``part``. ``loss_starts`` and ``loss_ends``
are the byte spans of the texts that a model is trained on.

Null conversation ids form one conversation, null turns come first, a null role or text is empty. Repeated rows are
turns of their own. Texts may have any length; one that is longer than a slab is handled alone. An empty table gives no
rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import Segment, assemble, constants, raw, slabs, strings, view

#: Control strings. None holds a blank or a backslash, and no two can match at one place.
CONTROLS = (b"<s>", b"</s>", b"[INST]", b"[/INST]", b"<<SYS>>", b"<</SYS>>", b"[ROLE]", b"[/ROLE]", b"[END]")
OPENS, CLOSES = {"user": 2, "assistant": 0, "system": 4}, {2: 3, 0: 1, 4: 5, 7: 8}
ROLE, ROLE_END = 6, 7
LENGTHS = np.array([len(c) for c in CONTROLS])
FIRST_BYTES = sorted({c[0] for c in CONTROLS})
ESCAPE = ord("\\")
KNOWN = list(OPENS)
LOSS_ROLES = ("assistant",)
def controls(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all control strings within their texts, and which one stands there."""
    first = np.flatnonzero(np.isin(data, FIRST_BYTES))
    ends = offsets[np.searchsorted(offsets, first, "right")] if len(first) else first
    found = np.full(len(first), -1)
    for k, control in enumerate(CONTROLS):
        may = np.flatnonzero(first + len(control) <= ends)
        for i, byte in enumerate(control):
            may = may[data[first[may] + i] == byte]
        found[may] = k
    return first[found >= 0], found[found >= 0]


def escaped(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts without control strings; the inverse is :func:`dropped`."""
    before = np.sort(np.concatenate([np.flatnonzero(data == ESCAPE), controls(data, offsets)[0] + 1]))
    if not len(before):
        return data, offsets
    return np.insert(data, before, ESCAPE), offsets + np.searchsorted(before, offsets, "left")


def dropped(data: np.ndarray) -> np.ndarray:
    """Which bytes reading takes out: the first of each pair of backslashes, and a single one."""
    at = np.flatnonzero(data == ESCAPE)
    out = np.zeros(len(data), bool)
    if len(at):
        opens = np.append(True, np.diff(at) > 1)
        inside = np.arange(len(at)) - np.flatnonzero(opens)[np.cumsum(opens) - 1]
        out[at[inside % 2 == 0]] = True
    return out


PARTS = "part long, text string, loss_starts array<long>, loss_ends array<long>"


def format_chats(conversations: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """``conv_id, part, text, loss_starts, loss_ends`` of all conversations (``conv_id, turn, role, text``)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    # Text decides among repeated turns; its start is enough to deal them, as texts with one start stay together.
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    kind = conversations.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 33
        for slab in slabs(batches):
            for out in _formatted(slab, part, loss_roles):
                part += out.num_rows
                yield out

    return ordered.mapInArrow(run, f"conv_id {kind}, {PARTS}")


def _formatted(slab: pa.RecordBatch, part: int, loss_roles: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    n = slab.num_rows
    conv, role, text = slab.column("conv_id"), slab.column("role"), slab.column("text")
    known = pc.fill_null(pc.index_in(role, pa.array(KNOWN, role.type)), len(KNOWN)).to_numpy(zero_copy_only=False)
    other = known == len(KNOWN)
    data, offsets = escaped(*raw(text))
    names, name_offsets = escaped(*raw(role))
    heads = [CONTROLS[OPENS[r]] + b" " for r in KNOWN] + [CONTROLS[ROLE] + b" "]
    tails = [b" " + CONTROLS[CLOSES[OPENS[r]]] for r in KNOWN] + [b" " + CONTROLS[CLOSES[ROLE_END]]]
    buffer, places, bounds = assemble(
        [
            constants(heads, known),
            (names, name_offsets[:-1], np.where(other, np.diff(name_offsets), 0)),
            constants([b"", b" " + CONTROLS[ROLE_END] + b" "], other.astype(int)),
            (data, offsets[:-1], np.diff(offsets)),
            constants(tails, known),
        ]
    )
    code = conv.dictionary_encode(null_encoding="encode").indices.to_numpy()
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
    starts = bounds[first]
    masked = np.flatnonzero(np.isin(known, [KNOWN.index(r) for r in loss_roles if r in KNOWN]))
    for r in loss_roles:
        if r not in KNOWN:
            masked = np.union1d(masked, np.flatnonzero(pc.equal(role, r).to_numpy(zero_copy_only=False)))
    owner = np.searchsorted(first, masked, "right") - 1
    per_part = np.searchsorted(masked, np.append(first, n)).astype(np.int32)
    spans = [places[masked, 3] - starts[owner], places[masked, 4] - starts[owner]]
    yield pa.RecordBatch.from_arrays(
        [
            conv.take(pa.array(first)),
            pa.array(part + np.arange(len(first))),
            strings(buffer, np.append(starts, bounds[-1])),
            *[pa.ListArray.from_arrays(pa.array(per_part), pa.array(s)) for s in spans],
        ],
        names=["conv_id", "part", "text", "loss_starts", "loss_ends"],
    )


class _Parsed:
    """Turns and masked texts of a batch of parts, unescaped, as places in one array of bytes."""

    def __init__(self, batch: pa.RecordBatch):
        data, bounds = raw(batch.column("text"))
        at, kind = controls(data, bounds)
        begins = np.flatnonzero(np.isin(kind, list(CLOSES)))
        named = kind[begins] == ROLE_END
        follows = begins + 1 < len(kind)
        closers = np.array([CLOSES.get(k, -1) for k in range(len(CONTROLS))])
        if len(kind) != 2 * len(begins) + int(named.sum()) or not follows.all() or (kind[begins + 1] != closers[kind[begins]]).any() or (kind[begins[named] - 1] != ROLE).any():
            raise ValueError("the text is not in the chat template")
        drop = dropped(data)
        shift = np.concatenate([[0], np.cumsum(drop)])
        starts, ends = at[begins] + LENGTHS[kind[begins]] + 1, at[begins + 1] - 1
        name_starts = np.where(named, at[begins - 1] + LENGTHS[ROLE] + 1, 0)
        name_ends = np.where(named, at[begins] - 1, 0)
        self.data = data[~drop]
        self.starts, self.ends, self.name_starts, self.name_ends = (x - shift[x] for x in (starts, ends, name_starts, name_ends))
        self.role = np.full(len(CONTROLS), len(KNOWN))
        for i, r in enumerate(KNOWN):
            self.role[OPENS[r]] = i
        self.role = self.role[kind[begins]]
        self.first = np.searchsorted(starts, bounds)  # of each part's turns
        mask = batch.column("loss_starts")
        self.loss_first = mask.offsets.to_numpy() - mask.offsets[0].as_py()
        lists = [batch.column(c).flatten().to_numpy() for c in ("loss_starts", "loss_ends")]
        base = np.repeat(bounds[:-1], np.diff(self.loss_first))
        self.loss_starts, self.loss_ends = (x + base - shift[x + base] for x in lists)
        self.chars = _chars(data, bounds)

    def names(self) -> tuple[Segment, Segment]:
        """The role of every turn: fixed or as written."""
        return constants([r.encode() for r in KNOWN] + [b""], self.role), (self.data, self.name_starts, self.name_ends - self.name_starts)

    def texts(self) -> Segment:
        return self.data, self.starts, self.ends - self.starts


def _chars(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Code points between bounds that follow each other."""
    seen = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return np.diff(seen[bounds])


def parse_turns(parts: DataFrame) -> DataFrame:
    """``conv_id, part, place, role, text`` of every turn, as it was before formatting (a null as an empty text)."""
    kind = parts.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slab in slabs(batches):
            p = _Parsed(slab)
            turns = np.diff(p.first)
            owner = np.repeat(np.arange(slab.num_rows), turns)
            roles, _, role_bounds = assemble(list(p.names()))
            texts, _, bounds = assemble([p.texts()])
            yield pa.RecordBatch.from_arrays(
                [
                    slab.column("conv_id").take(pa.array(owner)),
                    slab.column("part").take(pa.array(owner)),
                    pa.array(np.arange(len(owner)) - p.first[owner]),
                    strings(roles, role_bounds),
                    strings(texts, bounds),
                ],
                names=["conv_id", "part", "place", "role", "text"],
            )

    return parts.select("conv_id", "part", "text", "loss_starts", "loss_ends").mapInArrow(run, f"conv_id {kind}, part long, place long, role string, text string")


DIGESTS = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation: turns, digests of its turns and of its masked text, and code points of both; read off the parts.

    A digest runs through a conversation in order, so its parts meet in one task; they pass through it one batch at a
    time, and what is kept is the state of two digests.
    """
    kind = parts.schema["conv_id"].dataType.simpleString()
    rows = parts.select("conv_id", "part", "text", "loss_starts", "loss_ends")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list = []  # conversation, turns, digest, masked code points, their digest, code points

        def out(done: list[list]) -> pa.RecordBatch:
            columns = list(zip(*[(c, n, t.hexdigest(), m, loss.hexdigest(), chars) for c, n, t, m, loss, chars in done]))
            names = ["conv_id", *[d.split()[0] for d in DIGESTS.split(", ")]]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), *[pa.array(c) for c in columns[1:]]], names=names)

        id_type = None
        for slab in slabs(batches):
            id_type, done = slab.column("conv_id").type, []
            p = _Parsed(slab)
            turns, _, bounds = assemble([*p.names(), _newline(len(p.role)), p.texts(), _newline(len(p.role))])
            loss, _, loss_bounds = assemble([(p.data, p.loss_starts, p.loss_ends - p.loss_starts)])
            masked = _chars(view(loss), loss_bounds)
            masked = np.concatenate([[0], np.cumsum(masked)])
            for i, conv in enumerate(slab.column("conv_id").to_pylist()):
                if not now or now[0] != conv:
                    if now:
                        done.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                a, b = p.first[i], p.first[i + 1]
                now[1] += int(b - a)
                now[2].update(memoryview(turns)[bounds[a] : bounds[b]])
                a, b = p.loss_first[i], p.loss_first[i + 1]
                now[3] += int(masked[b] - masked[a])
                now[4].update(memoryview(loss)[loss_bounds[a] : loss_bounds[b]])
                now[5] += int(p.chars[i])
            if done:
                yield out(done)
        if now:
            yield out([now])

    return ordered.mapInArrow(run, f"conv_id {kind}, {DIGESTS}")


def _newline(n: int) -> Segment:
    return constants([b"\n"], np.zeros(n, int))
