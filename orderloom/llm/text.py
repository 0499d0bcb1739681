"""Helpers shared by the operators: slabs of text inside a task, words and their hashes, columns."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that are handled at once inside a task; one longer text is handled alone.
SLAB_BYTES = 1 << 20
#: The bytes that part words: blank, and tab to carriage return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: The same rule as a pattern for SQL and DataFrame expressions.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

IS_WORD = np.ones(256, bool)
IS_WORD[list(BLANKS)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_CODES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers: dict[str, np.ndarray] = {}


def _return_freed_memory() -> None:
    """Let large arrays go back to the system when they are freed; workers live on through many tasks.

    The C library would otherwise come to keep them for itself. Where it has no such setting, nothing changes.
    """
    try:
        ctypes.CDLL(None).mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
    except (AttributeError, OSError):
        pass


_return_freed_memory()


def whole_text(column: str) -> Column:
    """The text, where null counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def id_crc(column: str) -> Column:
    """The unsigned crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have in any case; used for columns that are only passing through."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column without nulls, and the offsets of each text in them."""
    n = len(column)
    if not n:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slabs(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLAB_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most ``limit`` bytes of text, or of one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = raw(batch.column(text))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    pa.default_memory_pool().release_unused()


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def unmix(h: np.ndarray) -> np.ndarray:
    """The inverse of :func:`mix`."""
    h = h.astype(np.uint64, copy=True)
    h ^= (h >> np.uint64(31)) ^ (h >> np.uint64(62))
    h *= np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    h ^= (h >> np.uint64(27)) ^ (h >> np.uint64(54))
    h *= np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    h ^= (h >> np.uint64(30)) ^ (h >> np.uint64(60))
    return h


def _power(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLAB_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps)
        if len(have) <= 4 * SLAB_BYTES:
            _powers[key] = have
    return have[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span ``data[start:end]``; equal spans have equal hashes wherever they stand.

    The hash is a polynomial in a fixed base, taken from prefix sums, so all spans cost one pass.
    """
    codes = BYTE_CODES[LOWER] if lower else BYTE_CODES
    sums = np.zeros(len(data) + 1, np.uint64)
    terms = codes[data]
    terms *= _power(BASE, len(data))
    np.cumsum(terms, out=sums[1:])
    h = sums[ends] - sums[starts]
    h *= _power(BASE_INVERSE, len(data) + 1)[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix(h)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the place of its first word among them (one more at the end)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = IS_WORD[data]
    opens = inside[1:-1] & ~inside[:-2]
    closes = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]  # a word doesn't go on in the next text
    opens[edges] |= inside[1:-1][edges]
    closes[edges - 1] |= inside[1:-1][edges - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places ``start, start+1, …`` of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


#: Segments from this length on are copied as slices, which need no index for each byte.
LONG_SEGMENT = 1 << 14

Segment = tuple[np.ndarray, np.ndarray, np.ndarray]  # bytes, and start and length of each row's segment in them


def constants(texts: list[bytes], which: np.ndarray) -> Segment:
    """A segment of each row that is one of a few fixed texts."""
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    return np.frombuffer(b"".join(texts) or b" ", np.uint8), starts[which], lengths[which]


def assemble(segments: list[Segment]) -> tuple[pa.Buffer, np.ndarray, np.ndarray]:
    """All rows' segments one after the other; where every segment starts (rows x segments) and where rows start and end."""
    lengths = np.stack([length for _, _, length in segments], axis=1).astype(np.int64)
    ends = np.cumsum(lengths.ravel())
    total = int(ends[-1]) if len(ends) else 0
    places = (ends - lengths.ravel()).reshape(lengths.shape)
    buffer = pa.allocate_buffer(total)
    out = view(buffer)
    for j, (source, starts, length) in enumerate(segments):
        short = np.flatnonzero((length > 0) & (length < LONG_SEGMENT))
        out[ragged(places[short, j], length[short])] = source[ragged(starts[short], length[short])]
        for i in np.flatnonzero(length >= LONG_SEGMENT):
            out[places[i, j] : places[i, j] + length[i]] = source[starts[i] : starts[i] + length[i]]
    return buffer, places, np.append(places[:, 0], total)


def view(buffer: pa.Buffer) -> np.ndarray:
    """The bytes of a buffer, without a copy."""
    return np.frombuffer(buffer, np.uint8) if buffer.size else np.empty(0, np.uint8)


def strings(buffer: pa.Buffer, bounds: np.ndarray) -> pa.StringArray:
    """Bytes between bounds as an Arrow column."""
    return pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds.astype(np.int32)), buffer)
