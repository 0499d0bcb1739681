"""BPE encoding and decoding by reuse of content-defined chunks.

A rolling hash over the bytes cuts every text into chunks; a chunk that occurs in several documents is encoded once.
A chunk's tokens hold in every context except near its ends, so the joins are repaired: from the last agreed place
in one chunk to the first in the next, the text is encoded anew. An agreed place is one where the tokenizer's own
splitting rule must part two tokens whatever stands around it: before a blank that follows a character which is no
blank, and between a letter and a full stop, comma, colon, semicolon, exclamation or question mark. A chunk without
any such place is part of a longer repair. Tokens of the pieces between such places are looked up in a table by
their hash; the tokenizers library encodes each piece that is not yet there.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import BASE, BASE_INVERSE, BYTE_CODES, _power, free_name, mix, ragged, raw, slabs, span_hashes, whole_text

#: A chunk ends where the hash of so many bytes has so many zero bits: 512 bytes on average.
WINDOW = 16
CHUNK_BITS = 9
#: Pieces a worker remembers, and bytes of token ids of whole chunks. Beyond either it starts afresh.
MOST_PIECES = 2_500_000
CHUNK_STORE_BYTES = 48 << 20
SLOT_BITS = 21
PIECES_PER_ROW = 256

IS_BLANK = np.zeros(256, bool)
IS_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
IS_GRAPH = np.zeros(256, bool)
IS_GRAPH[0x21:0x7F] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[0x41:0x5B] = IS_LETTER[0x61:0x7B] = True
IS_STOP = np.zeros(256, bool)
IS_STOP[[ord(c) for c in ".,;:!?"]] = True


def agreed_places(data: np.ndarray) -> np.ndarray:
    """For every byte: whether the splitting rule parts tokens before it, whatever stands elsewhere.

    A blank after a printable ASCII character or after a two-byte character from U+00C0 on (none of those is white
    space) begins a new token, and nothing after it reaches back; the same holds for a stop after an ASCII letter.
    """
    places = np.zeros(len(data), bool)
    if len(data) < 2:
        return places
    before, here = data[:-1], data[1:]
    two_byte = np.zeros(len(before), bool)
    two_byte[1:] = (before[1:] >= 0x80) & (before[1:] < 0xC0) & (data[:-2] >= 0xC3) & (data[:-2] < 0xE0)
    places[1:] = (IS_BLANK[here] & (IS_GRAPH[before] | two_byte)) | (IS_STOP[here] & IS_LETTER[before])
    return places


class PieceTable:
    """Token ids of pieces by the hash of the piece, encoded by the library when first met."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.token_bytes, self.token_starts = token_table(path)
        self.token_lengths = np.diff(self.token_starts)
        self.chunks: OrderedDict[tuple[int, int], tuple] = OrderedDict()
        self.chunk_bytes = 0
        self.clear()

    def clear(self) -> None:
        self.slot_key = np.zeros(1 << SLOT_BITS, np.uint64)
        self.slot_record = np.full(1 << SLOT_BITS, -1, np.int32)
        self.keys, self.records = np.empty(0, np.uint64), np.empty(0, np.int32)
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.pool, self.n, self.used = np.zeros(4096, np.int32), 0, 0

    def _encode_new(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, by the library, and how many each has.

        Pieces that begin with a blank and end so that a blank after them is an agreed place are given to the library
        in rows of many; the rows' tokens are parted by their bytes. The other pieces are given one by one.
        """
        two = np.maximum(ends - 2, starts)
        closed = IS_GRAPH[data[ends - 1]] | ((data[ends - 1] >= 0x80) & (data[ends - 1] < 0xC0) & (data[two] >= 0xC3) & (data[two] < 0xE0))
        rows = np.flatnonzero(IS_BLANK[data[starts]] & closed)
        alone = np.setdiff1d(np.arange(len(starts)), rows, assume_unique=True)
        order = np.concatenate([rows, alone])
        sizes = (ends - starts)[order]
        text = data[ragged(starts[order], sizes)].tobytes()
        edge = np.concatenate([[0], np.cumsum(sizes)])
        cuts = [*range(0, len(rows), PIECES_PER_ROW), *range(len(rows), len(order) + 1)]
        places = edge[cuts].tolist()
        given = [text[a:b].decode("utf-8", "replace") for a, b in zip(places[:-1], places[1:], strict=True)]
        found = [e.ids for e in self.tokenizer.encode_batch_fast(given, add_special_tokens=False)]
        ids = np.fromiter((i for f in found for i in f), np.int32, sum(map(len, found)))
        reach = np.concatenate([[0], np.cumsum(self.token_lengths[ids])])
        first = np.searchsorted(reach, edge)
        if reach[-1] != edge[-1] or not np.array_equal(reach[first], edge):
            raise ValueError("tokens don't cover the bytes of their pieces; is the text UTF-8, the vocabulary byte-level?")
        counts = np.empty(len(order), np.int64)
        counts[order] = np.diff(first)
        begin = np.empty(len(order), np.int64)
        begin[order] = first[:-1]
        return ids[ragged(begin, counts)], counts

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        ids, lengths = self._encode_new(data, starts, ends)
        while self.n + len(lengths) > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.used : self.used + len(ids)] = ids
        at = slice(self.n, self.n + len(lengths))
        self.start[at] = self.used + np.cumsum(lengths) - lengths
        self.length[at] = lengths
        self.n += len(lengths)
        self.used += len(ids)
        return np.arange(at.start, at.stop, dtype=np.int32)

    def _look_up(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        slot = (h >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        record = np.where(self.slot_key[slot] == h, self.slot_record[slot], -1)
        missing = np.flatnonzero(record < 0)
        if not len(missing):
            return record
        new, first, at = np.unique(h[missing], return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, new)
        known = np.zeros(len(new), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == new[inside]
        of = np.empty(len(new), np.int32)
        of[known] = self.records[place[known]]
        if not known.all():
            where = missing[first[~known]]
            of[~known] = self._add(data, starts[where], ends[where])
            self.keys = np.insert(self.keys, place[~known], new[~known])
            self.records = np.insert(self.records, place[~known], of[~known])
        record[missing] = of[at]
        slot = slot[missing[first]]
        self.slot_key[slot], self.slot_record[slot] = new, of
        return record

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, first id of each text, and the pieces' starts and first ids."""
        if self.n > MOST_PIECES:
            self.clear()
        cut = agreed_places(data)
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        cut[edges] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        if not len(starts):
            empty = np.zeros(0, np.int64)
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64), empty, np.zeros(1, np.int64)
        record = self._look_up(span_hashes(data, starts, ends), data, starts, ends)
        lengths = self.length[record].astype(np.int64)
        ids = self.pool[ragged(self.start[record], lengths)]
        first = np.concatenate([[0], np.cumsum(lengths)])
        return ids, first[np.searchsorted(starts, offsets)], starts, first


_tables: dict[str, PieceTable] = {}


def piece_table(path: str) -> PieceTable:
    """The table of this worker process; it outlives tasks."""
    if path not in _tables:
        _tables[path] = PieceTable(path)
    return _tables[path]


def token_table(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of every token id one after the other, and where each begins.

    A byte-level vocabulary writes printable Latin-1 bytes as themselves and the others, in order, as U+0100 and on.
    """
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    tokens = {i: bytes(byte_of[c] for c in t) for t, i in whole["model"]["vocab"].items() if all(c in byte_of for c in t)}
    tokens |= {a["id"]: a["content"].encode() for a in whole["added_tokens"]}
    parts = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def chunk_starts(data: np.ndarray, offsets: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Starts of the content-defined chunks: texts' starts, and places after a window whose hash ends in zero bits."""
    cut = np.zeros(len(data), bool)
    if len(data) > WINDOW:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODES[data] * _power(BASE, len(data)), out=sums[1:])
        rolling = (sums[WINDOW:-1] - sums[: -1 - WINDOW]) * _power(BASE_INVERSE, len(data))[: len(data) - WINDOW]
        rolling = (rolling ^ (rolling >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        cut[WINDOW:] = (rolling >> np.uint64(64 - bits)) == 0
        cut &= (data & 0xC0) != 0x80  # not inside a character
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(cut)


def encode_texts(table: PieceTable, data: np.ndarray, offsets: np.ndarray, bits: int = CHUNK_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts one after the other, and the place of each text's first id (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    starts = chunk_starts(data, offsets, bits)
    ends = np.append(starts[1:], len(data))
    keys = list(zip(span_hashes(data, starts, ends).tolist(), (ends - starts).tolist(), strict=True))

    if table.chunk_bytes > CHUNK_STORE_BYTES:
        table.chunks.clear()
        table.chunk_bytes = 0
    fresh: dict[tuple[int, int], int] = {}
    for at, key in enumerate(keys):
        if key not in table.chunks:
            fresh.setdefault(key, at)
    if fresh:
        at = np.fromiter(fresh.values(), np.int64, len(fresh))
        lengths = ends[at] - starts[at]
        part = data[ragged(starts[at], lengths)]
        edges = np.concatenate([[0], np.cumsum(lengths)])
        ids, first, pieces, piece_ids = table.encode(part, edges)
        # Pieces of a chunk but for its first are at agreed places: note the first and the last such place.
        low, high = np.searchsorted(pieces, edges[:-1]) + 1, np.searchsorted(pieces, edges[1:])
        for i, key in enumerate(fresh):
            own = ids[first[i] : first[i + 1]]
            if low[i] < high[i]:
                a, b = low[i], high[i] - 1
                place = (int(pieces[a] - edges[i]), int(piece_ids[a] - first[i]), int(pieces[b] - edges[i]), int(piece_ids[b] - first[i]))
                table.chunks[key] = (own[place[1] : place[3]].copy(), place[0], place[2])
                table.chunk_bytes += 4 * (place[3] - place[1]) + 200
            else:
                table.chunks[key] = (None, 0, 0)
                table.chunk_bytes += 200

    # A text is now joins and chunk insides in turn; joins run between agreed places and are encoded anew.
    owner = np.searchsorted(offsets, starts, "right") - 1
    last = np.append(owner[1:] != owner[:-1], True)
    joins_a, joins_b, inside, insides_of = [], [], [], []
    at = None
    for i, key in enumerate(keys):
        own, a, b = table.chunks[key]
        if at is None:
            at = int(starts[i])
        if own is not None:
            joins_a.append(at)
            joins_b.append(int(starts[i]) + a)
            inside.append(own)
            at = int(starts[i]) + b
        if last[i]:
            joins_a.append(at)
            joins_b.append(int(ends[i]))
            inside.append(None)
            insides_of.append((int(owner[i]), len(inside)))
            at = None
    a, b = np.array(joins_a, np.int64), np.array(joins_b, np.int64)
    text = data[ragged(a, b - a)]
    ids, first, _, _ = table.encode(text, np.concatenate([[0], np.cumsum(b - a)]))
    parts, place, counts, done = [], 0, np.zeros(len(offsets), np.int64), 0
    for i, own in enumerate(inside):
        parts.append(ids[first[i] : first[i + 1]])
        place += int(first[i + 1] - first[i])
        if own is not None:
            parts.append(own)
            place += len(own)
        if done < len(insides_of) and insides_of[done][1] == i + 1:
            counts[insides_of[done][0] + 1] = place
            done += 1
    return np.concatenate(parts), np.maximum.accumulate(counts)


def decode_ids(table: PieceTable, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes that the ids of each text stand for, and where each text's bytes begin."""
    lengths = table.token_lengths[ids]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return table.token_bytes[ragged(table.token_starts[ids], lengths)], ends[first]


def _text_of(part: np.ndarray) -> str:
    return part.tobytes().decode("utf-8", "replace")


def encode(docs: DataFrame, tokenizer_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with one more column of token ids (array of int), as the tokenizers library gives them.

    A null or empty text has no ids. Texts are encoded whole, whatever their length. Other columns pass through; a
    column that is already called ``out`` is replaced. An empty table gives no rows.
    """
    return _with(docs, text_col, out, pa.list_(pa.int32()), "array<int>", lambda t, data, offsets: _lists(*encode_texts(t, data, offsets)), tokenizer_path)


def _lists(ids: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))


def _with(docs: DataFrame, text_col: str, out: str, kind: pa.DataType, schema: str, make, path: str) -> DataFrame:
    mark = free_name(docs, "bpe_text")
    plain = docs.drop(out)
    columns = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(path)
        for slab in slabs(batches, mark):
            kept = [slab.column(i) for i, c in enumerate(slab.schema.names) if c != mark]
            yield pa.RecordBatch.from_arrays([*kept, make(table, *raw(slab.column(mark)))], names=[*columns, out])

    from pyspark.sql.types import _parse_datatype_string

    return docs.withColumn(mark, whole_text(text_col)).drop(out).mapInArrow(run, plain.schema.add(out, _parse_datatype_string(schema)))


def decode(docs: DataFrame, tokenizer_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with one more text column: the decoded ids, special tokens included. Null ids give an empty text.

    Bytes that are no UTF-8 (ids that were cut inside a character) become U+FFFD. Unknown ids are an error.
    """
    ids = free_name(docs, "bpe_ids")
    plain = docs.drop(out)
    columns = plain.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(tokenizer_path)
        for batch in batches:
            lists = batch.column(ids)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            data, at = decode_ids(table, flat, first)
            kept = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != ids]
            texts = pa.array([_text_of(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([*kept, texts], names=[*columns, out])

    given = F.coalesce(F.col(f"`{ids_col}`").cast("array<int>"), F.array().cast("array<int>"))
    return docs.withColumn(ids, given).drop(out).mapInArrow(run, plain.schema.add(out, "string"))


def round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """For every row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids`` (array of int) if asked for.

    Digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8. A null text is the
    empty text. An empty table gives no rows; other columns are not looked at; repeated rows are encoded each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(tokenizer_path)
        for slab in slabs(batches):
            ids, first = encode_texts(table, *raw(slab.column(1)))
            data, at = decode_ids(table, ids, first)
            words = ids.astype("<u4")
            ids_digest = [hashlib.sha256(words[a:b]).hexdigest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
            text_digest = [_digest(data[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            columns = [slab.column(0), pa.array(np.diff(first)), pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*columns, *([_lists(ids, first)] if with_ids else [])], names=[*names, *(["ids"] if with_ids else [])])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else ""))


def _digest(part: np.ndarray) -> str:
    """Of the decoded text; what is no UTF-8 is first replaced, as decoding does."""
    text = part.tobytes()
    try:
        text.decode("utf-8")
    except UnicodeDecodeError:
        text = text.decode("utf-8", "replace").encode("utf-8")
    return hashlib.sha256(text).hexdigest()
