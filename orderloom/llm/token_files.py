"""Token ids as files: documents in ascending id order, coded by a shared static rANS table in independent blocks.

A folder holds two Parquet tables. ``table``: ``token, share``, and the number of bits as the share of token -1. ``blocks``, one
row per block of up to 16,384 ids (none, where documents without ids end a part): ``part, block`` (its place: parts in order of document ids, blocks in order within a part),
``n_ids``, ``words`` (32-bit little-endian), ``marks`` and ``states`` of its checkpoints, ``ids_crc32`` and ``words_crc32``,
and the pieces of documents it holds: ``doc_ids``, ``doc_nulls``, ``counts`` and ``first_ordinal``, the place of the first of
them in the part. Parquet carries the blocks so that Spark commits them whole, on any store, whatever executors are lost.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.llm import bpe, rans
from orderloom.llm.scratch import remove, store
from orderloom.llm.text import raw, slabs, whole_text

#: Blocks that are coded side by side.
SIDE_BY_SIDE = 128
BLOCK_SCHEMA = (
    "part int, block int, n_ids int, words binary, marks binary, states binary, ids_crc32 long, words_crc32 long,"
    "doc_ids binary, doc_nulls binary, counts binary, first_ordinal long"
)
BLOCK_NAMES = [c.split()[0] for c in BLOCK_SCHEMA.split(",")]
PIECE_SCHEMA = "part int, block int, ordinal long, doc_id long, place int, n long, crc long"


ENCODED_SCHEMA = "doc_id long, ids binary, token_counts binary"


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", kind: str = "<u4") -> DataFrame:
    """``doc_id, ids, token_counts``: the ids of every whole text, with ``end_id`` after them, as unsigned integers of the type ``kind``.

    Rows of documents have no ``token_counts``. Every task adds one row that has nothing else: ids it gave out, then how often each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe.piece_table(tokenizer_path)
        totals = np.zeros(0, np.int64)
        for slab in slabs(batches):
            ids, first, _, _ = table.encode(*raw(slab.column(1)))
            if end_id is None:
                flat = ids.astype(kind)
            else:
                first = first + np.arange(len(first))
                flat = np.empty(first[-1], kind)
                own = np.ones(len(flat), bool)
                own[first[1:] - 1] = False
                flat[own] = ids
                flat[first[1:] - 1] = end_id
            here = np.bincount(flat, minlength=len(totals))
            here[: len(totals)] += totals
            totals = here
            offsets = pa.py_buffer((np.dtype(kind).itemsize * first).astype(np.int32))
            given = pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, offsets, pa.py_buffer(flat)])
            yield pa.RecordBatch.from_arrays([slab.column(0), given, pa.nulls(len(given), pa.binary())], names=["doc_id", "ids", "token_counts"])
        some = np.flatnonzero(totals)
        if len(some):
            counted = np.concatenate([some, totals[some]]).astype("<i8").tobytes()
            none = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, pa.array([counted], pa.binary())], names=["doc_id", "ids", "token_counts"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, ENCODED_SCHEMA)


def _unpacked_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.column(0):
            some, counts = np.frombuffer(row.as_py(), "<i8").reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts)], names=["token", "n"])


def _coded(table: rans.Frequencies, kind: str):
    most = SIDE_BY_SIDE * rans.BLOCK_IDS
    kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 3, pa.int64(), pa.int64(), *[pa.binary()] * 3, pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ids, docs, nulls, counts = [], [], [], []
        held, block, ordinal = 0, 0, 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal ids, docs, nulls, counts, held, block, ordinal
            if not docs:
                return
            flat, doc_ids, no_id, sizes = (np.concatenate(x) for x in (ids, docs, nulls, counts))
            ends = np.cumsum(sizes)
            starts = ends - sizes
            take = len(flat) if last else len(flat) // rans.BLOCK_IDS * rans.BLOCK_IDS
            rows, at, doc = [], 0, 0

            def row(n: int, words: bytes, marks: bytes, states: bytes, plain: bytes, until: int) -> None:
                pieces = np.minimum(ends[doc:until], at + n) - np.maximum(starts[doc:until], at)
                rows.append(
                    (part, block, n, words, marks, states, zlib.crc32(plain), zlib.crc32(words), doc_ids[doc:until].tobytes(),
                     no_id[doc:until].tobytes(), pieces.astype("<i4").tobytes(), ordinal + doc)
                )

            for coded in rans.encode_blocks(flat[:take], table):
                to = at + coded.n
                whole = int(np.searchsorted(ends, to, "right"))  # documents that end in this block, and those without ids behind them
                begun = int(np.searchsorted(starts, to, "left"))
                plain = flat[at:to].astype("<u4", copy=False).tobytes()
                row(coded.n, coded.words.astype("<u4", copy=False).tobytes(), coded.marks.astype("<i4").tobytes(), coded.states.tobytes(), plain, max(whole, begun))
                block, at, doc = block + 1, to, whole
            while last and doc < len(sizes):  # none of these has any id
                until = min(doc + rans.BLOCK_IDS, len(sizes))
                row(0, b"", b"", b"", b"", until)
                block, doc = block + 1, until
            left = ends[doc:] - np.maximum(starts[doc:], at)
            ids, docs, nulls, counts, held = [flat[take:]], [doc_ids[doc:]], [no_id[doc:]], [left], len(flat) - take
            ordinal += doc
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=BLOCK_NAMES)

        for batch in batches:
            data, offsets = raw(batch.column(1))
            flat, offsets = data.view(kind), offsets // np.dtype(kind).itemsize
            no_id = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            doc_ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype("<i8", copy=False)
            at = 0
            while at < len(doc_ids):
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most - held, "right")) - 1)
                ids.append(flat[offsets[at] : offsets[to]])
                docs.append(doc_ids[at:to])
                nulls.append(no_id[at:to])
                counts.append(np.diff(offsets[at : to + 1]))
                held += int(offsets[to] - offsets[at])
                at = to
                if held >= most:
                    yield from flush(False)
        yield from flush(True)

    return run


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Write all documents to ``folder`` in ascending id order; nulls first, equal ids in the order of a hash of their ids.

    A null or empty text has only its end id. Without an end id, documents may have no ids at all; those that are left after
    the last id of a part are named by blocks without ids, so every document is found again. Other columns are not looked at. An empty table gives a folder without blocks.

    Texts are encoded once, to a stored table, piece by piece (:class:`bpe.PieceTable`); the same tasks count their ids. Only ids
    are then shuffled, by ranges of document ids. The frequency table is as long as the vocabulary, whatever the corpus. A text
    of any length is encoded whole, alone in its slab, and runs over as many blocks as it fills.
    """
    spark = docs.sparkSession
    largest = max(len(bpe.token_table(tokenizer_path)[1]) - 2, end_id or 0)
    kind = "<u2" if largest < 1 << 16 else "<u4"  # between the two passes, ids take as little room as they need
    path = store(encoded(docs, tokenizer_path, end_id, id_col, text_col, kind), "token-ids")
    rows = spark.read.schema(ENCODED_SCHEMA).parquet(path)
    counted = rows.where(F.col("token_counts").isNotNull()).select("token_counts").mapInArrow(_unpacked_counts, "token long, n long")
    counts = {r["token"]: r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    table = rans.frequencies(np.array([counts.get(i, 0) for i in range(max(counts, default=-1) + 1)], np.int64))
    shares = [(int(i), int(table.share[i])) for i in np.flatnonzero(table.share)]
    spark.createDataFrame([(-1, table.bits), *shares], "token int, share int").coalesce(1).write.parquet(f"{folder}/table")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")]
    ids = rows.where(F.col("ids").isNotNull()).select("doc_id", "ids")
    ranged = ids.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged.mapInArrow(_coded(table, kind), BLOCK_SCHEMA).write.option("compression", "none").parquet(f"{folder}/blocks")
    remove(spark, path)
    return folder


def frequency_table(spark: SparkSession, folder: str) -> rans.Frequencies:
    rows = {r["token"]: r["share"] for r in spark.read.parquet(f"{folder}/table").collect()}
    bits = rows.pop(-1)
    return rans.Frequencies(np.array([rows.get(i, 0) for i in range(max(rows, default=-1) + 1)], np.int64), bits)


def _blocks(batch: pa.RecordBatch, table: rans.Frequencies) -> Iterator[tuple[dict, np.ndarray]]:
    """Rows of a batch with their ids; a block whose checksums don't hold is an error."""
    rows = batch.to_pylist()
    for low in range(0, len(rows), SIDE_BY_SIDE):
        some, coded = rows[low : low + SIDE_BY_SIDE], []
        for r in some:
            if zlib.crc32(r["words"]) != r["words_crc32"]:
                raise ValueError(f"part {r['part']}, block {r['block']}: the stored words are damaged")
            if r["n_ids"]:
                states = np.frombuffer(r["states"], "<u8").reshape(-1, rans.LANES)
                coded.append(rans.Block(r["n_ids"], np.frombuffer(r["words"], "<u4"), np.frombuffer(r["marks"], "<i4").astype(np.int64), states))
        decoded = iter(rans.decode_blocks(coded, table))
        for r in some:
            ids = next(decoded) if r["n_ids"] else np.empty(0, np.int32)
            if zlib.crc32(ids.astype("<u4").tobytes()) != r["ids_crc32"]:
                raise ValueError(f"part {r['part']}, block {r['block']}: the decoded ids are not those that were written")
            yield r, ids


def _pieces(table: rans.Frequencies, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r, ids in _blocks(batch, table):
                data = ids.astype("<u4").tobytes()
                counts = np.frombuffer(r["counts"], "<i4").tolist()
                place = 0
                ids_of, nulls = np.frombuffer(r["doc_ids"], "<i8").tolist(), r["doc_nulls"]
                for i, n in enumerate(counts):
                    part = data[4 * place : 4 * (place + n)]
                    own = part if with_ids else zlib.crc32(part)
                    out.append((r["part"], r["block"], r["first_ordinal"] + i, None if nulls[i] else ids_of[i], place, n, own))
                    place += n
            names = [c.split()[0] for c in PIECE_SCHEMA.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary() if with_ids else pa.int64()]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def _zeros_operator() -> list[list[int]]:
    """For every power of two of zero bytes, what appending them does to each bit of a crc32."""
    matrix = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
    def square(m):
        return [_times(m, row) for row in m]
    for _ in range(3):
        matrix = square(matrix)
    out = []
    for _ in range(48):
        out.append(matrix)
        matrix = square(matrix)
    return out


def _times(matrix: list[int], value: int) -> int:
    out = 0
    for row in matrix:
        if value & 1:
            out ^= row
        value >>= 1
        if not value:
            break
    return out


_ZEROS = _zeros_operator()


def joined_crc(parts: list[tuple[int, int]]) -> int:
    """The crc32 of several byte strings one after the other, from ``(length, crc32)`` of each."""
    whole = 0
    for length, crc in parts:
        power = 0
        while length:
            if length & 1:
                whole = _times(_ZEROS[power], whole)
            length >>= 1
            power += 1
        whole ^= crc
    return whole


def _one_crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [joined_crc([(4 * p["n"], p["crc"]) for p in parts]) for parts in batch.column("pieces").to_pylist()]
        columns = [batch.column(c) for c in ("part", "block", "place", "doc_id", "n_tokens")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(crcs, pa.int64())], names=["part", "block", "place", "doc_id", "n_tokens", "ids_crc32"])


def block_starts(blocks: DataFrame) -> DataFrame:
    """``part, block, block_start``: ids in all blocks before. Sums run over parts, and over the blocks of each part."""
    sizes = blocks.select("part", "block", F.col("n_ids").cast("long").alias("n"))
    earlier_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier_blocks = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier_parts), F.lit(0)).alias("part_start"))
    inside = sizes.select("part", "block", F.coalesce(F.sum("n").over(earlier_blocks), F.lit(0)).alias("in_part"))
    return inside.join(parts, "part").select("part", "block", (F.col("part_start") + F.col("in_part")).alias("block_start"))


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``. ``start``: ids of all documents before it.

    Blocks are decoded wherever they lie; a document that runs over several blocks gets its crc from those of its pieces.
    """
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    pieces = blocks.mapInArrow(_pieces(frequency_table(spark, folder), False), PIECE_SCHEMA)
    per_doc = pieces.groupBy("part", "ordinal").agg(
        F.min("block").alias("block"),
        F.min_by("place", "block").alias("place"),
        F.first("doc_id").alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.transform(F.sort_array(F.collect_list(F.struct("block", "n", "crc"))), lambda p: F.struct(p["n"].alias("n"), p["crc"].alias("crc"))).alias("pieces"),
    )
    found = per_doc.mapInArrow(_one_crc, "part int, block int, place int, doc_id long, n_tokens long, ids_crc32 long")
    return found.join(block_starts(blocks), ["part", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("place")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the files: ``doc_id, ids`` (array of int), end ids included."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
    schema = PIECE_SCHEMA.replace("crc long", "crc binary")
    pieces = blocks.mapInArrow(_pieces(frequency_table(spark, folder), True), schema)
    per_doc = pieces.groupBy("part", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("block", F.col("crc").alias("data")))).alias("pieces")
    )

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.frombuffer(b"".join(p["data"] for p in parts), "<u4").astype(np.int32) for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return per_doc.select("doc_id", "pieces").mapInArrow(whole, "doc_id long, ids array<int>")
