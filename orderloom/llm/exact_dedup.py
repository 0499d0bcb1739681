"""Exact deduplication by Grace hashing.

Each task first folds its own equal texts. What is left is dealt by a hash of the text. A task then
keeps texts in an open-addressing table (a dict from whole text to its group, so that equality is
decided by complete content); once the table is full, texts that are not in it go to spill files by
further digits of the hash, and each spill file is handled in the same way, as deep as needed.

Spill files have no name, belong to one task attempt and vanish with it, like the files of Spark's
own sorts: nothing else reads them, and a task that is started anew writes them anew.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.text import free_name, whole_text

#: Bytes of distinct text in a table before it spills.
TABLE_BYTES = 32 << 20
FAN_OUT = 16
LOWEST = -(1 << 63)

Group = tuple[bytes, bytes, int, int]  # text, sha256, number of rows, largest id


def _digit(digest: bytes, level: int) -> int:
    """A digit of the text's digest; digits repeat after 60 levels, where every level still takes a table full."""
    at = 4 + level % 60 // 2 % 28
    return digest[at] >> 4 if level % 2 else digest[at] & 15


def grace(groups: Iterator[Group], table_bytes: int = TABLE_BYTES, level: int = 0) -> Iterator[Group]:
    """One group for each distinct text of the input; the memory held is bounded by ``table_bytes`` and one text."""
    table: dict[bytes, list] = {}
    used, spills = 0, []
    for text, digest, n, top in groups:
        held = table.get(text)
        if held is not None:
            held[1] += n
            held[2] = max(held[2], top)
        elif not spills and (not table or used + len(text) + 200 <= table_bytes):
            table[text] = [digest, n, top]
            used += len(text) + 200
        else:
            if not spills:
                spills = [tempfile.TemporaryFile() for _ in range(FAN_OUT)]
            pickle.dump((text, digest, n, top), spills[_digit(digest, level)], -1)
    for text, (digest, n, top) in table.items():
        yield text, digest, n, top
    table.clear()
    for spill in spills:
        with spill:
            if spill.tell():
                spill.seek(0)
                yield from grace(_stored(spill), table_bytes, level + 1)


def _stored(spill) -> Iterator[Group]:
    while True:
        try:
            yield pickle.load(spill)
        except EOFError:
            return


def _out(groups: Iterator[Group], names: list[str], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for group in groups:
        rows.append(group)
        held += len(group[0]) + 100
        if held > size:
            yield _batch(rows, names)
            rows, held = [], 0
    if rows:
        yield _batch(rows, names)


def _batch(rows: list[Group], names: list[str]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


GROUP_SCHEMA = "text binary, digest binary, n long, top long"
NAMES = ["text", "digest", "n", "top"]


def _fold(table_bytes: int):
    """Equal texts of a task become one row; a full table is emptied, which only leaves more to do later."""

    def run(batches):
        table, used = {}, 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = table.get(text)
                if held is None:
                    table[text] = [hashlib.sha256(text).digest(), 1, i]
                    used += len(text) + 200
                else:
                    held[1] += 1
                    held[2] = max(held[2], i)
            if used > table_bytes:
                yield from _out(((t, *g) for t, g in table.items()), NAMES)
                table, used = {}, 0
        yield from _out(((t, *g) for t, g in table.items()), NAMES)

    return run


def _reduce(table_bytes: int):
    def run(batches):
        rows = (tuple(r) for b in batches for r in zip(*(b.column(c).to_pylist() for c in range(4)), strict=True))
        yield from _out(grace(rows, table_bytes), NAMES)

    return run


def distinct_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row ``text, digest, n, top`` for each distinct text: its sha256, its number of rows, its largest id."""
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LOWEST)).alias("id"), whole_text(text_col).cast("binary").alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    folded = given.mapInArrow(_fold(table_bytes), GROUP_SCHEMA)
    return folded.repartition(parts, "digest").mapInArrow(_reduce(table_bytes), GROUP_SCHEMA)


def text_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """For every row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without any change; a null text is the empty text. Of equal texts the row with the
    largest id stays. A null id is below all others. Rows that repeat both an id and its text count in ``group_size``
    and are all marked as kept, if that id is the one that stays (:func:`drop_copies` returns one of them). An empty
    table gives no rows; other columns are not looked at.

    A text that a third of all rows hold is one row per task after the fold; the rows themselves meet their group
    in an equi-join, whose hot keys adaptive execution splits.
    """
    groups = distinct_texts(docs, id_col, text_col, table_bytes).select("digest", "n", "top")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.sha2(whole_text(text_col).cast("binary"), 256).alias("text_sha256"))
    keep = F.nullif(F.col("top"), F.lit(LOWEST))
    return rows.join(groups, F.unhex("text_sha256") == F.col("digest")).select(
        "doc_id",
        keep.alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of equal texts, one row with the largest id.

    The other columns are joined to the texts that the tables hold, so a text is shuffled twice, never compared twice. Of rows
    that share id and text (a null text being the empty one) the one whose columns, written as JSON, have the smallest
    sha256 stays, so reruns agree; a task keeps one of its own before they are shuffled. Columns pass through whatever their
    names and types. An empty table gives no rows.
    """
    top, digest, own, none = (free_name(docs, f"keep_{x}") for x in ("top", "digest", "text", "null"))
    groups = distinct_texts(docs, id_col, text_col, table_bytes)
    texts = groups.select(F.nullif(F.col("top"), F.lit(LOWEST)).alias(top), F.col("digest").alias(digest), F.col("text").cast("string").alias(own))
    number, sha, line = (free_name(docs, f"keep_{x}") for x in ("id", "sha", "line"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias(number),
        F.unhex(F.sha2(whole_text(text_col).cast("binary"), 256)).alias(sha),
        F.struct(F.col(f"`{text_col}`").isNull().alias(none), *rest).alias(line),
    )
    one = rows.groupBy(number, sha).agg(F.min_by(line, F.sha2(F.to_json(line), 256)).alias(line))
    found = one.join(texts, F.col(number).eqNullSafe(F.col(top)) & (F.col(sha) == F.col(digest)))
    whole = F.when(~F.col(f"{line}.{none}"), F.col(own).cast(docs.schema[text_col].dataType)).alias(text_col)
    return found.select(*[whole if c == text_col else F.col(f"{line}.`{c}`").alias(c) for c in docs.columns])
