"""Token counts of a document's sections, by the character offsets of its tokens.

A document is encoded once, whole. The character spans of its tokens are then joined by interval to its sections,
and a token that crosses a border is given to one section by a stated rule, so that counts add up to the whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm import bpe
from orderloom.llm.text import raw, slabs, whole_text

#: A token goes to the section of its first character, of its last one, or to the one that holds most of its characters
#: (the first of them where they hold as many).
RULES = ("start", "end", "most")


def token_spans(table: bpe.PieceTable, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last-but-one-past character of every token, counted from its text's start, and each text's first token.

    A token that holds only some bytes of a character covers that whole character, as the library's offsets do.
    """
    ids, first = bpe.encode_texts(table, data, offsets)
    reach = np.concatenate([[0], np.cumsum(table.token_lengths[ids])])
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters that began before a byte
    begin = chars[reach[:-1] + 1] - 1 if len(ids) else np.zeros(0, np.int64)
    end = chars[reach[1:]]
    text_start = np.repeat(chars[offsets[:-1]], np.diff(first))
    return begin - text_start, end - text_start, first


def allot(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token; ``starts`` are the ascending starts of sections that tile the text from 0."""
    low = np.searchsorted(starts, begin, "right") - 1
    high = np.searchsorted(starts, end - 1, "right") - 1
    if rule == "start":
        return low
    if rule == "end":
        return high
    for i in np.flatnonzero(low != high):
        edges = np.clip(np.append(starts[low[i] : high[i] + 1], end[i]), begin[i], end[i])
        low[i] += int(np.diff(edges).argmax())
    return low


def line_starts(text: str) -> list[int]:
    """Starts of the lines of a text; a line holds the newline that ends it."""
    starts, at = [0], text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts


def section_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    rule: str = "start",
    id_col: str = "doc_id",
    text_col: str = "text",
    starts_col: str | None = None,
) -> DataFrame:
    """One row per section: ``doc_id, section, char_start, char_end, n_tokens``.

    Sections are the lines of the text, or begin at the ascending characters that the array ``starts_col`` lists (0 is
    added if it is missing; nulls, repeats and places outside the text are left out; a null array is one section).
    Sections tile the text, so the counts of a document add up to its tokens. A null or empty text has one empty
    section. Every row of a repeated id is counted by itself. An empty table gives no rows; other columns are not
    looked at.
    """
    if rule not in RULES:
        raise ValueError(f"the rule is one of {', '.join(RULES)}")
    names = ["doc_id", "section", "char_start", "char_end", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe.piece_table(tokenizer_path)
        for slab in slabs(batches):
            data, offsets = raw(slab.column(1))
            begin, end, first = token_spans(table, data, offsets)
            texts = slab.column(1).to_pylist()
            given = slab.column(2).to_pylist() if starts_col else [None] * len(texts)
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, (doc, text) in enumerate(zip(slab.column(0).to_pylist(), texts, strict=True)):
                if starts_col:
                    inside = {s for s in given[i] or () if s is not None and 0 < s < len(text)}
                    starts = np.array([0, *sorted(inside)], np.int64)
                else:
                    starts = np.array(line_starts(text), np.int64)
                own = allot(begin[first[i] : first[i + 1]], end[first[i] : first[i + 1]], starts, rule)
                n = len(starts)
                columns[0] += [doc] * n
                columns[1].append(np.arange(n))
                columns[2].append(starts)
                columns[3].append(np.append(starts[1:], len(text)))
                columns[4].append(np.bincount(own, minlength=n))
            flat = [pa.array(columns[0], pa.int64()), *(pa.array(np.concatenate(c).astype(np.int64)) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays(flat, names=names)

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        whole_text(text_col).alias("text"),
        *([F.col(f"`{starts_col}`").cast("array<long>").alias("starts")] if starts_col else []),
    )
    return rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def field_tokens(docs: DataFrame, tokenizer_path: str, fields: list[str], rule: str = "start", separator: str = "\n", id_col: str = "doc_id") -> DataFrame:
    """One row per field: ``doc_id, field, n_tokens``; the fields of a row are encoded as one text, joined by ``separator``.

    A separator belongs to the field before it. A null field is empty; it still gets the separator after it. A token that
    begins where several fields do belongs to the last of them that begins there, as the others are empty. Every row has one
    row per field, whatever its id is; a repeated id has them once for each of its rows, and a null id keeps its own.
    """
    if rule not in RULES:
        raise ValueError(f"the rule is one of {', '.join(RULES)}")
    names = ["doc_id", "field", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bpe.piece_table(tokenizer_path)
        for slab in slabs(batches):
            begin, end, first = token_spans(table, *raw(slab.column(1)))
            counts = np.zeros((slab.num_rows, len(fields)), np.int64)
            for i, starts in enumerate(slab.column(2).to_pylist()):
                own = allot(begin[first[i] : first[i + 1]], end[first[i] : first[i + 1]], np.array(starts, np.int64), rule)
                counts[i] = np.bincount(own, minlength=len(fields))
            docs_of = slab.column(0).take(pa.array(np.repeat(np.arange(slab.num_rows), len(fields))))
            yield pa.RecordBatch.from_arrays([docs_of, pa.array(list(fields) * slab.num_rows, pa.string()), pa.array(counts.ravel())], names=names)

    ends = [F.char_length(whole_text(f)) + F.lit(len(separator)) for f in fields]
    places = [F.lit(0), *(sum(ends[1:i], ends[0]) for i in range(1, len(fields)))]
    joined = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.concat_ws(separator, *[whole_text(f) for f in fields]).alias("text"),
        F.array(*places).cast("array<long>").alias("starts"),
    )
    return joined.mapInArrow(run, "doc_id long, field string, n_tokens long")
