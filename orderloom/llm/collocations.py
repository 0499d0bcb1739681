"""Collocations by Toivonen's mining: a sample proposes phrases, whole passes count them and their border exactly.

Phrases are contiguous words within a piece of a text, counted for each language. Sampled documents propose phrases: those
that occur at least ``SAMPLE_LEAST`` times among them. A pass over all texts counts exactly every phrase whose two parts
(all but its last and all but its first word) are proposed, which are the proposed phrases and their *negative border*,
the smallest ones that are not. A phrase of the border that turns out frequent has failed: it is added to the proposals,
and a further pass counts what the border gains by it. When no phrase of the border fails, every frequent phrase has been
counted, since all parts of a frequent phrase are frequent. The sample decides how many passes there are and how much they
count, never the result.

Tasks ask whether a phrase is proposed of a bit filter of fixed size (``FILTER_BITS``, 16 MB), which is all that is
broadcast. A phrase that the filter takes for proposed by mistake is counted as well, so mistakes cost work and change
nothing; a filter filled by a very large corpus counts more of the phrases, still exactly. Within a slab of text phrases
are tuples of whole numbers, exact ones; they are folded there, and only different ones become text.

A null language is ``und``, a null or empty text has no words. A long text is cut at the ends of pieces. Repeated rows
count again, null and repeated ids are like others, an empty table gives no rows, other columns are not read. Ties in
score and count are in the order of the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.scratch import stored
from orderloom.llm.text import LOWER, mix, raw, slabs, span_hashes, strings, whole_text, words

UNKNOWN = "und"
#: The bytes that end a piece: . , ; : ! ? and line feed to carriage return; and the two that part words within it.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
#: One document of this many proposes phrases that occur so often in the sample.
SAMPLE_ONE_IN, SAMPLE_LEAST = 4, 2
FILTER_BITS = 1 << 27
#: Bytes of text that are folded together.
FOLD_BYTES = 1 << 20
#: Different words that a task holds while it counts.
HELD_WORDS = 300_000
#: Phrases in one Arrow batch.
OUT_ROWS = 1 << 16
#: Groups that phrases of a language are ranked in first.
RANK_GROUPS = 64

#: Stands between a phrase, which cannot hold it, and its language.
SEPARATOR = "\t"
COUNTS = "key string, n long"
_END, _BLANK = np.zeros(256, bool), np.zeros(256, bool)
_END[list(PIECE_ENDS)] = True
_BLANK[list(BLANKS + PIECE_ENDS)] = True


class Proposals:
    """A bit filter of phrases. It may take others for its own, but none of its own for another."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in _places(hashes, len(self.bits) * 8):
            out &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(hashes % np.uint64(bits)).astype(np.int64), ((hashes >> np.uint64(33)) * np.uint64(0x9E3779B1) % np.uint64(bits)).astype(np.int64)]


def _chained(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its words but the last, and of its last word."""
    return mix(before * np.uint64(0xD6E8FEB86659FD93) + word)


def _language_hashes(names: pa.Array) -> np.ndarray:
    data, offsets = raw(names)
    return span_hashes(data, offsets[:-1], offsets[1:])


def phrase_hashes(lang: pa.Array, phrase: pa.Array) -> np.ndarray:
    """Hashes of phrases that are written out."""
    data, offsets = raw(phrase)
    starts, ends, first = words(data, offsets)
    word = span_hashes(data, starts, ends)
    out = _language_hashes(lang)
    for j in range(int(np.diff(first).max(initial=0))):
        some = np.flatnonzero(np.diff(first) > j)
        out[some] = _chained(out[some], word[first[some] + j])
    return out


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Languages, bytes and offsets of texts, about ``FOLD_BYTES`` together; a longer text is cut at ends of pieces."""
    held: list[pa.RecordBatch] = []
    size = 0

    def out() -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        table = pa.Table.from_batches(held).combine_chunks()
        lang, text = table.column("lang").chunk(0), table.column("text").chunk(0)
        data, offsets = raw(text)
        data = LOWER[data]
        if len(data) <= 2 * FOLD_BYTES:
            yield lang, data, offsets
            return
        for i in range(len(text)):
            at, end = int(offsets[i]), int(offsets[i + 1])
            while at < end:
                to = min(end, at + FOLD_BYTES)
                if to < end:
                    ends = np.flatnonzero(_END[data[at:to]])
                    if len(ends):
                        to = at + int(ends[-1]) + 1
                    else:  # a piece of more than the usual size stays whole
                        to += int(np.argmax(np.append(_END[data[to:end]], True)))
                yield lang.slice(i, 1), data[at:to], np.array([0, to - at])
                at = to

    for slab in slabs(batches):
        held.append(slab)
        size += len(raw(slab.column("text"))[0])
        if size >= FOLD_BYTES:
            yield from out()
            held, size = [], 0
    if held:
        yield from out()


def _counted(
    lang: pa.Array, data: np.ndarray, offsets: np.ndarray, longest: int, now: Proposals | None, before: Proposals | None
) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Counts of phrases of up to ``longest`` words, and whether they are single words.

    ``now`` None: of all phrases. Else of those whose parts are proposed now; with ``before``, but weren't then.
    """
    end, blank = _END[data], _BLANK[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~blank
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    opens[edges] |= inside[1:-1][edges]
    closes[edges - 1] |= inside[1:-1][edges - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    if not len(starts):
        return
    owner = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(end)[starts] + owner
    follows = np.append(piece[1:] == piece[:-1], False)  # the next word is in the same piece
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    spelled = strings(pa.py_buffer(data[~blank]), bounds).dictionary_encode()
    names = lang.dictionary_encode()
    kinds = len(spelled.dictionary)
    tag = names.indices.to_numpy()[owner].astype(np.int64)
    key = tag * kinds + spelled.indices.to_numpy()
    counts = np.bincount(key, minlength=len(names.dictionary) * kinds)
    have = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int64)
    place[have] = np.arange(len(have))
    word_of = place[key]  # at every place of a word: which word of which language
    total = len(have)
    word_data, word_offsets = raw(spelled.dictionary)
    word_hash = span_hashes(word_data, word_offsets[:-1], word_offsets[1:])[have % kinds]
    lang_of = have // kinds
    text_of = spelled.dictionary.take(pa.array(have % kinds))
    ended = pc.binary_join_element_wise(text_of, names.dictionary.take(pa.array(lang_of)), SEPARATOR)
    hashes = _chained(_language_hashes(names.dictionary)[lang_of], word_hash)

    def out(ids: list[np.ndarray], n: np.ndarray) -> Iterator[tuple[bool, pa.RecordBatch]]:
        for at in range(0, len(n), OUT_ROWS):
            some = [pa.array(i[at : at + OUT_ROWS]) for i in ids]
            spelling = [*[text_of.take(i) for i in some[:-1]], ended.take(some[-1])]
            key = pc.binary_join_element_wise(*spelling, " ") if len(spelling) > 1 else spelling[0]
            yield len(ids) == 1, pa.RecordBatch.from_arrays([key, pa.array(n[at : at + OUT_ROWS])], names=["key", "n"])

    if before is None:
        spoken = np.bincount(lang_of, counts[have], len(names.dictionary)).astype(np.int64)
        some = np.flatnonzero(spoken)
        all_words = pc.binary_join_element_wise("", names.dictionary.take(pa.array(some)), SEPARATOR)
        yield True, pa.RecordBatch.from_arrays([all_words, pa.array(spoken[some])], names=["key", "n"])
        yield from out([np.arange(total)], counts[have])
    # At every place: is the phrase of so many words that starts there counted and proposed, now and before; its hash.
    known = (now.has(hashes) if now else np.ones(total, bool))[word_of]
    was = (before.has(hashes) if before else np.zeros(total, bool))[word_of]
    hash_at = hashes[word_of]
    for size in range(2, longest + 1):
        first = np.flatnonzero(follows & known)
        first = first[known[first + 1]]
        then = was[first] & was[first + 1]
        fresh = first[~then]
        yield from out(*_distinct([word_of[fresh + j] for j in range(size)], total))
        if size == longest:
            return
        h = _chained(hash_at[first], word_hash[word_of[first + size - 1]])
        known, was = np.zeros(len(word_of), bool), np.zeros(len(word_of), bool)
        known[first] = now.has(h) if now else True
        was[first] = then & before.has(h) if before else False
        hash_at[first] = h


def _words_folded(counted: Iterator[tuple[bool, pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Counts of phrases as they come, those of single words (flagged) added up as far as they fit."""
    held: list[pa.RecordBatch] = []
    n = 0

    def folded() -> pa.RecordBatch:
        table = pa.Table.from_batches(held).group_by("key").aggregate([("n", "sum")]).combine_chunks()
        return pa.RecordBatch.from_arrays([table.column("key").chunk(0), table.column("n_sum").chunk(0)], names=["key", "n"])

    for words_only, batch in counted:
        if not words_only:
            yield batch
            continue
        held.append(batch)
        n += batch.num_rows
        if n > HELD_WORDS:
            held = [folded()]
            n = held[0].num_rows
            if n > HELD_WORDS // 2:
                yield from (held[0].slice(at, OUT_ROWS) for at in range(0, n, OUT_ROWS))
                held, n = [], 0
    if n:
        whole = folded()
        yield from (whole.slice(at, OUT_ROWS) for at in range(0, whole.num_rows, OUT_ROWS))


def _distinct(ids: list[np.ndarray], total: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Different rows of several columns of numbers below ``total``, and how often each occurs."""
    if total ** len(ids) >= 1 << 63:
        rows, n = np.unique(np.column_stack(ids), axis=0, return_counts=True)
        return list(rows.T), n
    key = ids[0].copy()
    for more in ids[1:]:
        key *= total
        key += more
    key, n = np.unique(key, return_counts=True)
    out = []
    for _ in ids:
        key, one = np.divmod(key, total)
        out.append(one)
    return out[::-1], n


def _counts(rows: DataFrame, longest: int, now, before=None, least: int = 1) -> DataFrame:
    """``lang, size, phrase, n`` with at least ``least`` occurrences; size 0: all words of a language.

    ``now`` and ``before`` are broadcast proposals. Phrases are folded for each slab of text, in which a frequent one is a
    row like any other; few occur again in the same task, so they are shuffled as they are, under one key. Single words do
    occur again, and are folded for the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [Proposals(np.frombuffer(b.value, np.uint8)) if b is not None else None for b in (now, before)]
        yield from _words_folded(out for text in _joined(batches) for out in _counted(*text, longest, *filters))

    counts = rows.mapInArrow(run, COUNTS).repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
    at = F.instr("key", SEPARATOR)
    phrase = F.substring("key", F.lit(1), at - 1)
    frequent = counts.where((F.col("n") >= least) | (at == 1))
    blanks = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
    return frequent.select(F.substring("key", at + 1, F.length("key")).alias("lang"), phrase.alias("phrase"), "n").select(
        "lang", F.when(F.col("phrase") == "", 0).otherwise(blanks + 1).alias("size"), "phrase", "n"
    )


def _bits(phrases: DataFrame, bits: int) -> np.ndarray:
    """The filter of some phrases. Bits are gathered in Spark; the driver gets the filter, whose size is fixed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_places(phrase_hashes(batch.column("lang"), batch.column("phrase")), bits))
            yield pa.RecordBatch.from_arrays([pa.array(at + 1)], names=["at"])

    places = phrases.select("lang", "phrase").mapInArrow(run, "at long")
    groups = places.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(max(bits // 8, 4096), np.uint8)
    for r in groups.collect():
        out[(r["bucket"] - 1) * 4096 : r["bucket"] * 4096] = np.frombuffer(r["bits"], np.uint8)
    return out[: bits // 8]


def _failed(counted: DataFrame, proposals, longest: int) -> DataFrame:
    """Frequent phrases that are not proposed and could be part of a longer one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Proposals(np.frombuffer(proposals.value, np.uint8))
        for batch in batches:
            yield batch.filter(pa.array(~known.has(phrase_hashes(batch.column("lang"), batch.column("phrase")))))

    return counted.where((F.col("size") > 0) & (F.col("size") < longest)).select("lang", "phrase").mapInArrow(run, "lang string, phrase string")


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, size, phrase, n`` of all phrases that occur at least ``least`` times; size 0: all words of a language."""
    spark = docs.sparkSession
    broadcast = spark.sparkContext.broadcast
    given = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        whole_text("text").alias("text"),
    )
    rows = given.select("lang", "text")
    sample = given.where(F.pmod(F.xxhash64("id", "text"), F.lit(SAMPLE_ONE_IN)) == 0).select("lang", "text")
    seen = _counts(sample, max(longest - 1, 1), None, least=min(SAMPLE_LEAST, least)).where("size > 0")
    bits = _bits(seen, filter_bits)
    now, before, found = broadcast(bits.tobytes()), None, []
    while True:
        found.append(stored(_counts(rows, longest, now, before, least), "phrases"))
        failed = _failed(found[-1], now, longest)
        more = _bits(failed, filter_bits)
        if not more.any():
            break
        bits = bits | more
        if before is not None:
            before.unpersist()
        now, before = broadcast(bits.tobytes()), now
    out = found[0]
    for part in found[1:]:
        out = out.union(part)
    return out


def _part(first: Column, n: Column) -> Column:
    """Words of a phrase from a place on (from 1)."""
    return F.array_join(F.slice("words", first, n), " ")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, share: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of two to ``longest`` words of each language.

    A phrase's score is that of its weakest cut, ``floor(10^6 * a * a / (l * r))`` in exact decimals. Phrases within a
    longer frequent phrase that has at least ``share`` percent of their occurrences are left out.
    """
    counts = stored(frequent_phrases(docs, longest, least), "frequent-phrases")
    totals = counts.where("size = 0").select("lang", F.col("n").alias("words_n"))
    parts = counts.where("size > 0").select("lang", "size", "phrase", "n")
    phrases = parts.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right")
    )
    for side in ("left", "right"):
        n = parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(side[0]))
        cuts = cuts.join(n, ["lang", side])
    a, l, r = (F.col(c).cast("decimal(19,0)") for c in ("a", "l", "r"))
    scored = cuts.withColumn("over", (a * a).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("under", l * r)
    scored = scored.withColumn("score", F.expr("over div under"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = (
        phrases.where("size > 2")
        .select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"))
        .select("lang", "a", "words", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
        .select("lang", _part(F.col("at"), F.col("m")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    kept = weakest.join(inner, ["lang", "phrase"], "left").where((F.col("longer").isNull()) | (100 * F.col("longer") < share * F.col("a")))
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = F.pmod(F.xxhash64("phrase"), F.lit(RANK_GROUPS))
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("lang", some).orderBy(*order))).where(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("words_n").alias("n"), "score")
