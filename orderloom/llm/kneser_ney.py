"""Language model scores: an interpolated modified Kneser-Ney bigram model.

Counting is done in Spark, in three rounds over the training texts' hashes, never their strings:

1. words: every task counts its words; counts meet by ranges of the word's hash. A word's id is its rank among all
   word hashes, so the vocabulary is one sorted array.
2. bigrams: every task counts its pairs of ids; counts meet by ranges of the pair's scrambled value (a one-to-one
   scrambling, so pairs of one frequent word are dealt evenly, and ids can be read back from it).
3. contexts: from every range of bigrams, what each first word is followed by (how many kinds, with count 1, 2, more),
   and how many kinds of words come before each second word; these meet by ranges of ids.

The model is a folder of sorted arrays in numpy's own format, one file for each range, written by the tasks, whole or not at all.
Workers map them into memory for scoring; the driver holds totals and the list of ranges only. The folder must be on a
file system that the workers mount, as memory mapping needs; any other place is an error.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm.scratch import remove, store
from orderloom.llm.text import mix, raw, slabs, span_hashes, unmix, whole_text, words
from orderloom.session import fresh_path

#: Hashes of the signs before and after a text. Words get even hashes, so neither can be a word.
BEGIN, END = np.uint64(1), np.uint64(3)
#: Bytes of text that a task gathers before it hands its counts on.
GATHER_BYTES = 24 << 20
#: Bytes of text for each range of words or bigrams.
RANGE_BYTES = 16 << 20
#: Values in one shuffled row.
BLOB_VALUES = 8192
#: What the base model adds to every count.
ADDED = 0.1


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts: words with A-Z lowered, then one end for each; and each text's first token."""
    starts, ends, first = words(data, offsets)
    h = span_hashes(data, starts, ends, lower=True) & ~np.uint64(1)
    n = len(offsets) - 1
    out = np.insert(h, first[1:], END)
    return out, first + np.arange(n + 1)


def _counted(values: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order, and their (summed) counts."""
    if counts is None:
        values = np.sort(values)
        first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
        return values[first], np.diff(np.append(first, len(values)))
    order = np.argsort(values)
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else np.zeros(0, np.int64)


def _range_of(values: np.ndarray, ranges: int) -> np.ndarray:
    """The range that each of ascending 64-bit values lies in, as cuts: place of the first value of every range."""
    edges = np.array([(r << 64) // ranges for r in range(ranges)], np.uint64)
    return np.append(np.searchsorted(values, edges), len(values))


def _pack(counts: np.ndarray) -> bytes:
    """Counts as bytes, with the large ones spelled out after them."""
    large = np.flatnonzero(counts >= 255)
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[large].astype("<i8").tobytes()


def _unpack(n: int, data: bytes) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", offset=n)
    return counts


BLOB = "range int, n int, keys binary, counts binary"
BLOB_NAMES = ["range", "n", "keys", "counts"]


def _blobs(values: np.ndarray, counts: np.ndarray, ranges: int) -> pa.RecordBatch:
    """Ascending values and their counts, in rows of one range and at most ``BLOB_VALUES`` values each."""
    cut = _range_of(values, ranges)
    pieces = [(r, a, min(a + BLOB_VALUES, cut[r + 1])) for r in np.flatnonzero(np.diff(cut)) for a in range(cut[r], cut[r + 1], BLOB_VALUES)]
    columns = [
        pa.array([r for r, _, _ in pieces], pa.int32()),
        pa.array([b - a for _, a, b in pieces], pa.int32()),
        pa.array([values[a:b].astype("<u8").tobytes() for _, a, b in pieces], pa.binary()),
        pa.array([_pack(counts[a:b]) for _, a, b in pieces], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=BLOB_NAMES)


def _gather(batches: Iterator[pa.RecordBatch], ranges: int, make) -> Iterator[pa.RecordBatch]:
    """Count what ``make`` finds in each slab, and hand the sums on after so many bytes of text."""
    values, counts, held = [], [], 0

    def out():
        yield _blobs(*_counted(np.concatenate(values), np.concatenate(counts)), ranges)

    for slab in slabs(batches, limit=4 << 20):
        data, offsets = raw(slab.column(0))
        v, c = _counted(make(data, offsets))
        values.append(v)
        counts.append(c)
        held += len(data) + 100 * slab.num_rows
        if held > GATHER_BYTES:
            yield from out()
            values, counts, held = [], [], 0
    if values:
        yield from out()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The ranges of a task, which come in order, each with its values and summed counts.

    Blobs are merged as they come, so that no more than two of the results is held, however many tasks made them.
    """
    at, keys, counts, held, whole = None, [], [], 0, 0
    for batch in batches:
        for r, n, k, c in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if at is not None and r != at:
                yield (at, *_counted(np.concatenate(keys), np.concatenate(counts)))
                keys, counts, held, whole = [], [], 0, 0
            at = r
            keys.append(np.frombuffer(k, "<u8"))
            counts.append(_unpack(n, c))
            held += n
            if held > max(4_000_000, 2 * whole):
                v, c = _counted(np.concatenate(keys), np.concatenate(counts))
                keys, counts, held, whole = [v], [c], len(v), len(v)
    if at is not None:
        yield (at, *_counted(np.concatenate(keys), np.concatenate(counts)))


def _save(folder: str, name: str, **arrays: np.ndarray) -> None:
    """Write arrays to files that appear whole or not at all; a second attempt writes the same ones over them."""
    for field, values in arrays.items():
        path = f"{folder}/{name}-{field}.npy"
        part = f"{path}.{uuid.uuid4().hex}"
        with open(part, "wb") as f:
            np.save(f, values)
        os.replace(part, path)


def _load(folder: str, name: str, field: str) -> np.ndarray:
    return np.load(f"{folder}/{name}-{field}.npy", mmap_mode="r")


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the totals."""

    folder: str
    word_ranges: int
    first_ids: tuple[int, ...]  # of each range of words, and the number of all words
    bigram_ranges: int
    n_tokens: int
    bigram_cut: tuple[float, float, float]
    word_cut: tuple[float, float, float]
    word_kinds: tuple[int, int, int, int]  # bigrams in all; words with 1, 2, more words before them

    @property
    def n_words(self) -> int:
        return self.first_ids[-1]


def discounts(kinds: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2 and more, from how many n-grams have count 1, 2, 3 and 4.

    Where a needed number is zero the estimate is not defined; then 0.5, 1 and 1.5 are used.
    """
    n1, n2, n3, n4 = (kinds.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return (0.5, 1.0, 1.5)
    y = n1 / (n1 + 2 * n2)
    return tuple(max(0.0, min(float(i), i - (i + 1) * y * b / a)) for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))


def _cut_of(counts: np.ndarray, cut: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *cut])[np.minimum(counts, 3)]


def _mounted(path: str) -> str:
    plain = path.removeprefix("file://").removeprefix("file:")
    if ":" in plain.split("/")[0] or not plain.startswith("/"):
        raise ValueError(f"the model is mapped into memory and needs a mounted shared folder, not {path}")
    return plain


def _dealt(df: DataFrame, ranges: int) -> DataFrame:
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(ranges, 100_000))
    return df.repartition(parts, "range").sortWithinPartitions("range")


class _Vocabulary:
    """Word ids by hash, from the mapped ranges."""

    def __init__(self, folder: str, ranges: int, first_ids: tuple[int, ...]):
        self.hashes = [_load(folder, f"words-{r}", "hash") if first_ids[r] < first_ids[r + 1] else np.zeros(0, np.uint64) for r in range(ranges)]
        self.first_ids, self.ranges = first_ids, ranges

    def ids(self, h: np.ndarray) -> np.ndarray:
        """Ids of ascending hashes; -1 for unknown ones."""
        cut, out = _range_of(h, self.ranges), np.full(len(h), -1, np.int64)
        for r in range(self.ranges):
            own, known = h[cut[r] : cut[r + 1]], self.hashes[r]
            if len(own) and len(known):
                place = np.searchsorted(known, own)
                hit = known[np.minimum(place, len(known) - 1)] == own
                out[cut[r] : cut[r + 1]] = np.where(hit, place + self.first_ids[r], -1)
        return out


def _id_pairs(vocabulary: _Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the word before each token and of the token (-1: unknown), and each text's first token."""
    h, first = tokens(data, offsets)
    distinct, at = np.unique(np.append(h, BEGIN), return_inverse=True)
    ids = vocabulary.ids(distinct)[at]
    begin, ids = ids[-1], ids[:-1]
    before = np.empty(len(ids), np.int64)
    before[1:] = ids[:-1]
    before[first[:-1]] = begin
    return before, ids, first


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Count the texts and write the model. A null text is the empty text: an end without words.

    All texts count whole; nothing is pruned. An empty table gives a model that knows no word. Other columns are not
    looked at, repeated rows count each time.
    """
    spark = docs.sparkSession
    folder = fresh_path(spark, "kneser-ney")
    local = _mounted(folder)
    os.makedirs(local, exist_ok=True)
    texts = docs.select(whole_text(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    word_ranges, bigram_ranges = max(1, -(-size // (2 * RANGE_BYTES))), max(1, -(-size // RANGE_BYTES))

    def count_words(batches):
        def both(data, offsets):
            h, _ = tokens(data, offsets)
            return np.append(h, np.full(len(offsets) - 1, BEGIN))

        yield from _gather(batches, word_ranges, both)

    def save_words(batches):
        for r, h, c in _merged(batches):
            _save(local, f"words-{r}", hash=h, count=c)
            begin = int(c[h == BEGIN].sum())
            yield pa.RecordBatch.from_pydict({"range": pa.array([r], pa.int32()), "n": [len(h)], "total": [int(c.sum()) - begin]})

    sizes = _dealt(texts.mapInArrow(count_words, BLOB), word_ranges).mapInArrow(save_words, "range int, n long, total long").collect()
    of_range = {r["range"]: r["n"] for r in sizes}
    first_ids = tuple(np.concatenate([[0], np.cumsum([of_range.get(r, 0) for r in range(word_ranges)])]).tolist())
    n_tokens = sum(r["total"] for r in sizes)

    def count_bigrams(batches):
        vocabulary = _Vocabulary(local, word_ranges, first_ids)

        def pairs(data, offsets):
            before, ids, _ = _id_pairs(vocabulary, data, offsets)
            return mix((before.astype(np.uint64) << np.uint64(32)) | ids.astype(np.uint64))

        yield from _gather(batches, bigram_ranges, pairs)

    def save_bigrams(batches):
        """Writes bigrams; hands on, by ranges of word ids, followers and predecessors: the key is id * 4 + kind."""
        for r, h, c in _merged(batches):
            _save(local, f"bigrams-{r}", hash=h, count=np.minimum(c, 0xFFFFFFFF).astype(np.uint32))
            pair = unmix(h)
            before, after = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
            keys, kinds = _counted(np.concatenate([before * np.uint64(4) + np.minimum(c, 3).astype(np.uint64) - np.uint64(1), after * np.uint64(4) + np.uint64(3)]))
            stretch = np.uint64(max(1, (1 << 64) // max(4, 4 * first_ids[-1])))  # spread ids over the whole span of ranges
            yield _blobs(keys * stretch, kinds, word_ranges)
            few = np.bincount(c[c <= 4], minlength=5)
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1], pa.int32()), pa.array([len(h)], pa.int32()), pa.array([few.astype("<i8").tobytes()], pa.binary()), pa.array([b""], pa.binary())],
                names=BLOB_NAMES,
            )

    kinds_path = store(_dealt(texts.mapInArrow(count_bigrams, BLOB), bigram_ranges).mapInArrow(save_bigrams, BLOB), "bigram-kinds")
    kinds = spark.read.schema(BLOB).parquet(kinds_path)
    few = np.sum([np.zeros(5, np.int64), *(np.frombuffer(r["keys"], "<i8") for r in kinds.where("range = -1").select("keys").toLocalIterator())], axis=0)
    n_bigrams = kinds.where("range = -1").agg(F.sum(F.col("n").cast("long"))).first()[0] or 0

    def save_contexts(batches):
        stretch = np.uint64(max(1, (1 << 64) // max(4, 4 * first_ids[-1])))
        for r, keys, counts in _merged(batches):
            keys = keys // stretch
            ids, kind = keys >> np.uint64(2), (keys & np.uint64(3)).astype(np.int64)
            low, high = int(ids[0]), int(ids[-1])
            table = np.zeros((high - low + 1, 4), np.int64)
            table[(ids - np.uint64(low)).astype(np.int64), kind] = counts
            _save(local, f"contexts-{r}", kinds=table)
            few = np.bincount(np.minimum(table[:, 3], 5), minlength=6)
            yield pa.RecordBatch.from_pydict(
                {"range": pa.array([r], pa.int32()), "low": [low], "high": [high], **{f"n{i}": [int(few[i])] for i in range(1, 6)}}
            )

    schema = "range int, low long, high long, n1 long, n2 long, n3 long, n4 long, n5 long"
    spans = _dealt(kinds.where("range >= 0"), word_ranges).mapInArrow(save_contexts, schema).collect()
    remove(spark, kinds_path)
    of_count = {i: sum(s[f"n{i}"] for s in spans) for i in range(1, 6)}
    _save(local, "spans", table=np.array(sorted((s["range"], s["low"], s["high"]) for s in spans), np.int64).reshape(-1, 3))
    return Model(
        local, word_ranges, first_ids, bigram_ranges, n_tokens,
        discounts({i: int(few[i]) for i in range(1, 5)}), discounts(of_count),
        (int(n_bigrams), of_count[1], of_count[2], sum(of_count[i] for i in (3, 4, 5))),
    )


class Scorer:
    """Probabilities of tokens from the mapped arrays."""

    def __init__(self, model: Model):
        self.model = model
        self.vocabulary = _Vocabulary(model.folder, model.word_ranges, model.first_ids)
        self.counts = self._by_range("words", "count", model.word_ranges)
        self.bigram_hash = self._by_range("bigrams", "hash", model.bigram_ranges)
        self.bigram_count = self._by_range("bigrams", "count", model.bigram_ranges)
        spans = _load(model.folder, "spans", "table")
        self.spans = [(low, high, _load(model.folder, f"contexts-{r}", "kinds")) for r, low, high in spans.tolist()]

    def _by_range(self, name: str, field: str, ranges: int) -> list:
        return [
            _load(self.model.folder, f"{name}-{r}", field) if os.path.exists(f"{self.model.folder}/{name}-{r}-{field}.npy") else np.zeros(0, np.uint64)
            for r in range(ranges)
        ]

    def word_counts(self, ids: np.ndarray) -> np.ndarray:
        """Training counts of ascending ids; 0 for -1."""
        out, edges = np.zeros(len(ids), np.int64), np.searchsorted(ids, self.model.first_ids)
        for r, counts in enumerate(self.counts):
            a, b = edges[r], edges[r + 1]
            if a < b:
                out[a:b] = counts[ids[a:b] - self.model.first_ids[r]]
        return out

    def kinds(self, ids: np.ndarray) -> np.ndarray:
        """For ascending ids: followers with count 1, 2, more, and words before it; 0 for -1."""
        out = np.zeros((len(ids), 4), np.int64)
        for low, high, table in self.spans:
            a, b = np.searchsorted(ids, [low, high + 1])
            if a < b:
                out[a:b] += table[ids[a:b] - low]  # two ranges may share the id at their border
        return out

    def bigrams(self, h: np.ndarray) -> np.ndarray:
        """Training counts of ascending scrambled pairs."""
        cut, out = _range_of(h, self.model.bigram_ranges), np.zeros(len(h), np.int64)
        for r, known in enumerate(self.bigram_hash):
            own = h[cut[r] : cut[r + 1]]
            if len(own) and len(known):
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                out[cut[r] : cut[r + 1]] = np.where(known[place] == own, self.bigram_count[r][place], 0)
        return out

    def score(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each text: tokens, known tokens, log10 probability under the base model and under this one."""
        m = self.model
        before, ids, first = _id_pairs(self.vocabulary, data, offsets)
        n = np.diff(first)
        distinct, at = np.unique(np.concatenate([ids, before]), return_inverse=True)
        at, at_before = at[: len(ids)], at[len(ids) :]
        counts, kinds = self.word_counts(distinct), self.kinds(distinct)

        # How likely a word is by the number of kinds of words before it, with an even share for what discounts free.
        kinds_in_all = max(1, m.word_kinds[0])
        freed = sum(d * k for d, k in zip(m.word_cut, m.word_kinds[1:], strict=True)) / kinds_in_all if m.word_kinds[0] else 1.0
        lower = (kinds[:, 3] - _cut_of(kinds[:, 3], m.word_cut)) / kinds_in_all + freed / (self.n_distinct + 1)

        total = counts[at_before].astype(float)
        spare = (kinds[:, :3] @ np.array(m.bigram_cut))[at_before]
        seen = total > 0
        pair = (before.astype(np.uint64) << np.uint64(32)) | (ids.astype(np.uint64) & np.uint64(0xFFFFFFFF))
        both = (before >= 0) & (ids >= 0)
        count = np.zeros(len(ids), np.int64)
        h, back = np.unique(mix(pair[both]), return_inverse=True)
        count[both] = self.bigrams(h)[back]
        safe = np.where(seen, total, 1.0)
        p = np.where(seen, (count - _cut_of(count, m.bigram_cut) + spare * lower[at]) / safe, lower[at])
        base = np.log10((counts[at] + ADDED) / (m.n_tokens + ADDED * (self.n_distinct + 1)))
        edges = first[:-1]
        sums = [np.add.reduceat(x, edges) if len(edges) else np.zeros(0) for x in ((counts[at] > 0).astype(np.int64), base, np.log10(p))]
        return n, *sums

    @property
    def n_distinct(self) -> int:
        """Distinct training tokens; the sign before a text is none."""
        return self.model.n_words - (1 if self.model.n_words else 0)


_scorers: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """The mapped model of this worker; a worker keeps one."""
    if model.folder not in _scorers:
        _scorers.clear()
        _scorers[model.folder] = Scorer(model)
    return _scorers[model.folder]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[Column, ...] = ()) -> DataFrame:
    """For every row: ``doc_id``, ``keep``, ``n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of the whole text, its end included; the perplexity of a text is ``10 ** (-score /
    n_tokens)``. A null or empty text is scored as an end. Under an empty model all tokens are unknown: the base gives
    each log10(1), and so does the model. An empty table gives no rows.
    """
    names = ["n_tokens", "n_known", "base_score", "score"]
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), *keep, whole_text(text_col).alias("text"))
    kept = given.drop("text")
    columns = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(model)
        for slab in slabs(batches, limit=4 << 20):
            n, known, base, own = scorer.score(*raw(slab.column("text")))
            same = [slab.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*same, pa.array(n), pa.array(known), pa.array(base), pa.array(own)], names=[*columns, *names])

    schema = kept.schema.add("n_tokens", "long").add("n_known", "long").add("base_score", "double").add("score", "double")
    out = given.mapInArrow(run, schema)
    return out.select(*columns, "n_tokens", "n_known", F.lit(model.n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
