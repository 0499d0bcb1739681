"""Grouping of spelling variants with a trie of letter-group counts.

Words are maximal runs of the letters A to Z, a to z and U+00C0 to U+00FF; only A to Z are lower-cased. Every word is a
vector that counts its letters by group, and the vectors are the paths of a trie: level ``i`` branches by the count of
group ``i``. One edit adds at most one to the count of one group and takes at most one from another, so words within one
edit lie where a depth-first search gets to with a budget of one surplus and one deficit. Words at the leaves are compared
letter by letter.

At scale the trie is cut into shards: a node that holds more than ``SHARD_WORDS`` words is split into its children, and
what cannot be split further into blocks. The nodes that are split, a bounded number since each holds so many words, are
all that is broadcast. A word is a member of one shard and visits those shards after its own that its budget reaches, so
every pair is found once, in one task. A task holds the members of one shard at a time, visitors stream past.

A null text has no words. Words that occur fewer than ``least`` times overall or are shorter than ``shortest`` don't
count. A word may have any length; from ``WIDE`` letters on words are compared one pair at a time. An empty table gives no
rows, repeated rows count again, other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.scratch import stored
from orderloom.llm.text import LOWER, assemble, raw, slabs, strings, whole_text

RUN = r"[A-Za-zÀ-ÿ]+"
#: Levels of the trie: the 26 letters, common ones first, then letters with marks in six groups by code point.
LETTERS = "etaonirshdlucmfpgwybvkxjqz"
MARKED_GROUPS = 6
LEVELS = len(LETTERS) + MARKED_GROUPS
SHARD_WORDS = 20_000
#: Levels that are counted in one pass while the trie is cut.
LEVELS_AT_ONCE = 5
#: A node of so few words is compared as a whole.
LEAF_WORDS = 16
#: Longer words are not laid out in a matrix.
WIDE = 64
#: Visitors that search a shard together, and pairs of words that are compared together.
BLOCK, PAIRS = 8192, 1 << 16
#: Different words that a task holds while it counts.
HELD_WORDS = 400_000

_GROUP = np.full(256, len(LETTERS), np.uint8)
_GROUP[[ord(c) for c in LETTERS]] = np.arange(len(LETTERS))
_GROUP[192:] = len(LETTERS) + np.arange(64) % MARKED_GROUPS

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, (_CRC >> 1) ^ np.uint32(0xEDB88320), _CRC >> 1)


def span_crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The crc32 of each span, going on from that of the bytes before it."""
    out = before.astype(np.uint32)
    order = np.argsort(-np.minimum(lengths, WIDE + 1), kind="stable")
    held, at = ~out[order], starts[order]
    long = int(np.searchsorted(-lengths[order], -WIDE, "left")) if len(order) else 0
    for i in range(long):
        held[i] = ~np.uint32(zlib.crc32(data[at[i] : at[i] + lengths[order[i]]].tobytes(), int(out[order[i]])))
    sizes = lengths[order]
    for j in range(WIDE):
        n = int(np.searchsorted(-sizes, -j, "left"))  # spans that are longer than j
        if n <= long:
            break
        some = slice(long, n)
        held[some] = _CRC[(held[some] ^ data[at[some] + j]) & 0xFF] ^ (held[some] >> 8)
    out[order] = ~held
    return out


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all runs of letters in UTF-8 texts, and the text that each belongs to."""
    mark = data == 0xC3  # the first byte of every letter from U+00C0 to U+00FF, and of nothing else
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = mark | ((data | 32) - 97 < 26)
    inside[2:-1] |= mark[:-1]
    opens, closes = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] |= inside[1:-1][edges]
    closes[edges - 1] |= inside[1:-1][edges - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(offsets, starts, "right") - 1


def _damaged(word: str, at: int) -> str:
    return word[:at] + word[at + 1 :]


def _words(slab: pa.RecordBatch, shortest: int, typos: int) -> pa.Array:
    """The words of some texts, one entry for each occurrence."""
    data, offsets = raw(slab.column("text"))
    data = LOWER[data]
    starts, ends, owner = runs(data, offsets)
    marks = np.concatenate([[0], np.cumsum(data == 0xC3)])
    length = ends - starts - (marks[ends] - marks[starts])
    hit = np.zeros(len(starts), bool)
    if typos:
        prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in slab.column("id").to_pylist()], np.uint32)
        h = span_crcs(data, starts, ends - starts, prefix[owner])
        hit = h % typos == 0
    keep = np.flatnonzero(~hit & (length >= shortest))
    buffer, _, bounds = assemble([(data, starts[keep], (ends - starts)[keep])])
    plain = strings(buffer, bounds)
    hurt = [
        _damaged(data[starts[i] : ends[i]].tobytes().decode(), int(h[i]) % int(length[i]))
        for i in np.flatnonzero(hit & (length > shortest))
    ]
    return pa.concat_arrays([plain, pa.array(hurt, pa.string())]) if hurt else plain


def vocabulary(docs: DataFrame, shortest: int = 5, least: int = 3, typos: int = 0) -> DataFrame:
    """``word, n``: words of all texts with their occurrences, folded in the task before they are shuffled.

    With ``typos`` a word of a document loses one letter where the crc32 of ``<doc_id>:<word>`` is divisible by it.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), whole_text("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def folded() -> pa.Table:
            table = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": table.column("word"), "n": table.column("n_sum")})

        for slab in slabs(batches):
            counts = _words(slab, shortest, typos).value_counts()
            held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
            n += len(counts)
            if n > HELD_WORDS:
                held = [folded()]
                n = held[0].num_rows
                if n > HELD_WORDS // 2:
                    yield from held[0].combine_chunks().to_batches(1 << 16)
                    held, n = [], 0
        if held:
            yield from folded().combine_chunks().to_batches(1 << 16)

    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least)


def latin(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with one byte for each letter; all letters lie below U+0100."""
    mark = data == 0xC3
    out = data.copy()
    out[1:][mark[:-1]] += 64
    marks = np.concatenate([[0], np.cumsum(mark)])
    return out[~mark], offsets - marks[offsets]


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Letters of each word by group; a count above 255 stands as 255, which keeps differences within the budget."""
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    counts = np.bincount(owner * LEVELS + _GROUP[data], minlength=n * LEVELS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(n, LEVELS)


def _word_vectors(words: pa.Array) -> np.ndarray:
    return vectors(*latin(*raw(words)))


class Cut:
    """How the trie is cut: nodes that are split, and for each shard the numbers of its blocks."""

    def __init__(self, split: set[bytes], blocks: dict[bytes, tuple[int, int]]):
        self.split, self.blocks = split, blocks

    def reached(self, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, int, int, bool]]:
        """Depth-first from the root: words (by place) with the blocks (first, number) they get to, and whether it is their own shard."""
        n = len(wanted)
        todo = [(b"", np.arange(n), np.zeros(n, np.int8), np.zeros(n, np.int8))]
        while todo:
            path, who, more, less = todo.pop()
            if path not in self.split:
                if path in self.blocks:
                    own = (more == 0) & (less == 0)
                    for some, mine in ((who[own], True), (who[~own], False)):
                        if len(some):
                            yield some, *self.blocks[path], mine
                continue
            count = wanted[who, len(path)].astype(np.int16)
            for value in np.unique(np.concatenate([count - 1, count, count + 1])):
                if 0 <= value <= 255:
                    step = value - count
                    up, down = more + np.maximum(step, 0), less + np.maximum(-step, 0)
                    fits = (up <= 1) & (down <= 1)
                    if fits.any():
                        todo.append((path + bytes([value]), who[fits], up[fits], down[fits]))


def cut_trie(words: DataFrame, shard_words: int = SHARD_WORDS) -> Cut:
    """Nodes above ``shard_words`` words are split, some levels at a time.

    Only words below nodes that are still too large are counted at the next levels. What comes to the driver are nodes of
    so many words, and their children.
    """
    split: set[bytes] = set()
    sizes: dict[bytes, int] = {}
    depth, open_nodes = 0, {b""}
    while open_nodes:
        deep = min(depth + LEVELS_AT_ONCE, LEVELS)
        nodes = stored(_node_sizes(words, open_nodes, depth, deep), "trie-nodes")
        if depth == 0:
            sizes |= {b"": r["n"] for r in nodes.where("length(path) = 0").collect()}
        heavy = {bytes(r["path"]) for r in nodes.where((F.col("n") > shard_words) & (F.length("path") < deep)).select("path").collect()}
        if heavy:
            above = nodes.sparkSession.createDataFrame([(bytearray(p),) for p in heavy], "above binary")
            parent = F.expr("substring(path, 1, length(path) - 1)")
            children = nodes.where("length(path) > 0").join(F.broadcast(above), parent == F.col("above"), "left_semi")
            sizes |= {bytes(r["path"]): r["n"] for r in children.collect()}
        split |= heavy
        open_nodes = {p for p, n in sizes.items() if n > shard_words and len(p) == deep < LEVELS}
        depth = deep
    blocks, at = {}, 0
    for path, n in sorted(sizes.items()):
        if path not in split:
            blocks[path] = (at, -(-n // shard_words))
            at += blocks[path][1]
    return Cut(split, blocks)


def _node_sizes(words: DataFrame, open_nodes: set[bytes], depth: int, deep: int) -> DataFrame:
    """``path, n``: words below each node of the levels ``depth`` to ``deep`` under the open nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["path", "n"])

        for batch in batches:
            for row in _word_vectors(batch.column("word")):
                path = row[:deep].tobytes()
                if path[:depth] in open_nodes:
                    seen.update(path[:level] for level in range(depth, deep + 1))
            if len(seen) > HELD_WORDS:
                yield out()
                seen.clear()
        yield out()

    return words.select("word").mapInArrow(run, "path binary, n long").groupBy("path").agg(F.sum("n").alias("n"))


def near_letters(a: bytes, b: bytes) -> bool:
    """Do two words differ by exactly one letter put in, taken out or replaced?"""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    same = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[same + (len(a) == len(b)) :] == b[same + 1 :]


class Words:
    """Some words as letters and as vectors."""

    def __init__(self, words: pa.Array, n: np.ndarray):
        self.words, self.n = words, n
        self.data, self.offsets = latin(*raw(words))
        self.lengths = np.diff(self.offsets)
        self.vectors = vectors(self.data, self.offsets)
        wide = int(min(WIDE, self.lengths.max(initial=0)))
        column = np.arange(wide)
        inside = column < self.lengths[:, None]
        self.matrix = np.zeros((len(words), WIDE + 1), np.uint8)
        if len(self.data):
            places = np.minimum(self.offsets[:-1, None] + column, len(self.data) - 1)
            self.matrix[:, :wide] = np.where(inside, self.data[places], 0)

    def letters(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def verified(a: Words, b: Words, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of words are near."""
    la, lb = a.lengths[i], b.lengths[j]
    out = np.zeros(len(i), bool)
    narrow = (la <= WIDE) & (lb <= WIDE)
    for p in np.flatnonzero(~narrow & (np.abs(la - lb) <= 1)):
        out[p] = near_letters(a.letters(i[p]), b.letters(j[p]))
    same = np.flatnonzero(narrow & (la == lb))
    out[same] = (a.matrix[i[same]] != b.matrix[j[same]]).sum(1) == 1
    for short, long, s, t, d in ((a, b, i, j, lb - la), (b, a, j, i, la - lb)):
        one = np.flatnonzero(narrow & (d == 1))
        x, y = short.matrix[s[one]], long.matrix[t[one]]
        alike = x[:, :-1] == y[:, :-1]
        first = np.where(alike.all(1), WIDE, alike.argmin(1))
        column = np.arange(WIDE)
        out[one] = ((column < first[:, None]) | (x[:, :-1] == y[:, 1:])).all(1)
    return out


class Trie:
    """The words of one shard in the order of their vectors: every node is a range of them."""

    def __init__(self, members: Words):
        self.members = members
        self.order = np.lexsort(members.vectors.T[::-1])
        self.table = members.vectors[self.order]

    def search(self, wanted: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place in ``wanted``, place in members) that a depth-first search with its budget gets to."""
        n = len(wanted.words)
        todo = [(0, len(self.table), 0, np.arange(n), np.zeros(n, np.int8), np.zeros(n, np.int8))]
        while todo:
            low, high, level, who, more, less = todo.pop()
            if level == LEVELS and high - low > LEAF_WORDS:
                yield from self._halves(wanted, who, low, high)
            elif level == LEVELS or high - low <= LEAF_WORDS:
                block = max(1, (1 << 20) // (high - low))
                for at in range(0, len(who), block):
                    some = who[at : at + block]
                    up, down = (x[at : at + block, None].repeat(high - low, 1) for x in (more, less))
                    for k in range(level, LEVELS):
                        step = self.table[low:high, k].astype(np.int16) - wanted.vectors[some, k, None]
                        up, down = up + np.maximum(step, 0), down + np.maximum(-step, 0)
                    a, b = np.nonzero((up <= 1) & (down <= 1))
                    yield some[a], self.order[low + b]
            else:
                column = self.table[low:high, level]
                edges = np.append(np.flatnonzero(np.append(True, column[1:] != column[:-1])), high - low)
                count = wanted.vectors[who, level].astype(np.int16)
                for first, last in zip(edges[:-1], edges[1:]):
                    step = np.int16(column[first]) - count
                    up, down = more + np.maximum(step, 0), less + np.maximum(-step, 0)
                    fits = np.flatnonzero((up <= 1) & (down <= 1))
                    if len(fits):
                        todo.append((low + first, low + last, level + 1, who[fits], up[fits], down[fits]))

    def _halves(self, wanted: Words, who: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Many words of one vector: one edit leaves the first or the second half of the shorter word as it is."""
        table: dict[tuple, list[int]] = {}
        for m in self.order[low:high]:
            for key in _halves_of(self.members.letters(m)):
                table.setdefault(key, []).append(m)
        for w in who:
            found = {m for key in _halves_of(wanted.letters(w)) for m in table.get(key, ())}
            if found:
                yield np.full(len(found), w), np.array(sorted(found))


def _halves_of(word: bytes) -> Iterator[tuple]:
    """Keys of a word: its halves as the shorter or equal one of a pair, and as the longer one."""
    for short in (len(word), len(word) - 1):
        if short >= 0:
            yield short, 0, word[: short // 2]
            yield short, 1, word[len(word) - (short - short // 2) :]


FOUND = "word string, n_near long, best_n long, best string"


def _best(names: pa.Array, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """For each word of the pairs: how many it is near to, and which of those occurs most (ties: the smallest)."""
    rank = pc.rank(names, tiebreaker="dense").to_numpy()
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(a[first])), pa.array(np.diff(np.append(first, len(a)))), pa.array(n[b[first]]), names.take(pa.array(b[first]))],
        names=["word", "n_near", "best_n", "best"],
    )


def _found(trie: Trie, wanted: Words, own: bool) -> Iterator[pa.RecordBatch]:
    """Near pairs of the wanted words with the members, seen from both sides; ``own``: the wanted words are the members."""
    pairs, n = [], 0
    names = pa.concat_arrays([wanted.words, trie.members.words])
    counts = np.concatenate([wanted.n, trie.members.n])
    shift = 0 if own else len(wanted.words)

    def near() -> Iterator[pa.RecordBatch]:
        a, b = (np.concatenate(x) for x in zip(*pairs))
        good = verified(wanted, trie.members, a, b)
        a, b = a[good], b[good] + shift
        if len(a):
            yield _best(names, counts, np.concatenate([a, b]), np.concatenate([b, a]))

    for a, b in trie.search(wanted):
        if own:
            a, b = a[a < b], b[a < b]
        if len(a):
            pairs.append((a, b))
            n += len(a)
        if n > PAIRS:
            yield from near()
            pairs, n = [], 0
    if pairs:
        yield from near()


def near_words(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``word, n_near, best_n, best`` of every word (``word, n``) that is near to another one."""
    cut = cut_trie(words, shard_words)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = _word_vectors(batch.column("word"))
            hashes = np.array([zlib.crc32(w.as_buffer() or b"") for w in batch.column("word")], np.int64)
            own = np.full(batch.num_rows, -1)
            steps = []
            for who, first, blocks, mine in cut.reached(wanted):
                if mine:
                    own[who] = first + hashes[who] % blocks
                steps.append((who, first, blocks))
            rows, shards = [np.arange(batch.num_rows)], [own]
            for who, first, blocks in steps:
                for k in range(first, first + blocks):
                    later = who[own[who] < k]
                    rows.append(later)
                    shards.append(np.full(len(later), k))
            row, shard = np.concatenate(rows), np.concatenate(shards)
            dealt = batch.take(pa.array(row))
            visits = pa.array(np.arange(len(row)) >= batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(shard), visits, *dealt.columns], names=["shard", "visits", "word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, trie, members, visitors = -1, None, [], []

        def gathered(parts: list[pa.RecordBatch]) -> Words:
            table = pa.Table.from_batches(parts).combine_chunks()
            return Words(table.column("word").chunk(0), table.column("n").chunk(0).to_numpy())

        def closed() -> None:
            nonlocal trie
            if members and trie is None:
                trie = Trie(gathered(members))

        def visited() -> Iterator[pa.RecordBatch]:
            if visitors and trie is not None:
                yield from _found(trie, gathered(visitors), False)
            visitors.clear()

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            visits = batch.column("visits").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((shard[1:] != shard[:-1]) | (visits[1:] != visits[:-1])) + 1
            for first, last in zip(np.append(0, edges), np.append(edges, len(shard))):
                piece = batch.slice(first, last - first).select(["word", "n"])
                if shard[first] != now:
                    closed()
                    yield from _own(trie, members)
                    yield from visited()
                    now, trie, members = shard[first], None, []
                if not visits[first]:
                    members.append(piece)
                else:
                    closed()
                    visitors.append(piece)
                    if sum(p.num_rows for p in visitors) >= BLOCK:
                        yield from visited()
        closed()
        yield from _own(trie, members)
        yield from visited()

    dealt = words.select("word", "n").mapInArrow(deal, "shard long, visits boolean, word string, n long")
    ordered = dealt.repartition("shard").sortWithinPartitions("shard", "visits", "word")
    parts = ordered.mapInArrow(run, FOUND)
    best = F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))
    folded = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(best).alias("best"))
    return folded.select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def _own(trie: Trie | None, members: list) -> Iterator[pa.RecordBatch]:
    """Pairs among the members of a shard."""
    if trie is not None and members:
        yield from _found(trie, trie.members, True)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms (``word, form``) of a word lead to in the end.

    Every form occurs at least twice as often as its word, so a chain is at most as long as the logarithm of the largest
    count. Each round doubles the steps taken; its rows are written to the shared folder.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        steps = stored(further, "spelling-roots")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")


def variants(docs: DataFrame, shortest: int = 5, least: int = 3, typos: int = 0, ratio: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of all words of the documents.

    A word's form is the most frequent word one edit away, where that occurs at least ``ratio`` times (2 or more) as often.
    """
    words = stored(vocabulary(docs, shortest, least, typos), "spelling-words")
    near = near_words(words)
    better = F.col("best_n") >= ratio * F.col("n")
    chosen = words.join(near, "word", "left").select(
        "word",
        F.when(better, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(better, F.col("best_n")).alias("form_n"),
    )
    chosen = stored(chosen, "spelling-forms")
    ends = roots(chosen.where("form IS NOT NULL"))
    return chosen.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
